"""Checks against an independent SQL engine: test frames, registered queries, oracle SQL."""
