"""Lakehouse analytics for e-commerce data, written as plain Spark DataFrame functions.

Functions take DataFrames and return DataFrames; reading and writing sit at the edge, in
``sources`` and ``operators.layout``.
"""
