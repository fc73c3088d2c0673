"""Business rules as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def review_sentiment(score: Column, missing: str = "Negative") -> Column:
    """Positive from 4 up, Neutral at 3, else Negative; ``missing`` names the unreviewed."""
    return (
        F.when(score.isNull(), missing)
        .when(score >= 4, "Positive")
        .when(score == 3, "Neutral")
        .otherwise("Negative")
    )
