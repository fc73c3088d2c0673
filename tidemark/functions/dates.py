"""Dates and times as Catalyst expressions. Unreadable input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column) -> Column:
    """Date of a text that starts with ``yyyy-MM-dd``; a time of day after it is dropped."""
    return c.try_cast("date")


def parse_timestamp(c: Column) -> Column:
    """Wall-clock time of a text, without a zone."""
    return c.try_cast("timestamp_ntz")


def date_parts(c: Column, prefix: str, weekday: bool = False) -> dict[str, Column]:
    """``<prefix>_year``, ``_month``, ``_day`` and, on request, ``_weekday`` (Sunday is 1)."""
    parts = {
        f"{prefix}_year": F.year(c),
        f"{prefix}_month": F.month(c),
        f"{prefix}_day": F.dayofmonth(c),
    }
    if weekday:
        parts[f"{prefix}_weekday"] = F.dayofweek(c)
    return parts


def delivery_days(purchase: Column, delivered: Column, estimated: Column) -> dict[str, Column]:
    """Days to delivery, days promised, and by how many the delivery was late."""
    actual = F.datediff(delivered, purchase)
    promised = F.datediff(estimated, purchase)
    return {
        "actual_delivery_time": actual,
        "estimated_delivery_time": promised,
        "delay_time": actual - promised,
    }


def year_month_label(year: Column, month: Column) -> Column:
    """``2017-7``. As text it does not sort by time: order by year and month instead."""
    return F.concat(year.cast("string"), F.lit("-"), month.cast("string"))
