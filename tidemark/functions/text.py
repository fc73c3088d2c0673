"""Text clean-up as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the data contract of the Silver layer.
SPECIAL_CHARS = "[^a-zA-Z0-9 ]"
SPECIAL_RUNS = "[,\\t\\n>$*]{2,}"

# Accented letters of Latin city names and their plain forms, position by position.
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyy"


def strip_special_chars(c: Column) -> Column:
    """Keep ASCII letters, digits and blanks."""
    return F.regexp_replace(c, SPECIAL_CHARS, "")


def collapse_special_runs(c: Column) -> Column:
    """Trim, then turn a run of two or more separators into one comma and blank."""
    return F.regexp_replace(F.trim(c), SPECIAL_RUNS, ", ")


def full_address(city: Column, state: Column, zip_code: Column) -> Column:
    """City, state and zip joined by a blank; missing parts leave no gap."""
    return F.concat_ws(" ", city, state, zip_code.cast("string"))


def normalize_city(c: Column) -> Column:
    """Lower case without accents, inner white space collapsed, outer removed."""
    plain = F.translate(F.lower(c), ACCENTED, PLAIN)
    return F.trim(F.regexp_replace(plain, "[ \\t\\r\\n]+", " "))


def upper_status(c: Column) -> Column:
    return F.upper(c)
