"""Cleaning steps shared by all entities. Casts give null on unreadable input, never an error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import strip_special_chars
from tidemark.schemas import Field


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename; names that are absent do no harm."""
    return df.withColumnsRenamed(names)


def readable(column: Column, kind: str) -> Column:
    """The value as ``kind``, null where it cannot be read. NaN and infinity are no amounts either."""
    value = column.try_cast(kind)
    if kind in ("double", "float"):
        return F.when(F.abs(value) < F.lit(float("inf")), value)  # NaN counts as larger than infinity
    return value


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({name: readable(F.col(name), kind) for name, kind in types.items()})


def fill_nulls(df: DataFrame, defaults: dict) -> DataFrame:
    """Per-column defaults. A default must be valid for its column's type."""
    return df.fillna({name: value for name, value in defaults.items() if name in df.columns})


def clean_fields(df: DataFrame, fields: list[Field]) -> DataFrame:
    """Select by header name, cast, fill and strip, all in one projection."""
    columns = []
    for f in fields:
        c = F.col(f.source)
        if f.type != "string":
            c = readable(c, f.type)
        if f.default is not None:
            c = F.coalesce(c, F.lit(f.default).cast(f.type))
        if f.strip:
            c = strip_special_chars(c)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def ingest_type_conversion(df: DataFrame, target: T.StructType) -> DataFrame:
    """Convert text to the target schema as the copy step does.

    A fraction is cut off for a whole-number column, a boolean word is no number, and what
    cannot be read becomes null.
    """
    columns = []
    for field in target:
        c = F.col(field.name)
        if isinstance(field.dataType, T.IntegralType):
            # Towards zero, as decimal to integer casts do.
            c = c.try_cast("decimal(38,10)")
        columns.append(c.try_cast(field.dataType).alias(field.name))
    return df.select(*columns)


def flag_bad_rows(df: DataFrame, types: dict[str, str], flag: str = "bad_columns") -> DataFrame:
    """Add the names of the columns whose text cannot be read as the wanted type."""
    bad = [
        F.when(F.col(name).isNotNull() & readable(F.col(name), kind).isNull(), F.lit(name))
        for name, kind in types.items()
    ]
    return df.withColumn(flag, F.concat_ws(",", *bad))


def reject_bad_rows(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split into readable rows, cast, and quarantined rows, as they came, with the reason."""
    flagged = flag_bad_rows(df, types)
    accepted = cast_columns(flagged.where("bad_columns = ''").drop("bad_columns"), types)
    return accepted, flagged.where("bad_columns <> ''")


def drop_header_row(df: DataFrame, header: list[str] | None = None) -> DataFrame:
    """Remove rows that repeat the header, for data that was loaded without regard to it.

    A predicate on the row, so nothing is shuffled and no order of rows is assumed.
    """
    labels = header or df.columns
    same = [F.col(f"`{c}`").eqNullSafe(F.lit(label)) for c, label in zip(df.columns, labels)]
    is_header: Column = reduce(lambda a, b: a & b, same)
    return df.where(~is_header)


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def dedupe_full_row(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedupe_by_key(df: DataFrame, key: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order``, then by the other columns.

    The rank filter is applied within each task before the shuffle, so that a hot key sends
    one row per task.
    """
    rest = [c for c in df.columns if c not in key]
    first = Window.partitionBy(*key).orderBy(*(order or []), *rest or key)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name, as joins by condition leave them."""
    slots = {}
    for i, name in enumerate(df.columns):
        slots.setdefault(name, f"_{i}")
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(slot).alias(name) for name, slot in slots.items()])
