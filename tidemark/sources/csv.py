"""Delimited text: reading by header, by position, with inference; writing fully quoted."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the raw files: separator, quote and escape. The escape must be the same on
# both sides, else fields that hold quotes come back split. Blanks around a field are kept.
CSV_FORMAT = {
    "sep": ",", "quote": '"', "escape": "\\", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def scan_csv_quoted(
    spark: SparkSession, path: str | list[str], columns: list[str], multi_line: bool = False
) -> DataFrame:
    """Read files with a header row; every column is text, found by its header.

    ``multi_line`` allows line breaks inside quoted fields. Such a file cannot be split, so
    ask for it only where the text needs it, and land that entity in many files.
    """
    reader = spark.read.options(**CSV_FORMAT, header=True, multiLine=multi_line)
    return reader.csv(path).select(*[f"`{c}`" for c in columns])


LINE, REASON, FAULT = "line", "reason", "_malformed"
FIELD_COUNT, OPEN_QUOTE = "field count", "open quote"


def scan_csv_checked(
    spark: SparkSession, path: str | list[str], columns: list[str] | None = None, multi_line: bool = False,
    file: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Read files with a header row, and tell lines that are no row of theirs from the others.

    Returns the rows, every column text, found by its header, and the malformed lines as they
    came, with the reason: they have more or fewer fields than the header, or a quote that does
    not close. A plain read would cut or fill up such a line. Every line is in one of the two,
    but for blank ones and those that repeat the header. All files have the header of the first.

    ``file`` names a column for the file that a row or line comes from.

    A quote that does not close ends with its line. With ``multi_line`` it ends with its file:
    what follows it cannot be told apart, and is one malformed record.
    """
    names = spark.read.options(**CSV_FORMAT, header=True, multiLine=multi_line).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, FAULT]])
    options = {**CSV_FORMAT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": FAULT, "columnPruning": False}
    origin = F.col("_metadata.file_path").alias(file or "_file")
    if multi_line:
        parsed = spark.read.options(**options, header=True, multiLine=True).schema(schema).csv(path)
        parsed = parsed.select("*", F.col(FAULT).alias(LINE), F.lit(False).alias("_open"), origin)
    else:
        texts = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "columnPruning"}
        ddl = ", ".join(f"`{c}` STRING" for c in schema.names)
        lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
        # What is left of a line without escaped characters and anything but quotes.
        quotes = F.length(F.regexp_replace("value", r'\\.|[^"]', ""))
        parsed = lines.select("value", F.from_csv("value", ddl, texts).alias("_row"), (quotes % 2 == 1).alias("_open"), origin)
        parsed = parsed.select(*[F.col(f"_row.`{c}`") for c in schema.names], F.col("value").alias(LINE), "_open", file or "_file")
        header = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.lit(c)) for c in names])
        parsed = parsed.where(~header)
    bad = F.col(FAULT).isNotNull() | F.col("_open")
    reason = F.when(F.col("_open"), OPEN_QUOTE).otherwise(FIELD_COUNT)
    origins = [file] if file else []
    good = parsed.where(~bad).select(*[f"`{c}`" for c in columns or names], *origins)
    # Spark reads no file for the corrupt record alone: ask for the fields too.
    fields = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in names])) >= 0
    return good, parsed.where(bad & fields).select(LINE, reason.alias(REASON), *origins)


def scan_csv_positional(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """Read files without a header row as text columns ``_c0`` … and name them in order."""
    positions = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
    return spark.read.options(**CSV_FORMAT).schema(positions).csv(path).toDF(*names)


def scan_csv_infer(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read files with a header row and guess the types, at the price of a second pass."""
    return spark.read.options(**CSV_FORMAT, header=True, inferSchema=True).csv(path)


def write_csv_quoted(df: DataFrame, path: str, header: bool = True) -> None:
    """Write with every field quoted."""
    df.write.options(**CSV_FORMAT, header=header, quoteAll=True).mode("overwrite").csv(path)
