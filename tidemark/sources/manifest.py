"""Ingest of landed files that a manifest lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.csv import CSV_FORMAT, scan_csv_checked, write_csv_quoted

# Keys of a manifest entry.
MANIFEST_SCHEMA = T.StructType([
    T.StructField("csv_relative_url", T.StringType()),
    T.StructField("file_name", T.StringType()),
])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per listed file, from a JSON array."""
    return spark.read.schema(MANIFEST_SCHEMA).json(path, multiLine=True)


def manifest_ingest(
    spark: SparkSession, manifest_path: str, landing: str, bronze: str, multi_line: set[str] = frozenset(),
    rejected: str | None = None,
) -> dict[str, str]:
    """Copy each listed file from ``landing`` to ``bronze`` under its name, fully quoted.

    The manifest has one entry per entity and is read on the driver; the files are read and
    written by tasks. Returns the Bronze path per file name. ``multi_line`` names the files
    whose quoted fields hold line breaks. With ``rejected``, lines that do not fit their header go
    below that folder under the file's name, with the reason; without it a plain read cuts or fills
    them up.
    """
    copied = {}
    for entry in read_manifest(spark, manifest_path).where(F.col("file_name").isNotNull()).toLocalIterator():
        name = entry.file_name
        if name in copied:
            raise ValueError(f"the manifest lists {name} twice")
        path = f"{landing.rstrip('/')}/{entry.csv_relative_url}"
        if rejected:
            rows, malformed = scan_csv_checked(spark, path, multi_line=name in multi_line)
            malformed.write.mode("overwrite").parquet(f"{rejected.rstrip('/')}/{name}")
        else:
            rows = spark.read.options(**CSV_FORMAT, header=True, multiLine=name in multi_line).csv(path)
        if name in multi_line:  # one task reads it; let several write it, and read it later
            rows = rows.hint("rebalance")
        copied[name] = f"{bronze.rstrip('/')}/{name}"
        write_csv_quoted(rows, copied[name])
    return copied


NAME, ORIGIN = "file_name", "_origin"


def _file_names(spark: SparkSession, landing: str, entries: list) -> DataFrame:
    """_path, file_name: the full path of each entry, a file or a folder, as Spark tells it of its rows."""
    root = spark._jvm.org.apache.hadoop.fs.Path(landing)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root)
    paths = [(spark._jvm.org.apache.hadoop.fs.Path(root, e.csv_relative_url).toUri().toString(), e.file_name) for e in entries]
    return spark.createDataFrame(paths, f"_path string, {NAME} string")


def _named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows with the name of the entry that their file is, or lies in."""
    # An empty authority is written with one slash or with three.
    short = [F.regexp_replace(c, "^([a-z0-9+.-]+):///", "$1:/") for c in ("_path", ORIGIN)]
    plain, placed = names.withColumn("_path", short[0]), rows.withColumn("_path", short[1])
    folder = plain.select(F.col("_path").alias("_folder"), F.col(NAME).alias("_of_folder"))
    found = placed.join(plain, "_path", "left").withColumn("_folder", F.regexp_replace("_path", "/[^/]*$", "")).join(folder, "_folder", "left")
    return found.withColumn(NAME, F.coalesce(NAME, "_of_folder")).drop(ORIGIN, "_path", "_folder", "_of_folder")


def manifest_ingest_entities(
    spark: SparkSession, manifest_path: str, landing: str, bronze: str, entities: dict[str, str],
    multi_line: set[str] = frozenset(), rejected: str | None = None,
) -> dict[str, list[str]]:
    """Copy all listed files to ``bronze``, those of an entity in one read and one write.

    ``entities`` gives the entity of each file name, ``multi_line`` the entities with line breaks in
    fields. All files of an entity have the columns of the first, in its order; a file that has
    not is refused, or with ``rejected`` its lines are. There are as many jobs as entities, however
    many files they have. A file lands in ``<entity>/file_name=<name>``, fully quoted, and with
    ``rejected`` its malformed lines there in the same way, with the reason. Returns the paths of
    each entity.
    """
    entries = list(read_manifest(spark, manifest_path).where(F.col(NAME).isNotNull()).toLocalIterator())  # a row per file
    names = [e.file_name for e in entries]
    twice = sorted({n for n in names if names.count(n) > 1}) if len(set(names)) < len(names) else []
    unknown = sorted(set(names) - set(entities))
    if twice or unknown:
        raise ValueError(f"listed twice: {', '.join(twice)}; without an entity: {', '.join(unknown)}")
    groups: dict[str, list] = {}
    for e in entries:
        groups.setdefault(entities[e.file_name], []).append(e)
    for entity, members in groups.items():
        paths, lines = [f"{landing.rstrip('/')}/{e.csv_relative_url}" for e in members], entity in multi_line
        origins = _file_names(spark, landing, members)
        if rejected:
            rows, malformed = scan_csv_checked(spark, paths, multi_line=lines, file=ORIGIN)
            _named(malformed, origins).write.mode("overwrite").partitionBy(NAME).parquet(f"{rejected.rstrip('/')}/{entity}")
        else:
            columns = spark.read.options(**CSV_FORMAT, header=True, multiLine=lines).csv(paths[0]).columns
            schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
            reader = spark.read.options(**CSV_FORMAT, header=True, multiLine=lines, enforceSchema=False).schema(schema)
            rows = reader.csv(paths).select("*", F.col("_metadata.file_path").alias(ORIGIN))
        target, quoted = f"{bronze.rstrip('/')}/{entity}", {**CSV_FORMAT, "header": True, "quoteAll": True}
        _named(rows, origins).hint("rebalance", NAME).write.options(**quoted).mode("overwrite").partitionBy(NAME).csv(target)
        for e in members:  # a file without rows is its header
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{NAME}={e.file_name}")
            if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
                rows.drop(ORIGIN).limit(0).coalesce(1).write.options(**quoted).csv(f"{target}/{NAME}={e.file_name}")
    return {entity: [f"{bronze.rstrip('/')}/{entity}/{NAME}={e.file_name}" for e in members] for entity, members in groups.items()}
