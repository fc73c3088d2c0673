"""Event files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import stage
from tidemark.sources.tables import few_values, one_row, table_or_empty

LATENESS = "1 day"
WINDOW = "1 day"


def event_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Event files that land in a folder, oldest first, with event time as a zoned timestamp."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Watermarks are not defined on wall-clock times.
    return reader.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def daily_counts(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Events per day and type; repeated ids and rows later than the watermark are left out.

    Works on a stream and, without the watermark's effect, on a bounded frame.
    """
    counted = events.withWatermark("ts", lateness)
    if events.isStreaming:
        counted = counted.dropDuplicatesWithinWatermark(["event_id"])
    else:
        counted = counted.dropDuplicates(["event_id"])
    return counted.groupBy(F.window("ts", WINDOW), "event_type").agg(F.count(F.lit(1)).alias("events")).select(
        F.to_date("window.start").alias("day"), "event_type", "events"
    )


def stream_ingest(counts: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append the closed days to a table; the checkpoint makes a restart go on where it broke off.

    Takes all files there are, in several batches if the source limits them, then stops.
    """
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


DAY, BATCH = "day", "batch"
_MARK = T.StructType([T.StructField("mark", T.TimestampType()), T.StructField(BATCH, T.LongType())])


def _stored(schema: T.StructType, *more: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *more, T.StructField(BATCH, T.LongType())])


def keep_batch(batch: DataFrame, number: int, root: str, lateness: str = LATENESS) -> None:
    """Write one batch of events below ``root``: rows in time to ``events``, late ones to ``late``.

    A row is late if it is older than the newest of all earlier batches by more than ``lateness``. Of
    an event_id one row is kept, the first by time, in the batch that first brings it in time. All
    folders carry the batch's number and are replaced if it is written again, so a batch that broke
    off anywhere is simply written again. Only the days that the batch has rows of are opened.
    """
    spark = batch.sparkSession
    schema, day = batch.schema, T.StructField(DAY, T.DateType())
    rows = stage(batch, "batch")
    marks = table_or_empty(spark, f"{root}/marks", _MARK).where(F.col(BATCH) < number)
    newest = one_row(marks.agg(F.max("mark")))[0]
    limit = F.lit(newest) - F.expr(f"INTERVAL {lateness}") if newest else None
    is_late = F.coalesce(F.col("ts") < limit, F.lit(False)) if newest else F.lit(False)
    rows.where(is_late).write.mode("overwrite").parquet(f"{root}/late/{BATCH}={number}")

    in_time = rows.where(~is_late).withColumn(DAY, F.to_date("ts"))
    days = few_values(in_time.select(DAY))
    known = table_or_empty(spark, f"{root}/events", _stored(schema, day)).where(F.col(BATCH) < number)
    known = known.where(F.col(DAY).isin(days) | F.col(DAY).isNull()).select("event_id").distinct()
    first = in_time.groupBy("event_id").agg(F.min(F.struct("ts", *[c for c in in_time.columns if c != "ts"])).alias("_row"))
    fresh = first.join(known, "event_id", "left_anti").select("_row.*").select(*in_time.columns)
    fresh.withColumn(BATCH, F.lit(number).cast("long")).hint("rebalance", DAY).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(f"{root}/events")
    rows.agg(F.max("ts").alias("mark")).write.mode("overwrite").parquet(f"{root}/marks/{BATCH}={number}")


def stream_keep_late(events: DataFrame, root: str, checkpoint: str, lateness: str = LATENESS) -> StreamingQuery:
    """Append a stream of events below ``root`` and set late rows aside instead of dropping them.

    Takes all files there are, then stops; a restart goes on where it broke off. See ``keep_batch``.
    """
    return (
        events.writeStream.foreachBatch(lambda batch, number: keep_batch(batch, number, root, lateness))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def kept_and_late(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """day, event_type, events and late: what has come in time and what has not."""
    kept = table_or_empty(spark, f"{root}/events", _stored(schema, T.StructField(DAY, T.DateType())))
    late = table_or_empty(spark, f"{root}/late", _stored(schema)).withColumn(DAY, F.to_date("ts"))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = kept.select(DAY, "event_type", one.alias("events"), none.alias("late")).unionByName(
        late.select(DAY, "event_type", none.alias("events"), one.alias("late")))
    return both.groupBy(DAY, "event_type").agg(F.sum("events").alias("events"), F.sum("late").alias("late"))
