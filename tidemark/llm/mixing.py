"""Mixing sources to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ready, rows_of, running_sum, slice_bits, spread, word_count
from tidemark.session import stage

WEIGHTS = (5, 2, 1)    # by source, in the order of the code points, repeating
MOST_PASSES = 3        # a document may be taken so often at most
SLOT_BITS = 18         # 2^18 slots, more where a block would be longer than BLOCK_WORDS
BLOCK_WORDS = 512      # words of a slot at most
STRETCH = 1024         # slots that are looked up or added up together, at most


def sized(docs: DataFrame) -> DataFrame:
    """row, doc_id, mark, source, the number of words, and the place in the shuffle. To be staged: ``row`` tells copies apart."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        F.monotonically_increasing_id().alias("row"), doc_id.alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(doc_id.isNull(), F.col("text")).alias("mark"), word_count(F.col("text")).alias("size"),
        spread(F.lit("mix"), doc_id, F.col("text")).alias("place"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """Words to take of each source: source_no, source, source_size, target.

    All sizes are shared out by weight. No target is above ``most`` times its source's size:
    with the sources ordered by how soon they reach that limit, those below some place stop at
    it, and the others share what is left by weight. The place is the first where the shared
    level is within the next source's limit.
    """
    by_point = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("source_no"), F.lit(len(weights))) + 1).cast("int"))
    numbered = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("source_no", F.row_number().over(by_point) - 1)
    limited = numbered.withColumn("weight", weight).withColumn("limit", F.col("source_size").cast("double") * most)
    soonest = Window.orderBy(F.col("limit") / F.col("weight"), "source_no")
    everything = Window.partitionBy()
    shared = limited.withColumns({
        "total": F.sum("source_size").over(everything),
        "stopped": F.coalesce(F.sum("limit").over(soonest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "open": F.sum("weight").over(soonest.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    }).withColumn("level", (F.col("total") - F.col("stopped")) / F.col("open"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    # Past the first place that fits the levels only fall, so the first is the highest.
    return shared.withColumn("shared_level", F.max(fits).over(everything)).select(
        F.col("source_no").cast("long").alias("source_no"), "source", "source_size",
        F.least(F.col("limit"), F.coalesce(F.col("shared_level") * F.col("weight"), F.col("limit"))).alias("target"),
    )


def van_der_corput(slot: Column, bits: int) -> Column:
    """The slot's bits in reverse: a whole number of 0 to 2^bits-1, spread evenly at every length."""
    return F.conv(F.reverse(F.lpad(F.bin(slot), bits, "0")), 2, 10).cast("long")


def schedule(goals: DataFrame, block: int, bits: int) -> DataFrame:
    """The sources in the order in which training meets them: slot, source_no, begin, words.

    The targets, in whole words, lie end to end. Slot ``j`` takes the ``block`` words at the van
    der Corput point of ``j``, so that every stretch of the schedule has nearly the target weights
    and all slots together have the targets themselves; a slot across the end of a target is
    shared. ``begin`` is the number of words of the source in earlier slots. There are 2^bits
    slots, of which those beyond all targets are empty; the sources come to their slots by a join
    on strata, never one by one.
    """
    spark, points = goals.sparkSession, 1 << bits
    order = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    wanted = goals.select("source_no", F.rint("target").cast("long").alias("wanted")).withColumn("upto", F.sum("wanted").over(order))
    ranges = wanted.where("wanted > 0").select("source_no", (F.col("upto") - F.col("wanted")).alias("from"), "upto")
    width = max(1, min(points // STRETCH, STRETCH))
    ranges = ranges.withColumn("stratum", F.explode(F.sequence(
        F.expr(f"`from` div {block * width}"), F.expr(f"(upto - 1) div {block * width}")
    )))
    slots = spark.range(points).select(F.col("id").alias("slot"), van_der_corput(F.col("id"), bits).alias("point"))
    slots = slots.select("slot", F.expr(f"point div {width}").alias("stratum"), (F.col("point") * block).alias("low"))
    words = F.least("upto", F.col("low") + block) - F.greatest("from", "low")
    placed = slots.join(ranges, "stratum").select("slot", "source_no", words.alias("words")).where("words > 0")
    # The words of earlier slots: stretches of the schedule are added up first, then the slots inside.
    stretch = max(1, min(points // 256, STRETCH))
    placed = placed.withColumn("stretch", F.expr(f"slot div {stretch}"))
    sums = placed.groupBy("source_no", "stretch").agg(F.sum("words").alias("n"))
    lower = Window.partitionBy("source_no").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_no", "stretch", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("earlier"))
    before = Window.partitionBy("source_no", "stretch").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("inside", F.coalesce(F.sum("words").over(before), F.lit(0))).join(offsets, ["source_no", "stretch"])
    return ranked.select("slot", "source_no", (F.col("earlier") + F.col("inside")).alias("begin"), "words")


def _cut(spans: DataFrame, block: int, *names: str) -> DataFrame:
    """The spans ``low`` to ``high`` cut at the multiples of ``block``, each piece with the block that it is in."""
    cut = spans.where("high > low").withColumn("block", F.explode(F.sequence(F.expr(f"low div {block}"), F.expr(f"(high - 1) div {block}"))))
    low, high = F.greatest("low", F.col("block") * block), F.least("high", (F.col("block") + 1) * block)
    return cut.select(*names, "source_no", "block", low.alias("low"), high.alias("high"))


def blocks(sizes: DataFrame, goals: DataFrame, block: int, bits: int) -> DataFrame:
    """Documents cut into blocks: row, source_no, block, and the words of the source, low to high.

    The documents of a source lie end to end in a shuffled order; block ``k`` is the words from
    ``k * block`` on. A document has a row for each block that it reaches into.
    """
    named = sizes.where("size > 0").join(
        goals.select("source", "source_no"), sizes["source"].eqNullSafe(goals["source"])
    ).select("row", "size", "place", "source_no")
    laid = running_sum(named, ["source_no"], ["place", "row"], "size", "low", bits)
    return _cut(laid.withColumn("high", F.col("low") + F.col("size")), block, "row")


def passes(slots: DataFrame, goals: DataFrame, block: int) -> DataFrame:
    """What the slots take of each source, cut into blocks: source_no, block, low, high.

    A source's words are read in turn, from the first again after the last, so that a slot may
    take the end of one pass and the beginning of the next, or several passes of a short source.
    """
    read = slots.join(goals.select("source_no", "source_size"), "source_no").withColumn("end", F.col("begin") + F.col("words"))
    read = read.withColumn("pass", F.explode(F.sequence(F.expr("begin div source_size"), F.expr("(end - 1) div source_size"))))
    first = F.col("pass") * F.col("source_size")
    return _cut(read.select(
        "source_no", (F.greatest("begin", first) - first).alias("low"), (F.least("end", first + F.col("source_size")) - first).alias("high")
    ), block)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES, slot_bits: int = SLOT_BITS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (and its mark).

    ``taken`` is the number of words that the schedule takes of it, repeats counted. The slots of
    a source read its words one after another; a pass over a source ends before the next begins,
    and there are ``most`` passes at most. Slots grow in number with the text, to BLOCK_WORDS words
    each at most, and a source of any size is met to the word.

    Null texts and texts without words have size 0 and are never taken. A null source is a
    source of its own, last in the order. Copies of a row are documents of
    their own. Nothing at all to take gives targets of 0. An empty table gives no rows. Other columns are not read.
    """
    spark = ready(docs.sparkSession)
    sizes = stage(sized(docs), "mix_sizes")
    goals = stage(targets(sizes, weights, most), "mix_targets")
    total, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    wanted = goals.agg(F.coalesce(F.sum(F.rint("target").cast("long")), F.lit(0))).first()[0]
    bits = max(min(slot_bits, max(0, total.bit_length() - 1)), (wanted // BLOCK_WORDS).bit_length())
    block = max(1, -(-wanted // (1 << bits)))
    read = passes(schedule(goals, block, bits), goals, block).select(
        "source_no", "block", F.col("low").alias("from"), F.col("high").alias("upto")
    )
    words = F.least("high", "upto") - F.greatest("low", "from")
    taken = (
        blocks(sizes, goals, block, slice_bits(rows)).join(read, ["source_no", "block"])
        .select("row", words.alias("words")).where("words > 0").groupBy("row").agg(F.sum("words").alias("taken"))
    )
    named = sizes.join(goals, sizes["source"].eqNullSafe(goals["source"]))
    return named.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "mark"
    )


def mixed_rows(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as the mix takes it, to the nearest whole.

    Rows without words cost nothing and stay once.
    """
    each = mix(docs)
    times = F.when(F.col("size") == 0, 1).otherwise(F.rint(F.col("taken") / F.col("size")).cast("int"))
    wanted = each.groupBy("doc_id", "mark").agg(F.sum(times).cast("int").alias("times")).where("times > 0")
    return rows_of(docs, wanted, times="times")
