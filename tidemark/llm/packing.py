"""Packing documents into batches: optimal length buckets and a token budget."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ready, running_sum, slice_bits, spread, word_count
from tidemark.session import stage

BUCKETS = 16
TOKEN_BUDGET = 65_536   # tokens of a batch, padding included
EXACT_LENGTHS = 512     # up to here each length is a bin of its own
_OCTAVE_BITS = 8        # beyond, an octave has 256 bins


def length_bin(tokens: Column) -> Column:
    """The least bin bound that holds a length: the length itself up to 512, then 256 to the octave.

    So the histogram has a few thousand bins for lengths of any size.
    """
    octave = F.floor(F.log2(F.greatest(tokens - 1, F.lit(1)).cast("double")))
    step = F.pow(F.lit(2.0), F.greatest(octave - _OCTAVE_BITS, F.lit(0)))
    return F.when(tokens <= EXACT_LENGTHS, tokens).otherwise(F.ceil(tokens / step) * step).cast("long")


def best_bounds(bins: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The bounds, at most ``buckets``, that minimise the padded total; the last bin is one of them.

    ``cost[k][j]`` is the least padded total of the first ``j`` bins in ``k`` buckets; a bucket
    of the bins ``i`` to ``j`` costs its documents times its greatest bin.
    """
    upto = np.concatenate([[0], np.cumsum(counts, dtype=np.float64)])
    n = len(bins)
    cost, cuts = np.full(n + 1, np.inf), []
    cost[0] = 0.0
    for _ in range(min(buckets, n)):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0.0
        for j in range(1, n + 1):
            total = cost[:j] + bins[j - 1] * (upto[j] - upto[:j])
            cut[j] = np.argmin(total)
            new[j] = total[cut[j]]
        cost = new
        cuts.append(cut)
    bounds, j = [], n
    for cut in reversed(cuts):
        if j:
            bounds.append(int(bins[j - 1]))
            j = int(cut[j])
    return bounds[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket_tokens, batch, slot, batch_docs.

    A token is a word. The bucket bounds minimise the padding over the histogram of all lengths,
    which has a few thousand rows whatever the input and is all that comes to the driver.
    Beyond EXACT_LENGTHS words a bound lies on the edge of a bin, 1/256 of an octave at most from the best one.
    ``bucket_tokens`` is the length to which a document is padded, that of the longest in its bucket. In a bucket the documents lie
    in a shuffled order, and each ``batch_docs`` of them, as many as the budget holds, are a
    batch: ``batch`` numbers them from 0 within the bucket, ``slot`` within the batch.

    A document longer than the budget is a batch of its own and is not cut. Null texts and texts
    without words have no tokens and go to the smallest bucket. Repeated rows are packed each.
    An empty table gives no rows. Other columns are not read.
    """
    ready(docs.sparkSession)
    tokens = word_count(F.col("text"))
    lengths = stage(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), tokens.alias("n_tokens"),
        length_bin(tokens).alias("bin"), spread(F.lit("pack"), "doc_id", "text").alias("place"), F.lit(1).cast("long").alias("one"),
    ), "pack_lengths")
    histogram = lengths.groupBy("bin").agg(F.count(F.lit(1)).alias("docs")).orderBy("bin").collect()
    bins, counts = (np.array([r[i] for r in histogram], np.int64) for i in (0, 1))
    bounds = best_bounds(bins, counts, buckets) if len(bins) else [0]
    # A bin is as wide as its octave asks; the longest document that lies in a bucket is what it pads to.
    bucket = F.element_at(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b >= F.col("bin")), 1)
    longest = {r.bound: r.longest for r in lengths.groupBy(bucket.alias("bound")).agg(F.max("n_tokens").alias("longest")).collect()}
    bucket = F.element_at(F.filter(F.array(*[F.struct(F.lit(b).cast("long").alias("bound"), F.lit(longest.get(b, b)).cast("long").alias("longest"))
                                             for b in bounds]), lambda b: b["bound"] >= F.col("bin")), 1)["longest"]
    placed = lengths.withColumn("bucket_tokens", bucket)
    ranked = running_sum(placed, ["bucket_tokens"], ["place", "row"], "one", "rank", slice_bits(int(counts.sum())))
    held = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_tokens"), F.lit(1)))).cast("long")
    return ranked.withColumn("batch_docs", held).select(
        "doc_id", "n_tokens", "bucket_tokens", F.expr("rank div batch_docs").alias("batch"), F.expr("rank % batch_docs").alias("slot"), "batch_docs"
    )
