"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ready
from tidemark.session import stage

TABLES = 12
AXES = 32       # of the rotated vector; a table has 2 * AXES buckets
PROBES = 6      # buckets of each table that a query looks into
BLOCK = 2048    # vectors of a bucket that are compared at once with up to QUERY_BLOCK queries
QUERY_BLOCK = 4096
_SEED = 0x5EED


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def _axes(vectors: np.ndarray, tables: int, axes: int):
    """For each table the products of each vector's direction with the axes."""
    size = 1 << max(1, int(vectors.shape[1]).bit_length())
    padded = np.zeros((len(vectors), size))
    padded[:, :vectors.shape[1]] = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    signs = np.random.default_rng(_SEED).choice([-1.0, 1.0], (tables, 3, size))
    for t in range(tables):
        turned = padded
        for s in signs[t]:
            turned = _hadamard(turned * s)
        yield turned[:, :min(axes, size)]


def _nearest(products: np.ndarray, axes: int, probes: int) -> np.ndarray:
    """The first ``probes`` buckets of each row by product, of the first ``axes`` axes with either sign."""
    signed = np.concatenate([products[:, :axes], -products[:, :axes]], axis=1)
    return np.argsort(-signed, axis=1, kind="stable")[:, :probes]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length without nulls as the rows of a matrix."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks])
    return values.astype(np.float64).reshape(len(column), -1)


def _hashed(vectors: DataFrame, levels: list[int], tables: int, probes: int | None) -> DataFrame:
    """node, smallest, vector, axes, cells: a row for each level, with the buckets that the vector is in or, with ``probes``, looks into.

    A level is a number of axes, and 0 is the level that is compared whole: one bucket of one table.
    A vector is in its own level ``axes``, a query looks into all ``levels``. ``cells`` numbers the
    buckets of all tables of a level, so that a vector is one row until it is sent to them.
    """
    def assign(parts):
        for batch in parts:
            if not len(batch):
                continue
            own = None if probes else batch.column(3).to_numpy()
            products = list(_axes(_matrix(batch.column(2)), tables, max(levels)))
            for level in levels:
                some = np.arange(len(batch)) if probes else np.flatnonzero(own == level)
                if not len(some):
                    continue
                if level:
                    cells = np.concatenate([_nearest(p[some], level, probes or 1) + 2 * level * t for t, p in enumerate(products)], axis=1)
                else:
                    cells = np.zeros((len(some), 1), np.int64)
                ends = np.arange(len(some) + 1, dtype=np.int32) * cells.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pa.array(some)) for c in range(3)], pa.array(np.full(len(some), level)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(cells.ravel()))],
                    ["node", "smallest", "vector", "axes", "cells"],
                )

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.mapInArrow(assign, f"node long, smallest long, vector {kind}, axes long, cells array<long>")


def _levels(bands: list[tuple[int, int]], axes: int, probes: int) -> dict[int, int]:
    """The axes for each band of lengths, from the longest band on, given with the numbers of their vectors.

    A long vector is among the nearest of queries that are far from it by direction, which hashing
    finds by chance only. So a band's axes are the part of all that its vectors and the longer ones
    are of the table: the fewer, the more of them a query is compared with, and with so few axes
    that a query would look into every bucket, they are compared whole.
    """
    total, so_far, found = sum(n for _, n in bands), 0, {}
    for band, n in sorted(bands):
        so_far += n
        part = -(-axes * so_far // total)
        found[band] = 0 if 2 * part <= probes else part
    return found


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, vector of the rows that take part: no null, no null or non-finite component, not all zeros.

    Components of four bytes stay so, which halves what is shuffled; all else is taken as double.
    """
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    vector = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.coalesce(finite & some, F.lit(False))
    )


def _compared(asked: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """query, node, smallest, score: of each block of a cell the k + 1 nearest of each query, ties to the smallest id.

    Vectors are sent to their cells once, from where they lie; what is counted before needs the cells only.
    """
    cell = ["axes", "cell"]
    asked, index = (rows.withColumn("cell", F.explode("cells")).drop("cells") for rows in (asked, index))

    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
        return rows.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    def every(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    def one(name: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(name)).cast("int")

    cells = blocks(index, BLOCK, "lefts").join(blocks(asked.select(*cell), QUERY_BLOCK, "rights"), cell)
    sent = asked.join(cells, cell).withColumn("left", every("lefts")).withColumn("right", one("rights"))
    kept = index.join(cells, cell).withColumn("left", one("lefts")).withColumn("right", every("rights"))
    cell = [*cell, "left", "right"]

    def compare(key, left, right):
        out = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("smallest", pa.int64()), ("score", pa.float64())])
        if not len(left) or not len(right):
            return out.empty_table()
        queries, candidates = (_matrix(t.column("vector")) for t in (left, right))
        query, node = (t.column("node").to_numpy() for t in (left, right))
        id_, wanted, found = right.column("smallest").to_numpy(), min(k + 1, len(node)), []
        # The sums of a product in any two orders are no further apart than this.
        most = np.sqrt((candidates / (scale := np.abs(candidates).max())) ** 2 @ np.ones(candidates.shape[1])).max() * scale
        slack = 4 * queries.shape[1] * np.finfo(float).eps * most
        for i in range(0, len(query), 256):
            some = queries[i:i + 256]
            products = some @ candidates.T
            last = -np.partition(-products, wanted - 1, axis=1)[:, wanted - 1]
            high = np.abs(some).max(axis=1)
            near = products >= (last - slack * high * np.sqrt(((some / high[:, None]) ** 2).sum(axis=1)))[:, None]
            q, c = np.nonzero(near)
            exact = np.concatenate([(some[q[j:j + 8192]] * candidates[c[j:j + 8192]]).sum(axis=1) for j in range(0, len(q), 8192)])
            order = np.lexsort((id_[c], -exact, q))
            q, c, exact = q[order], c[order], exact[order]
            keep = np.arange(len(q)) - np.searchsorted(q, q) < wanted
            found.append((query[i + q[keep]], node[c[keep]], id_[c[keep]], exact[keep]))
        return pa.table([np.concatenate(c) for c in zip(*found, strict=True)], schema=out)

    return sent.select(*cell, "node", "vector").groupBy(*cell).cogroup(
        kept.select(*cell, "node", "vector", "smallest").groupBy(*cell)
    ).applyInArrow(compare, "query long, node long, smallest long, score double").groupBy("query", "node", "smallest").agg(F.max("score").alias("score"))


def _best(pairs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """query, score, ids of the k + 1 nearest nodes of each query, itself included."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), "smallest")
    ranked = pairs.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    return ranked.join(ids, "node").select("query", "score", "ids")


def search(
    vectors: DataFrame, k: int = 20, every: int = 20, tables: int = TABLES, axes: int = AXES, probes: int = PROBES,
) -> DataFrame:
    """The nearest found of each query: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all but the query's
    own row. Nearest is the largest inner product of the vectors as given, in double precision;
    ties go to the smaller vec_id. Every row is in one bucket of each table; a query looks into
    ``probes`` buckets of each and its candidates are compared exactly. Vectors are hashed by
    direction; those of unequal length lie in bands of lengths by powers of two below the longest,
    and longer bands have tables of their own with fewer buckets (``_levels``). All are searched.

    Equal vectors are one node, searched for and compared once, and come back at the end as
    their k + 1 smallest ids, which is all that a list can need. A bucket is cut into blocks of
    about BLOCK vectors and QUERY_BLOCK queries, each compared with each, and a block gives k + 1
    rows a query at most. Vectors of another length than most, of which there are none in a table
    of one model, raise.

    A query that has found fewer than ``k`` looks into all other buckets too, that is, it is compared
    with every vector. Its own buckets hold no more than ``k`` vectors, so there are at most
    2 * ``axes`` * ``k`` such queries a level, however large the table is.

    Left out as candidates and as queries: null ids, null vectors, and vectors that are zero or
    hold null or non-finite components. Rows of equal vec_id and vector are one. A query without
    candidates has no rows, and an empty table gives none. Other columns are not read.
    """
    ready(vectors.sparkSession)
    rows = valid(vectors)
    asks = F.pmod("vec_id", F.lit(every)) == 0
    lowest = Window.partitionBy("vector", "asks").orderBy("vec_id")
    few = rows.distinct().withColumn("asks", asks).withColumn("n", F.row_number().over(lowest)).where(F.col("n") <= k + 1)
    # Lengths as logarithms, which neither overflow nor vanish.
    most = F.array_max(F.transform("vector", F.abs))
    length = F.log2(most) + F.log2(F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / most) * (x / most))) / 2
    nodes = stage(
        few.groupBy("vector").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"), F.max("asks").alias("asks"))
        .select(F.monotonically_increasing_id().alias("node"), "vector", "ids", "asks", length.alias("length")), "vectors",
    )
    longest, short, long = nodes.agg(F.max("length"), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if short != long:
        raise ValueError(f"vectors of {short} to {long} components")

    banded = nodes.withColumn("band", F.floor(F.lit(longest or 0.0) - F.col("length")).cast("int"))
    level = _levels([tuple(r) for r in banded.groupBy("band").count().collect()], axes, probes)
    levels, by_band = sorted(set(level.values())) or [axes], F.create_map(*[F.lit(x) for pair in level.items() for x in pair])
    smallest = F.col("ids")[0].alias("smallest")
    own = banded.select("node", smallest, "vector", (by_band[F.col("band")] if level else F.lit(axes)).cast("long").alias("axes"))
    index = stage(_hashed(own, levels, tables, None), "index")
    asking, ids = nodes.where("asks").select("node", smallest, "vector"), nodes.select("node", "ids")
    pairs = _compared(_hashed(asking, levels, tables, probes), index, k)
    found = stage(_best(pairs, ids, k), "found")
    few = found.groupBy("query").agg(F.sum(F.size("ids")).alias("n")).where(F.col("n") <= k).select(F.col("query").alias("node"))
    whole = [F.lit(0).cast("long").alias("axes"), F.array(F.lit(0).cast("long")).alias("cells")]
    if not few.isEmpty():
        # New names on one side: both sides of a cell come from one table here.
        asked = asking.join(few, "node").select(F.col("node").alias("asked"), F.col("vector").alias("asking"), *whole).toDF("node", "vector", "axes", "cells")
        all_ = _compared(asked, nodes.select("node", smallest, "vector", *whole), k)
        rest = found.join(few.withColumnRenamed("node", "query"), "query", "left_anti")
        found = rest.unionByName(_best(all_, ids, k))
    listed = found.groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("found"))

    # Each query of a node takes the node's list without itself.
    queries = rows.where(asks).distinct().join(nodes.where("asks").select("vector", F.col("node").alias("query")), "vector")
    # Of a node's own ids a query needs k others, and its own may be beyond those listed.
    near = queries.select("query", F.col("vec_id").alias("query_id")).join(listed, "query").select(
        "query_id", F.explode("found").alias("one")
    ).select("query_id", "one.score", F.explode("one.ids").alias("vec_id")).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
