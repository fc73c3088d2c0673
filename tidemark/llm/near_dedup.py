"""Near-duplicates by MinHash, banding, verification and connected components."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, marked, mix, ready, rows_of, shingles, whole_text, word_hashes
from tidemark.llm.components import components
from tidemark.session import stage

BANDS, ROWS = 40, 6     # two sets of similarity 0.8 miss all bands once in 190,000 pairs
MARGIN = 0.13           # five standard deviations of a similarity of 0.8 seen through 240 minima
BLOCK = 1024            # members of a bucket compared in one task, with as many others
_SEED = 0x5EED


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(_SEED)
    odd = r.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
    return odd, r.integers(0, 1 << 32, n, dtype=np.uint32)


def _minima(values: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The minimum of each hash ``odd * x + add`` modulo 2^32 over the set."""
    x, least = (values >> np.uint64(32)).astype(np.uint32), np.full(len(odd), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 256):
        least = np.minimum(least, (x[i:i + 256, None] * odd + add).min(axis=0))
    return least


def signatures(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, mark, n_shingles, set_key, bands, minima of each document, in one pass over the texts.

    ``set_key`` is a digest of the sorted shingles, null for an empty set; ``bands`` has a hash
    of each band's minima; ``minima`` the low byte of every minimum, for verification.
    """
    odd, add = _coefficients(bands * rows)
    fold = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    number = mix(np.arange(bands, dtype=np.uint64) + np.uint64(77))

    def sign(parts):
        for rest, texts in batches(parts):
            hashes, begins = word_hashes(texts)
            sizes, keys, band_rows, low = [], [], [], []
            known: dict[bytes, tuple] = {}
            for i in range(len(texts)):
                own = shingles(hashes[begins[i]:begins[i + 1]], words)
                sizes.append(len(own))
                if not len(own):
                    keys.append(None), band_rows.append(None), low.append(None)
                    continue
                key = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                if key not in known:
                    least = _minima(own, odd, add)
                    band = mix((least.reshape(bands, rows).astype(np.uint64) * fold).sum(axis=1, dtype=np.uint64) ^ number)
                    known[key] = band.view(np.int64), least.astype(np.uint8).tobytes()
                keys.append(key), band_rows.append(known[key][0]), low.append(known[key][1])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(band_rows, pa.list_(pa.int64())), pa.array(low, pa.binary())],
                ["doc_id", "mark", "n_shingles", "set_key", "bands", "minima"],
            )

    return marked(docs).select("doc_id", "mark", whole_text().alias("text")).mapInArrow(
        sign, "doc_id long, mark long, n_shingles long, set_key binary, bands array<long>, minima binary"
    )


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs u, v whose minima agree as those of sets of similarity ``least`` would."""
    minima = sets.select("node", "minima")
    both = pairs.join(minima.withColumnsRenamed({"node": "u", "minima": "mu"}), "u").join(
        minima.withColumnsRenamed({"node": "v", "minima": "mv"}), "v"
    ).select("u", "v", "mu", "mv")

    def estimate(parts):
        for batch in parts:
            if not len(batch):
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(len(batch), -1) for c in (2, 3))
            share = _share(a, b)
            good = share >= least
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(good)), batch.column(1).filter(pa.array(good)), pa.array(share[good])], ["u", "v", "share"]
            )

    return both.mapInArrow(estimate, "u long, v long, share double")


def _linked(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets have ``100 * intersection >= percent * union``."""
    sides = pairs.select("u", "v").join(texts.withColumnsRenamed({"node": "u", "text": "tu"}), "u").join(
        texts.withColumnsRenamed({"node": "v", "text": "tv"}), "v"
    ).select("u", "v", "tu", "tv")

    def confirm(parts):
        for batch in parts:
            u, v, tu, tv = batch.columns
            good = []
            for i in range(len(batch)):
                hashes, at = word_hashes([tu[i].as_py(), tv[i].as_py()])
                a, b = shingles(hashes[at[0]:at[1]], words), shingles(hashes[at[1]:at[2]], words)
                common = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * common >= percent * (len(a) + len(b) - common))
            good = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([u.filter(good), v.filter(good)], ["u", "v"])

    return sides.mapInArrow(confirm, "u long, v long")


def _share(minima: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The similarity that minima show; unequal ones share a low byte once in 256 times."""
    return ((minima == one).mean(axis=1) - 1 / 256) / (255 / 256)


class _Forest:
    """Roots of a few members, joined as links are found."""

    def __init__(self, roots: np.ndarray):
        self.root = np.unique(roots, return_inverse=True)[1]

    def join(self, a: int, b: int) -> None:
        self.root[self.root == self.root[a]] = self.root[b]


def _cells(members: DataFrame, group: str, sizes: DataFrame) -> DataFrame:
    """The members of each group cut into parts of about BLOCK; each two parts are a cell i, j.

    ``sizes`` has the groups and their sizes n.
    """
    parts = sizes.select(group, F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("member"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return members.join(parts, group).withColumn("part", part).withColumn("other", other).select(
        group, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "member", "root"
    )


def _cell_pairs(key, table, least: float, linked=None) -> pa.Table:
    """Pairs of a cell whose minima agree, or that ``linked`` confirms, and that join two trees.

    Members with one root are joined already. A pair is given only if no path of pairs found
    before it joins its members, so a cell gives fewer pairs than it has members.
    """
    i, j = key[1].as_py(), key[2].as_py()
    member, part = (table.column(c).to_numpy() for c in ("member", "part"))
    minima = np.frombuffer(b"".join(table.column("minima").to_pylist()), np.uint8).reshape(len(member), -1)
    forest, found = _Forest(table.column("root").to_numpy()), []
    right = np.flatnonzero(part == j)
    for a in np.flatnonzero(part == i):
        near = right[forest.root[right] != forest.root[a]]
        if len(near):
            share = _share(minima[near], minima[a])
            for b in near[np.argsort(-share, kind="stable")][:int((share >= least).sum())]:
                if forest.root[a] != forest.root[b] and (linked is None or linked(a, b)):
                    forest.join(a, b)
                    found.append(sorted((int(member[a]), int(member[b]))))
    return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})


def _across(members: DataFrame, roots: DataFrame, sets: DataFrame, pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The links between components that the stars have missed.

    First the members of each bucket are compared by their minima: that joins to one cluster
    whatever may still be linked, without giving all pairs. Then each cluster of more than one
    component is cut into cells, and there the full sets of all pairs that agree and are not
    joined yet are compared.
    """
    least = percent / 100 - MARGIN
    minima = sets.select(F.col("node").alias("member"), "minima")
    rooted = members.join(roots.withColumnRenamed("node", "member"), "member", "left").withColumn("root", F.coalesce("root", "member"))
    unlike = [F.count(F.lit(1)).alias("n"), F.min("root").alias("a"), F.max("root").alias("b")]
    open_ = rooted.groupBy("bucket").agg(*unlike).where("n > 2 AND a <> b")  # of two members the star has the only pair
    agreeing = _cells(rooted, "bucket", open_).join(minima, "member").groupBy("bucket", "i", "j").applyInArrow(
        lambda key, table: _cell_pairs(key, table, least), "u long, v long"
    )
    one = lambda side: roots.withColumnsRenamed({"node": side, "root": f"{side}_root"})
    maybe = pairs.select("u", "v").union(agreeing).join(one("u"), "u", "left").join(one("v"), "v", "left").select(
        F.coalesce("u_root", "u").alias("u"), F.coalesce("v_root", "v").alias("v")
    )
    clusters = components(maybe).select(F.col("node").alias("root"), F.col("root").alias("cluster"))
    nodes = members.select("member").distinct().join(roots.withColumnRenamed("node", "member"), "member", "left").withColumn(
        "root", F.coalesce("root", "member")
    ).join(clusters, "root")
    sizes = nodes.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))

    def confirm(key, table):
        text, sides = table.column("text"), {}

        def side(k):
            if k not in sides:
                sides[k] = shingles(word_hashes([text[int(k)].as_py()])[0], words)
            return sides[k]

        def linked(a, b):
            common = len(np.intersect1d(side(a), side(b), assume_unique=True))
            return 100 * common >= percent * (len(side(a)) + len(side(b)) - common)

        return _cell_pairs(key, table, least, linked)

    return _cells(nodes, "cluster", sizes).join(minima, "member").join(texts.withColumnRenamed("node", "member"), "member").groupBy(
        "cluster", "i", "j"
    ).applyInArrow(confirm, "u long, v long")


def _decided(docs: DataFrame, words: int, percent: int) -> DataFrame:
    ready(docs.sparkSession)
    signed = stage(signatures(docs, words), "signatures")
    # One node for each different set; the copies of a set come back at the end.
    sets = stage(
        signed.where("set_key IS NOT NULL").groupBy("set_key").agg(
            F.first("bands").alias("bands"), F.first("minima").alias("minima"), F.min(F.struct("doc_id", "mark")).alias("row")
        ).select(F.monotonically_increasing_id().alias("node"), "set_key", "row", "bands", "minima"), "sets",
    )
    least = percent / 100 - MARGIN

    # A bucket's members are each paired with one of them, not the same in each band.
    banded = sets.select(F.col("node").alias("member"), F.explode("bands").alias("bucket"))
    chosen = F.min(F.struct(F.xxhash64("bucket", "member").alias("by"), F.col("member").alias("centre")))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), chosen.alias("chosen")).where("n > 1").select("bucket", "chosen.centre")
    members = stage(banded.join(shared, "bucket"), "members")
    stars = members.where("member <> centre").select(F.least("member", "centre").alias("u"), F.greatest("member", "centre").alias("v"), "member")
    pairs = stage(_alike(stars.groupBy("u", "v").agg(F.min("member").alias("member")), sets, least), "pairs")

    # The texts of all sets that may have a link: one row of each.
    row_key = {"doc_id": F.coalesce("row.doc_id", F.lit(-(1 << 63))), "mark": F.col("row.mark")}
    asked = sets.join(members.select(F.col("member").alias("node")).distinct(), "node", "left_semi").select("node", *[c.alias(n) for n, c in row_key.items()])
    texts = stage(
        marked(docs).select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "mark", whole_text().alias("text"))
        .join(asked, ["doc_id", "mark"]).groupBy("node").agg(F.first("text").alias("text")), "texts",
    )

    # First the best pair of each member, then what lies apart all the same.
    best = pairs.select("u", "v", "share", F.explode(F.array("u", "v")).alias("side")).groupBy("side").agg(
        F.max(F.struct("share", "u", "v")).alias("best")
    ).select("best.u", "best.v").distinct()
    roots = components(_linked(best, texts, words, percent))
    more = _across(members.select("bucket", "member"), roots, sets, pairs, texts, words, percent)
    roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more))

    rooted = sets.select("node", "set_key", "row").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("row").alias("first"))
    named = rooted.join(smallest, "root").select("set_key", "first")
    return signed.select("doc_id", "mark", "n_shingles", "set_key").join(named, "set_key", "left")


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs without blanks, A-Z lower-cased. A document's set is its distinct runs of
    ``words`` words, or its whole sequence where there are fewer. Two documents are linked when
    100 * intersection >= ``percent`` * union, confirmed on the full sets. ``component_id`` is
    the smallest doc_id that links reach; ``kept`` says that it is the document's own.

    Documents without words have an empty set, no links and are kept. Equal sets are linked and
    cost one node, however many there are. A null doc_id counts as the smallest; rows of equal
    doc_id share its fate. An empty table gives no rows. Other columns are not read.

    The pairs a bucket gives are a star; members that stars leave in different components are
    compared with one another in blocks, so a bucket loses no link and joined members cost
    little more. A pair of similarity 0.8 is missed by all bands once in 190,000 times.
    """
    found = _decided(docs, words, percent)
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, whole: of each component the one with the smallest doc_id."""
    found = _decided(docs, words, percent)
    stays = F.col("set_key").isNull() | (F.struct("doc_id", "mark").eqNullSafe(F.col("first")))
    # Of documents without words, which are linked with nothing, every row stays.
    empty = found.where("set_key IS NULL").groupBy("doc_id", "mark").agg(F.count(F.lit(1)).cast("int").alias("times"))
    return rows_of(docs, found.where(stays & F.col("set_key").isNotNull()).select("doc_id", "mark", F.lit(1).alias("times")).distinct().union(empty), times="times")
