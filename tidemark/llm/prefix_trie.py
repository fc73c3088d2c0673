"""Prefix trie of conversations from vertical bitmaps.

Conversations are dealt to shards, and long ones are cut into bands of turns. In a shard, every pair
of a position and a turn has a bitmap of the conversations that have this turn there. A depth-first
walk starts with all conversations of the shard; a child's bitmap is its parent's intersected
with that of a turn at the next position. The children's bitmaps are disjoint, so the walk takes
the lowest conversation left, follows its turn, and strikes the child's members out. Population
counts are the members, and the members whose last turn it is are the end list.

A node is known in all shards by the exclusive or of two 64-bit hashes of its positions and turns,
so shards are merged by key. Nothing about a subtree needs the tree walked again: a node belongs
to its smallest member, a conversation owns the nodes from some depth to its end, and sums over
a subtree are sums over its members of what these own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices
from tidemark.session import stage

SHARD = 256      # conversations of a shard, about
BAND = 512       # turns of a conversation that are walked at once
ENDS = 12        # a piece of an end list holds the identifiers that are equal but for this many bits
NODES = pa.schema([
    ("key", pa.list_(pa.int64())), ("parent", pa.list_(pa.int64())), ("depth", pa.int64()), ("bytes", pa.int64()), ("above", pa.int64()),
    ("members", pa.list_(pa.int64())), ("total", pa.int64()), ("ends", pa.list_(pa.int64())),
])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos from 1, digest of role and text, and bytes of text, in the order of ``turn``.

    Only digests are sorted, in ranges that cut a conversation of very many turns; a turn's
    place is the turns of its conversation in lower ranges plus its place in its own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length of the role tells where it ends.
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    narrow = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("_has_turn"), "turn",
        digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    )
    rows = in_slices(narrow, ["conv_id", "_has_turn", "turn", "digest"], "turns")
    counts = rows.groupBy("conv_id", "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    lower = Window.partitionBy("conv_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("conv_id", "_slice", F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("conv_id", "_slice").orderBy("_has_turn", "turn", "digest")
    placed = rows.withColumn("_place", F.row_number().over(inside)).join(before, ["conv_id", "_slice"])
    return placed.select("conv_id", (F.col("_before") + F.col("_place")).alias("pos"), "digest", "bytes")


def borrowed_starts(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Turns of conversations rebuilt with a start from the first conversation of their family.

    Conversation c takes the first h turns of conversation ``c - c % family``, and then its own
    after its first h; h is the crc32 of its decimal id modulo ``most``. The result has a row of
    position 0 for each conversation, so that one without turns is there too.
    """
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    first = F.col("conv_id") - F.col("conv_id") % family
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    each = counts.select("conv_id", first.alias("base"), h.alias("h"))
    lengths = counts.select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    plan = each.join(lengths, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_turns", F.lit(0))))
    own = turns.join(plan, "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "digest", "bytes")
    lent = turns.where(F.col("pos") < most).withColumnRenamed("conv_id", "base").join(
        plan.select("conv_id", "base", "h"), "base").where("pos <= h").select("conv_id", "pos", "digest", "bytes")
    empty = counts.select(
        "conv_id", F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("bytes"))
    return own.unionByName(lent).unionByName(empty)


def walk(table: pa.Table) -> pa.Table:
    """The nodes of one shard and band: key, parent, depth, bytes, above, members, total and ends.

    Rows are turns: conv, pos, z1, z2 (hashes of position and turn), bytes, and of each conversation
    start1, start2 and above (hashes and bytes of what lies before the band), last (its last
    position) and total (its bytes).
    """
    rows = table.sort_by([("conv", "ascending"), ("pos", "ascending")]).to_pydict()
    convs, first_pos, turns, starts = [], [], [], []
    for i, (conv, pos) in enumerate(zip(rows["conv"], rows["pos"], strict=True)):
        if not convs or convs[-1] != conv:
            convs.append(conv)
            first_pos.append(pos)
            turns.append([])
            starts.append(i)
        turns[-1].append(i)
    z1, z2 = rows["z1"], rows["z2"]
    postings: dict[tuple, int] = {}
    ending: dict[int, int] = {}
    roots: dict[tuple, int] = {}
    for c, own in enumerate(turns):
        bit = 1 << c
        for i in own:
            at = (rows["pos"][i], z1[i], z2[i])
            postings[at] = postings.get(at, 0) | bit
        last = rows["last"][own[0]]
        ending[last] = ending.get(last, 0) | bit
        i = starts[c]
        start = (rows["start1"][i], rows["start2"][i], first_pos[c], rows["above"][i])
        roots[start] = roots.get(start, 0) | bit
    ended = [rows["last"][own[0]] for own in turns]
    totals = [rows["total"][own[0]] for own in turns]

    def members(bits: int) -> list[int]:
        found = []
        while bits:
            low = bits & -bits
            found.append(low.bit_length() - 1)
            bits ^= low
        return found

    out: dict[str, list] = {name: [] for name in NODES.names}
    for (k1, k2, pos, above), bits in roots.items():
        stack = [(bits, k1, k2, pos, above)]
        while stack:
            left, k1, k2, pos, above = stack.pop()
            while left:
                c = (left & -left).bit_length() - 1
                i = turns[c][pos - first_pos[c]]
                child = left & postings[pos, z1[i], z2[i]]
                left ^= child
                own = members(child)
                key = (k1 ^ z1[i], k2 ^ z2[i])
                ends = child & ending.get(pos, 0)
                for name, value in zip(out, (
                    key, (k1, k2), pos, rows["bytes"][i], above, [convs[m] for m in own], sum(totals[m] for m in own),
                    [convs[m] for m in members(ends)],
                ), strict=True):
                    out[name].append(value)
                # Those that go on in this band are the child's children's.
                on = sum(1 << m for m in own if pos < ended[m] and pos - first_pos[m] + 1 < len(turns[m]))
                if on:
                    stack.append((on, *key, pos + 1, above + rows["bytes"][i]))
    return pa.table(out, NODES)


def local_nodes(turns: DataFrame, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """The nodes of every shard and band of rebuilt conversations."""
    at = F.col("pos").cast("long")
    rows = turns.select(
        F.col("conv_id").alias("conv"), at.alias("pos"), "bytes", F.floor(at / band).alias("band"),
        F.when(at == 0, 0).otherwise(F.xxhash64(at, "digest")).alias("z1"),
        F.when(at == 0, 0).otherwise(F.xxhash64("digest", at, F.lit(1))).alias("z2"),
    )
    rows = stage(rows, "rebuilt")
    bands = rows.groupBy("conv", "band").agg(
        F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"), F.sum("bytes").alias("held"), F.max("pos").alias("end"))
    of_conv = Window.partitionBy("conv")
    lower = of_conv.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = bands.select(
        "conv", "band", *[F.coalesce(F.bit_xor(x).over(lower), zero).alias(s) for x, s in (("x1", "start1"), ("x2", "start2"))],
        F.coalesce(F.sum("held").over(lower), zero).alias("above"), F.max("end").over(of_conv).alias("last"),
        F.sum("held").over(of_conv).alias("total"),
    )
    convs = rows.where("pos = 0").count()
    dealt = F.pmod(F.xxhash64(F.col("conv") - F.col("conv") % 5), F.lit(max(1, -(-convs // shard))))
    cells = rows.join(starts, ["conv", "band"]).withColumn("shard", dealt)
    return cells.groupBy("shard", "band").applyInArrow(walk, (
        "key array<long>, parent array<long>, depth long, bytes long, above long, members array<long>, total long, ends array<long>"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces, which come sorted, joined by commas; a list of any length is never held."""
    now, digest = None, None
    for batch in batches:
        keys, found = [], []
        for key, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if key != now:
                if now is not None:
                    keys.append(now)
                    found.append(digest.hexdigest())
                now, digest = key, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.list_(pa.int64())), pa.array(found, pa.string())], ["key", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.list_(pa.int64())), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])


def trie(turns: DataFrame, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """A row per node of the prefix trie of conversations given as turns (conv_id, pos, digest, bytes).

    ``turns`` has a row of position 0 for every conversation. Returns conv_id (the smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    A shard holds about ``shard`` conversations and ``band`` turns of each, whatever they share, so a
    very common first turn or conversation is many shards' work, and each gives one row per node.
    """
    local = stage(local_nodes(turns, shard, band), "local_nodes")
    ends_here = F.size("ends") < F.size("members")
    merged = local.groupBy("key").agg(
        F.min(F.array_min("members")).alias("conv_id"), F.sum(F.size("members")).cast("long").alias("n_convs"),
        F.min("depth").alias("depth"), F.min("bytes").alias("bytes"), F.min("above").alias("above"), F.min("parent").alias("parent"),
        F.sum("total").alias("total"), F.max(ends_here).alias("goes_on"),
    )
    nodes = stage(merged, "nodes")
    owners = nodes.groupBy(F.col("conv_id").alias("owner")).agg(
        F.min("depth").alias("first"), F.max("depth").alias("deepest"), F.sum("bytes").alias("own_bytes"),
        F.max(F.col("above") + F.col("bytes")).alias("reach"), F.sum((~F.col("goes_on")).cast("long")).alias("leaf"),
    )
    # What conversations bring to the nodes above those that they own.
    passing = local.select("key", "depth", F.explode("members").alias("owner")).join(owners, "owner").where("depth < first")
    brought = passing.groupBy("key").agg(
        F.sum("own_bytes").alias("bytes_below"), F.sum("leaf").alias("leaves_below"),
        F.sum((F.col("first") == F.col("depth") + 1).cast("long")).alias("opened"),
    )
    pieces = local.select("key", F.explode("ends").alias("c")).withColumn("at", F.shiftright("c", ENDS))
    texts = pieces.groupBy("key", "at").agg(F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",").alias("piece"))
    ends = texts.repartition("key").sortWithinPartitions("key", "at").select("key", "piece").mapInArrow(
        _digests, "key array<long>, ends_sha256 string")
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    owned = owners.withColumnRenamed("owner", "conv_id")
    all_ = nodes.join(owned, "conv_id").join(brought, "key", "left").join(ends, "key", "left")
    # Below its first node, a conversation's nodes have its own nodes as parents.
    opening = all_.where("depth = first AND depth > 0").join(parents, "parent")
    others = all_.where("depth > first OR depth = 0").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    every = opening.unionByName(others)

    def known(name: str):
        return F.coalesce(F.col(name), F.lit(0).cast("long"))

    distinct = known("bytes_below") + F.col("reach") - F.col("above")
    nothing = hashlib.sha256(b"").hexdigest()
    return every.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        (known("opened") + (F.col("deepest") > F.col("depth")).cast("long")).alias("n_children"),
        (known("leaves_below") + F.col("leaf")).alias("n_leaves"),
        (F.col("total") - F.col("n_convs") * F.col("above") - distinct).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt with a start borrowed from its family's first.

    Turns are ordered by ``turn``, null first; turns of one number by a digest of role and text, and
    repeated rows are turns of their own. A null role or text counts as empty. Rows without a
    conv_id belong to no conversation. A conversation that is left without turns is a member of the
    root. No rows give no nodes. Other columns are not read. Turns are told apart by the MD5 digest
    of role and text, nodes by 128 bits.
    """
    return trie(borrowed_starts(numbered_turns(conversations)), shard, band)


def _oracle_sql() -> str:
    """The same in SQL, with paths of digests for nodes and every pair of a node and one below it."""
    bits = "list_reduce([xor(crc, b) & 255, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    digits = "list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {digits}), lambda crc, b: xor(crc >> 8, {bits})), 4294967295)"
    return f"""
    WITH t AS MATERIALIZED (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
        strlen(coalesce(text, '')) AS b, turn FROM conversations WHERE conv_id IS NOT NULL),
    n AS MATERIALIZED (SELECT conv_id, m, b, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) AS pos FROM t),
    c AS MATERIALIZED (SELECT conv_id, own, conv_id - conv_id % 5 AS base, CAST({crc} AS BIGINT) % 9 AS h
        FROM (SELECT conv_id, count(*) AS own FROM n GROUP BY 1)),
    p AS MATERIALIZED (SELECT c.*, least(c.h, coalesce(x.own, 0)) AS lent FROM c LEFT JOIN c x ON x.conv_id = c.base),
    r AS MATERIALIZED (SELECT p.conv_id, n.pos - p.h + p.lent AS pos, m, b FROM p JOIN n ON n.conv_id = p.conv_id WHERE n.pos > p.h
        UNION ALL SELECT p.conv_id, n.pos, m, b FROM p JOIN n ON n.conv_id = p.base WHERE n.pos <= p.h
        UNION ALL SELECT conv_id, 0, '', 0 FROM c),
    w AS MATERIALIZED (SELECT conv_id, pos, b, string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY pos) AS path,
        max(pos) OVER (PARTITION BY conv_id) AS last FROM r),
    v AS MATERIALIZED (SELECT path, pos AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (pos = last), '')) AS ends_sha256 FROM w GROUP BY path, pos),
    k AS MATERIALIZED (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n FROM v WHERE depth > 0 GROUP BY 1),
    s AS (SELECT v.path, sum((x.n_convs - 1) * x.b) AS saved, count(*) FILTER (x.path NOT IN (SELECT path FROM k)) AS leaves
        FROM v JOIN v x ON starts_with(x.path, v.path) GROUP BY 1)
    SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n, 0) AS n_children,
      s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, v.ends_sha256
    FROM v LEFT JOIN v q ON v.depth > 0 AND q.path = left(v.path, 32 * (v.depth - 1)) LEFT JOIN k ON k.path = v.path JOIN s ON s.path = v.path"""


ORACLE_SQL = _oracle_sql()
