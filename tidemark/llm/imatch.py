"""I-Match fingerprints: hashes over the terms of a text that are neither common nor rare.

The lexicon holds the terms whose inverse document frequency lies in a band. A text's terms in
the lexicon, sorted, are hashed as a whole, and once for each of several random subsets of the
lexicon. A change of a few terms changes the whole hash, but leaves most subsets alone.

The subsets are the classes of a term's code modulo a power of two. A text with more terms uses
smaller subsets, so that one holds about one of its terms whatever its length: the fingerprint
names that level and has the hashes of two levels, so that texts of neighbouring levels share one.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices
from tidemark.session import stage

# Between two terms lies anything but letters and digits.
BETWEEN = r"[^\p{L}\p{N}]+"
# A term is in the lexicon if this share of the documents holds it: an inverse document frequency
# of ln(50) to ln(1000). There are at most (mean number of terms of a document) / LEAST_SHARE
# such terms, however large the corpus: 250,000 for documents of 250 different terms.
LEAST_SHARE, MOST_SHARE = 0.001, 0.02
SLOTS = 64        # subsets of a level, a power of two
LEAST_TERMS = 8   # texts with fewer terms in the lexicon use their other terms too
OTHERS = 32       # of those, thinned by halves down to fewer than this many and at least half as many


def terms(text: Column) -> Column:
    """The different terms of a text in lower case; the empty one among them is no term."""
    return F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN))


def code(term: Column) -> Column:
    """52 bits of the term's MD5 digest."""
    return F.conv(F.substring(F.md5(term.cast("binary")), 1, 13), 16, 10).cast("long")


def lexicon(
    docs: DataFrame, text: str = "text", least_share: float = LEAST_SHARE, most_share: float = MOST_SHARE
) -> DataFrame:
    """term, code: the terms that ``least_share`` to ``most_share`` of all documents hold, two of them at least.

    A document counts once for each of its terms. Counts are added up within tasks first.
    """
    rows = docs.count()
    held = docs.select(F.explode(terms(F.col(text))).alias("term")).where("term <> ''")
    counts = held.groupBy("term").agg(F.count(F.lit(1)).alias("_n"))
    band = F.col("_n").between(max(2, least_share * rows), most_share * rows)
    return counts.where(band).select("term", code(F.col("term")).alias("code"))


def _halvings(n: Column, first: int) -> Column:
    """How often ``n`` is halved until it is less than ``first``."""
    whole = F.floor(n / first).cast("long")
    return F.when(whole == 0, 0).otherwise(F.length(F.bin(whole))).cast("int")


def _hashes(used: Column, level: Column) -> Column:
    """For each subset that a text has terms of, its number and its terms' hash, two and three hexadecimal digits.

    A term's class at a level is its code modulo SLOTS times 2 to the level; the classes below SLOTS
    are the subsets. The terms are sorted by subset and read once.
    """
    mask = F.call_function("shiftleft", F.lit(SLOTS).cast("long"), level) - 1
    kept = F.filter(used, lambda t: t["code"].bitwiseAND(mask) < SLOTS)
    sorted_ = F.sort_array(F.transform(kept, lambda t: F.struct(t["code"].bitwiseAND(mask).alias("s"), t["term"].alias("term"))))

    def done(now: Column) -> Column:
        own = F.concat(F.lower(F.lpad(F.hex(now["s"]), 2, "0")), F.substring(F.sha1(now["terms"].cast("binary")), 1, 3))
        return F.when(now["s"] < 0, "").when(now["all"] == "", own).otherwise(F.concat(now["all"], F.lit(","), own))

    def add(now: Column, t: Column) -> Column:
        same = now["s"] == t["s"]
        return F.struct(
            t["s"].alias("s"), F.when(same, F.concat(now["terms"], F.lit(" "), t["term"])).otherwise(t["term"]).alias("terms"),
            F.when(same, now["all"]).otherwise(done(now)).alias("all"),
        )

    none = F.struct(F.lit(-1).cast("long").alias("s"), F.lit("").alias("terms"), F.lit("").alias("all"))
    return F.aggregate(sorted_, none, add, done)


def fingerprints(texts: DataFrame, keys: list[str], text: str, words: DataFrame) -> DataFrame:
    """The columns ``keys``, which name a row, and its fingerprint, given the lexicon ``words``.

    A fingerprint is the hash of all terms used, the level, and the hashes of the subsets of this
    level and the next. Equal texts have equal fingerprints. With fewer than LEAST_TERMS terms in
    the lexicon, as in very short texts or where a third of the corpus are copies of one text, the
    others are used too: all of a short text, of a longer one every second, fourth, ... by first
    occurrence. Texts without any term, null and empty ones among them, share one fingerprint.

    The lexicon's size is bounded by its band, so it is broadcast; a row's terms never leave the
    task that cut its text, unless the input is spread by something else than ``keys``.
    """
    cut = texts.select(*keys, terms(F.col(text)).alias("_terms")).withColumn("_size", F.size("_terms"))
    each = cut.select(*keys, "_size", F.posexplode("_terms").alias("_at", "term"))
    found = each.join(F.broadcast(words), "term", "left")
    stride = F.call_function("shiftleft", F.lit(1), _halvings(F.col("_size"), OTHERS))
    other = F.col("code").isNull() & (F.col("term") != "") & (F.col("_at").bitwiseAND(stride - 1) == 0)
    # The first term carries the row even if it is not used.
    wanted = found.where(F.col("code").isNotNull() | (F.col("_at") == 0) | other)
    gathered = wanted.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("code").isNotNull(), F.struct("term", "code"))).alias("_band"),
        F.collect_list(F.when(other, F.col("term"))).alias("_others"),
    )
    few = F.size("_band") < LEAST_TERMS
    others = F.transform("_others", lambda t: F.struct(t.alias("term"), code(t).alias("code")))
    used = gathered.select(*keys, F.sort_array(F.when(few, F.concat("_band", others)).otherwise(F.col("_band"))).alias("_used"))
    # A level that gives a text between three and six eighths as many terms as subsets, if it has that many.
    leveled = used.withColumn("_level", _halvings(F.size("_used"), 3 * SLOTS // 4))
    whole = F.sha1(F.array_join(F.transform("_used", lambda t: t["term"]), " ").cast("binary"))
    return leveled.select(*keys, F.concat_ws(
        ":", F.substring(whole, 1, 16), F.lpad(F.col("_level").cast("string"), 2, "0"),
        *[_hashes(F.col("_used"), F.col("_level") + up) for up in (0, 1)],
    ).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal hashes among the subsets of which either text has terms: 0 to 1.

    Compared is the finer of both texts' levels; texts more than one level apart, of which one
    has over twice the terms, count as unlike. Equal fingerprints are alike by 1.
    """
    fields_a, fields_b = F.split(a, ":"), F.split(b, ":")
    level_a, level_b = F.get(fields_a, F.lit(1)).cast("int"), F.get(fields_b, F.lit(1)).cast("int")

    def hashes(fields: Column, own: Column, other: Column) -> Column:
        chosen = F.when(own >= other, F.get(fields, F.lit(2))).otherwise(F.get(fields, F.lit(3)))
        return F.filter(F.split(chosen, ","), lambda h: h != "")

    of_a, of_b = hashes(fields_a, level_a, level_b), hashes(fields_b, level_b, level_a)
    numbers = [F.transform(x, lambda h: h.substr(1, 2)) for x in (of_a, of_b)]
    seen = F.size(F.array_union(*numbers))
    share = F.when(seen == 0, 0.0).otherwise(F.size(F.array_intersect(of_a, of_b)) / seen)
    return F.when(a == b, 1.0).when(F.abs(level_a - level_b) > 1, 0.0).otherwise(share).cast("double")


def _neighbours(docs: DataFrame) -> DataFrame:
    """A row per document with the key of the next one, the first after the last.

    Only identifiers are sorted, in ranges that tasks share; the first row of each range, a row
    per task, tells the range before it how to go on.
    """
    narrow = docs.select("_id", "_mark", "_null", F.length("_text").cast("long").alias("n_chars"))
    rows = in_slices(narrow, ["_id", "_mark"], "document_order")
    place = Window.partitionBy("_slice").orderBy("_id", "_mark")
    key = F.struct("_id", "_mark")
    following = rows.withColumn("_row", F.row_number().over(place)).withColumn("_next", F.lead(key).over(place))
    firsts = rows.groupBy("_slice").agg(F.min(key).alias("_first"))
    in_turn = Window.orderBy("_slice")
    every = in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    begins = F.coalesce(F.lead("_first").over(in_turn), F.first("_first").over(every))
    joined = following.join(firsts.select("_slice", begins.alias("_begins")), "_slice")
    after = F.coalesce("_next", "_begins")
    return joined.select(
        "_id", "_mark", "_null", "_slice", "_row", "n_chars", after["_id"].alias("_next_id"), after["_mark"].alias("_next_mark")
    )


def compare_edited(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all documents and of edited copies of them, and how alike they are.

    The edited copy has the last quarter of the code points, rounded down, replaced by as many
    from the start of the next document, by ascending id, the first after the last; or by all of
    the next if it is shorter. Returns a row per document: the id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next.

    A null text counts as empty. Null ids come first; rows of one id are ordered by a hash of their
    text, and each repeated row has a row of the result. A single document is its own next. No
    documents give no rows. Other columns are not read.

    Texts are shuffled once, by id, and the pieces that the edits take once. Fingerprints are
    put together where the texts lie.
    """
    doc_id = F.col(f"`{id}`").cast("long")
    keyed = docs.select(
        F.coalesce(doc_id, F.lit(-(1 << 63))).alias("_id"), F.xxhash64(doc_id.isNull(), F.col(f"`{text}`")).alias("_mark"),
        doc_id.isNull().alias("_null"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    words = lexicon(keyed, "_text")
    rows = _neighbours(keyed)
    texts = keyed.select("_id", "_mark", "_text").dropDuplicates(["_id", "_mark"])
    row, after = ["_id", "_mark", "_null", "_slice", "_row", "n_chars", "_next_id", "_next_mark"], ["_next_id", "_next_mark"]
    tail = F.floor(F.col("n_chars") / 4).cast("int")
    starts = rows.join(texts.toDF("_next_id", "_next_mark", "_text"), after)
    starts = starts.select(*row, F.substring("_text", F.lit(1), tail).alias("_start"))
    both = texts.join(starts, ["_id", "_mark"])
    edited = F.concat(F.substring("_text", F.lit(1), (F.col("n_chars") - tail).cast("int")), F.col("_start"))
    both = both.select(*row, "_text", edited.alias("_edited"))
    both = both.withColumn("edited_sha256", F.sha2(F.col("_edited").cast("binary"), 256))
    keys = [*row, "edited_sha256"]
    versions = both.select(*keys, F.posexplode(F.array("_text", "_edited")).alias("_which", "_version"))
    each = fingerprints(versions, [*keys, "_which"], "_version", words)
    pairs = stage(each.groupBy(*keys).agg(
        F.max(F.when(F.col("_which") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("_which") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    ), "fingerprints")
    nexts = pairs.select(
        F.col("_id").alias("_next_id"), F.col("_mark").alias("_next_mark"), F.col("fingerprint").alias("_other")
    ).dropDuplicates(after)
    own = F.col("fingerprint")
    return pairs.join(nexts, after).select(
        F.when(~F.col("_null"), F.col("_id")).alias(id), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"), likeness(own, F.col("_other")).alias("near_next"),
    )


def _oracle_sql() -> str:
    def halvings(n: str, first: int) -> str:
        return f"(CASE WHEN {n} // {first} = 0 THEN 0 ELSE length(bin({n} // {first})) END)"

    def like(a: str, b: str) -> str:
        level = [f"CAST(split_part({x}, ':', 2) AS INTEGER)" for x in (a, b)]
        hashes = [f"list_filter(string_split(split_part({x}, ':', CASE WHEN {o} >= {p} THEN 3 ELSE 4 END), ','), lambda h: h <> '')"
                  for x, o, p in ((a, *level), (b, *reversed(level)))]
        seen = "len(list_distinct(list_transform(list_concat({}, {}), lambda h: substr(h, 1, 2))))".format(*hashes)
        return f"""(CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN abs({level[0]} - {level[1]}) > 1 THEN 0.0::DOUBLE
          ELSE coalesce(CAST(len(list_intersect({hashes[0]}, {hashes[1]})) AS DOUBLE) / nullif({seen}, 0), 0.0::DOUBLE) END)"""

    return f"""
    WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n_chars,
        row_number() OVER (ORDER BY doc_id) AS i, count(*) OVER () AS n FROM documents),
    e AS MATERIALIZED (SELECT d.doc_id, d.i, d.n_chars, d.t, x.i AS j,
        substr(d.t, 1, d.n_chars - d.n_chars // 4) || substr(x.t, 1, d.n_chars // 4) AS u FROM d JOIN d x ON x.i = d.i % d.n + 1),
    split AS (SELECT i, w, regexp_split_to_array(lower(v), '{BETWEEN}') AS ts FROM (SELECT i, 0 AS w, t AS v FROM e UNION ALL SELECT i, 1, u FROM e)),
    placed AS (SELECT i, w, term, min(place) AS place FROM (SELECT i, w, unnest(ts) AS term, generate_subscripts(ts, 1) AS place FROM split) GROUP BY ALL),
    cut AS MATERIALIZED (SELECT i, w, term, row_number() OVER (PARTITION BY i, w ORDER BY place) - 1 AS nth, count(*) OVER (PARTITION BY i, w) AS size FROM placed),
    words AS MATERIALIZED (SELECT term, CAST('0x' || substr(md5(term), 1, 13) AS BIGINT) AS code
        FROM cut WHERE w = 0 AND term <> '' GROUP BY term
        HAVING count(*) BETWEEN greatest(2, CAST({LEAST_SHARE} AS DOUBLE) * (SELECT count(*) FROM d)) AND CAST({MOST_SHARE} AS DOUBLE) * (SELECT count(*) FROM d)),
    every AS MATERIALIZED (SELECT i, w, x.term, words.code IS NOT NULL AS inside, CAST('0x' || substr(md5(x.term), 1, 13) AS BIGINT) AS code, size, nth
        FROM cut x LEFT JOIN words ON words.term = x.term),
    counted AS (SELECT *, sum(CAST(inside AS INTEGER)) OVER (PARTITION BY i, w) AS band FROM every),
    used AS MATERIALIZED (SELECT i, w, term, code, count(*) OVER (PARTITION BY i, w) AS n FROM counted
        WHERE term <> '' AND (inside OR (band < {LEAST_TERMS} AND nth & ((1::BIGINT << {halvings('size', OTHERS)}) - 1) = 0))),
    leveled AS MATERIALIZED (SELECT i, w, term, code, {halvings('n', 3 * SLOTS // 4)} AS lv FROM used),
    slots AS (SELECT i, w, up, code & (({SLOTS}::BIGINT << (lv + up)) - 1) AS s, substr(sha1(string_agg(term, ' ' ORDER BY term)), 1, 3) AS h
        FROM leveled, (SELECT unnest([0, 1]) AS up) WHERE code & (({SLOTS}::BIGINT << (lv + up)) - 1) < {SLOTS} GROUP BY ALL),
    grid AS (SELECT i, w, up, string_agg(printf('%02x', s) || h, ',' ORDER BY s) AS hs FROM slots GROUP BY ALL),
    whole AS (SELECT i, w, substr(sha1(string_agg(term, ' ' ORDER BY term)), 1, 16) AS h, lpad(CAST(max(lv) AS VARCHAR), 2, '0') AS lv FROM leveled GROUP BY ALL),
    prints AS MATERIALIZED (SELECT c.i, c.w, coalesce(whole.h, substr(sha1(''), 1, 16)) || ':' || coalesce(lv, '00') || ':'
          || coalesce(g.hs, '') || ':' || coalesce(f.hs, '') AS f
        FROM split c LEFT JOIN whole ON whole.i = c.i AND whole.w = c.w
          LEFT JOIN grid g ON g.i = c.i AND g.w = c.w AND g.up = 0 LEFT JOIN grid f ON f.i = c.i AND f.w = c.w AND f.up = 1)
    SELECT e.doc_id, CAST(n_chars AS BIGINT) AS n_chars, sha256(u) AS edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint,
      {like('a.f', 'b.f')} AS near_edited, {like('a.f', 'c.f')} AS near_next
    FROM e JOIN prints a ON a.i = e.i AND a.w = 0 JOIN prints b ON b.i = e.i AND b.w = 1 JOIN prints c ON c.i = e.j AND c.w = 0"""


ORACLE_SQL = _oracle_sql()
