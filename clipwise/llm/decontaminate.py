"""Benchmark decontamination by a positional inverted index; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, table

#: What separates words: every ASCII character that is no digit and no lower-case letter.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words; empty for null."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), BETWEEN), ""), F.array().cast("array<string>"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint only if it has at most ``rows`` rows (of a word or a window each)."""
    return F.broadcast(df) if df.count() <= rows else df


def windows(benchmark: DataFrame, length: int) -> DataFrame:
    """item_id, w (the window's words joined by spaces), wid (its hash) and len, for each item and window."""
    listed = benchmark.select("item_id", words(F.col("text")).alias("ws")).where("size(ws) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - length + 1, F.lit(1)))
    return (
        listed.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("ws", i, F.lit(length)))).alias("ws"))
        .select("item_id", F.array_join("ws", " ").alias("w"), F.size("ws").alias("len"))
        .withColumn("wid", F.xxhash64("w"))
        .distinct()
    )


def list_lengths(docs: DataFrame, terms: DataFrame, broadcast_rows: int) -> DataFrame:
    """term and n: how long the postings list of each test term is, over all documents, repeated rows each."""
    vocabulary = materialize(terms.select("term").distinct(), "test-terms")
    counts = docs.select(F.explode("ws").alias("term")).join(_small(vocabulary, broadcast_rows), "term").groupBy("term").agg(F.count("*").alias("n"))
    return materialize(counts, "list-lengths")


def postings(docs: DataFrame, terms: DataFrame, broadcast_rows: int) -> DataFrame:
    """_key, pos and term: where the terms stand, a written table. Rows that repeat a key give one posting each place.

    Otherwise lists of k equal rows would meet in k * k pairs. Only postings of keys that repeat are shuffled for that, combined beforehand.
    """
    wanted = _small(terms.select("term").distinct(), broadcast_rows)
    placed = lambda rows: rows.select("_key", F.posexplode("ws").alias("pos", "term")).join(wanted, "term").select("_key", "pos", "term")
    again = materialize(docs.groupBy("_key").count().where("count > 1").select("_key"), "repeated-keys")
    if again.isEmpty():
        return materialize(placed(docs), "postings")
    few = _small(again, broadcast_rows)
    once = placed(docs.join(few, "_key", "left_anti"))
    return materialize(once.union(placed(docs.join(few, "_key", "left_semi")).distinct()), "postings")


def rarest(wins: DataFrame, lengths: DataFrame) -> DataFrame:
    """wid, len, t1 and t2, the two rarest terms (n, off, term) of each window. One with a term that no document has can't occur and is left out."""
    terms = wins.select("wid", "w", "len").distinct().select("wid", "len", F.posexplode(F.split("w", " ")).alias("off", "term"))
    ordered = terms.join(lengths, "term", "left").groupBy("wid", "len").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term"))).alias("t")
    )
    return materialize(ordered.where(F.col("t")[0]["n"] > 0).select("wid", "len", F.col("t")[0].alias("t1"), F.get("t", F.lit(1)).alias("t2")), "windows")


def candidates(posted: DataFrame, anchored: DataFrame, *, broadcast_rows: int = 200_000) -> DataFrame:
    """_key, wid, len and start (from 0): where the two rarest terms of a window stand as they do in it.

    Both postings lists are shifted by the term's offset in the window and intersected.
    """

    def shifted(t: str) -> DataFrame:
        by = _small(anchored.where(f"{t} is not null").select("wid", "len", f"{t}.term", f"{t}.off"), broadcast_rows)
        return posted.join(by, "term").select("_key", "wid", "len", (F.col("pos") - F.col("off")).alias("start"))

    pairs = shifted("t1").join(shifted("t2").drop("len"), ["_key", "wid", "start"])
    cols = ["_key", "wid", "len", "start"]
    return pairs.select(*cols).union(shifted("t1").where("len = 1").select(*cols)).distinct()


def placed_items(benchmark: DataFrame) -> DataFrame:
    """iid and ws: the words of every different item that has any."""
    listed = benchmark.select(words(F.col("text")).alias("ws")).where("size(ws) > 0")
    return listed.select(F.xxhash64(F.array_join("ws", " ")).alias("iid"), "ws").distinct()


def near_anchors(items: DataFrame, lengths: DataFrame, length: int, spare: int) -> DataFrame:
    """iid, q (a word's place in the item), term, and ``js``, the windows (by start) of which it is one of the rarest terms.

    A window of len words may lack ``len // spare``, so of its 2 rarest terms and as many more as may lack two are there (of a
    window of one word, the one). Terms that no document has count among the rarest.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - length, F.lit(0)))
    each = items.select("iid", F.explode(starts).alias("j"), "ws").select("iid", "j", F.posexplode(F.slice("ws", F.col("j") + 1, F.lit(length))).alias("off", "term"))
    known = each.join(lengths, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ranked = known.groupBy("iid", "j").agg(F.sort_array(F.collect_list(F.struct("n", (F.col("j") + F.col("off")).alias("q"), "term"))).alias("t"))
    taken = ranked.select("iid", "j", F.size("t").alias("len"), F.explode(F.slice("t", F.lit(1), F.floor(F.size("t") / spare).cast("int") + 2)).alias("t"))
    return materialize(taken.groupBy("iid", "t.q", "t.term").agg(F.collect_list(F.struct("j", "len")).alias("js")), "near-anchors")


def near(texts: DataFrame, posted: DataFrame, items: DataFrame, anchors: DataFrame, *, length: int, slop: int, spare: int, broadcast_rows: int) -> DataFrame:
    """_key and iid: documents in which a window of an item stands but for ``len // spare`` words, each within ``slop`` of its place.

    A posting at ``pos`` of the item's word q lies on the diagonal ``pos - q``; words of one occurrence differ by at most ``2 * slop``. A
    document's postings are listed by item and diagonal (combined in its own task, as they stand together), and one stays only if its
    neighbour is another word close enough. What stays votes for the windows and places that it allows; those with two of the rarest
    terms are compared word by word with the document.
    """
    alone = F.exists("js", lambda x: x["len"] == 1).alias("alone")
    by = _small(anchors.select("term", "iid", "q", alone), broadcast_rows)
    hits = posted.join(by, "term").select("_key", F.struct("iid", (F.col("pos") - F.col("q")).alias("d"), "q", "alone").alias("h"))
    listed = hits.groupBy("_key").agg(F.sort_array(F.collect_list("h")).alias("hs"))
    close = lambda a, b: (a["iid"] == b["iid"]) & (F.abs(a["d"] - b["d"]) <= 2 * slop) & (a["q"] != b["q"])
    beside = F.filter("hs", lambda x, i: x["alone"] | F.coalesce(close(F.get("hs", i - 1), x), F.lit(False)) | F.coalesce(close(x, F.get("hs", i + 1)), F.lit(False)))
    kept = listed.select("_key", F.explode(beside).alias("h")).select("_key", "h.iid", "h.d", "h.q")
    votes = kept.join(_small(anchors.select("iid", "q", "js"), broadcast_rows), ["iid", "q"]).select("_key", "iid", "q", "d", F.explode("js").alias("w"))
    each = votes.select("_key", "iid", "q", "w.j", "w.len", F.explode(F.sequence(F.col("d") - slop, F.col("d") + slop)).alias("d"))
    agreed = each.groupBy("_key", "iid", "j", "len", "d").agg(F.count_distinct("q").alias("n")).where("n >= least(len, 2)")
    asked = agreed.join(_small(items, broadcast_rows), "iid").select("_key", F.struct("iid", F.slice("ws", F.col("j") + 1, F.col("len")).alias("w"), (F.col("d") + F.col("j")).alias("start")).alias("c"))
    per_doc = materialize(asked.groupBy("_key").agg(F.collect_set("c").alias("_c")), "near-candidates")
    read = texts.select("_key", F.col("ws").alias("_ws")).join(_small(per_doc.select("_key"), broadcast_rows), "_key", "left_semi").dropDuplicates(["_key"]).join(per_doc, "_key")
    there = F.expr(
        f"""transform(filter(_c, c -> size(filter(sequence(0, size(c.w) - 1), i ->
            array_contains(slice(_ws, greatest(c.start + i - {slop}, 0) + 1, greatest(least(2 * {slop} + 1, c.start + i + {slop} + 1), 0)), c.w[i])))
            >= size(c.w) - size(c.w) div {spare}), c -> c.iid)"""
    )
    return read.select("_key", F.explode(F.array_distinct(there)).alias("iid"))


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    length: int = 10,
    slop: int = 0,
    spare: int = 10,
    keep: Sequence[str] | None = None,
    broadcast_rows: int = 100_000,
    write_words: bool = True,
) -> DataFrame:
    """Every document's row with ``n_words``, ``n_hit``, ``items``, ``near_items`` and ``contaminated``.

    A window is ``length`` consecutive words of an item; an item with fewer words, but not none, is
    one window. ``n_hit`` counts the document's words inside exact occurrences of a window,
    ``items`` are the sorted ids, as strings, of items with such windows. With ``slop`` > 0 ``near_items`` are
    those of which a window stands in the document with its words within ``slop`` places of their own, one word in
    ``spare`` lacking or replaced (none in shorter windows); exact occurrences are among them. Without, it is empty.
    ``keep`` names the columns of ``docs`` to return, all by default.

    Texts are split into words once, into a written table, from which the counts, the postings and the verification read; without
    ``write_words`` each of these splits them again, which costs time and spares the table's disk (about the texts' size). Candidates
    come from the index; each is verified against the words of its document. Only words of documents with
    candidates are shuffled, as long as their keys (16 bytes each) are few enough to be broadcast; beyond
    ``broadcast_rows`` both sides are shuffled. Rows meet by id and content of the text, so repeated rows
    get equal results and are verified once. Null texts have no words, very long ones are read whole, empty tables give no
    matches, null item ids take no part, and columns named like an output are replaced.
    """
    added = ("n_words", "n_hit", "items", "near_items", "contaminated")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    key = F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text")))
    keyed = docs.withColumn("_key", key)
    split = keyed.select("_key", words(F.col("text")).alias("ws"), *([] if "text" in keep else [F.struct(*keep).alias("_kept")]))
    split = materialize(split, "words") if write_words else split
    tests = benchmark.where("item_id is not null")
    wins = materialize(windows(tests, length), "benchmark")
    lengths = list_lengths(split.select("ws"), wins.select(F.explode(F.split("w", " ")).alias("term")), broadcast_rows)
    anchored = rarest(wins, lengths)
    terms = anchored.select(F.explode(F.array_compact(F.array("t1.term", "t2.term"))).alias("term"))
    placed = placed_items(tests)
    if slop:
        anchors = near_anchors(placed, lengths, length, spare)
        terms = terms.union(anchors.select("term"))
    posted = postings(split.select("_key", "ws"), terms, broadcast_rows)
    found = candidates(posted, anchored, broadcast_rows=broadcast_rows).join(wins.select("wid", "w").distinct(), "wid")
    per_doc = materialize(found.groupBy("_key").agg(F.collect_list(F.struct("start", "len", "w")).alias("_c")), "candidates")
    texts = split.select("_key", F.col("ws").alias("_ws")).join(_small(per_doc.select("_key"), broadcast_rows), "_key", "left_semi")
    read = texts.dropDuplicates(["_key"]).join(per_doc, "_key").select("_key", "_c", "_ws")
    same = lambda c: (c["start"] >= 0) & (F.array_join(F.slice(F.col("_ws"), F.greatest(c["start"], F.lit(0)) + 1, c["len"]), " ") == c["w"])
    spans = F.transform("_hits", lambda c: F.sequence(c["start"], c["start"] + c["len"] - 1))
    verified = materialize(
        read.select("_key", F.filter("_c", same).alias("_hits")).select(
            "_key", F.size(F.array_distinct(F.flatten(spans))).cast("long").alias("n_hit"), F.array_distinct(F.transform("_hits", lambda c: c["w"])).alias("_w")
        ),
        "hits",
    )

    def named(pairs: DataFrame, name: str) -> DataFrame:
        """The sorted item ids of pairs of _key and item_id."""
        return pairs.select("_key", F.col("item_id").cast("string").alias("i")).distinct().groupBy("_key").agg(F.array_sort(F.collect_list("i")).alias(name))

    none = F.array().cast("array<string>")
    hits = verified.select("_key", "n_hit").join(named(verified.select("_key", F.explode("_w").alias("w")).join(wins, "w"), "items"), "_key", "left")
    if slop:
        close = near(split.select("_key", "ws"), posted, placed, anchors, length=length, slop=slop, spare=spare, broadcast_rows=broadcast_rows)
        ids = tests.select("item_id", words(F.col("text")).alias("ws")).select("item_id", F.xxhash64(F.array_join("ws", " ")).alias("iid"))
        hits = hits.join(named(close.join(_small(ids, broadcast_rows), "iid"), "near_items"), "_key", "full")
    else:
        hits = hits.withColumn("near_items", none)
    hits = materialize(hits.where("n_hit > 0 or size(near_items) > 0"), "found")
    if "text" in keep:
        rows = keyed.select(*keep, "_key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    else:
        rows = split.select(*[F.col("_kept").getField(c).alias(c) for c in keep], "_key", F.size("ws").cast("long").alias("n_words"))
    return rows.join(_small(hits, broadcast_rows), "_key", "left").select(
        *keep,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("near_items", none).alias("near_items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), slop=2, keep=("doc_id",))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        F.size("near_items").cast("long").alias("n_near"),
        F.sha2(F.array_join("near_items", ","), 256).alias("near_sha256"),
    )


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP10_SQL = f"""
WITH b AS (SELECT item_id, {_WORDS.format("text")} AS ws FROM benchmark WHERE item_id IS NOT NULL),
w AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(ws) - 8, 2)), lambda i: array_to_string(ws[i:i + 9], ' '))) AS w
      FROM b WHERE len(ws) > 0),
d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce({_WORDS.format("text")}, []) AS ws FROM documents),
l AS (SELECT DISTINCT len(string_split(w, ' ')) AS n FROM w),
g AS (SELECT rn, i, n, array_to_string(ws[i:i + n - 1], ' ') AS w
      FROM (SELECT rn, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, l WHERE len(ws) >= n)),
h AS (SELECT g.rn, g.i, g.n, g.w FROM g WHERE g.w IN (SELECT w FROM w)),
c AS (SELECT rn, count(DISTINCT p) AS n_hit FROM (SELECT rn, unnest(range(i, i + n)) AS p FROM h) GROUP BY rn),
t AS (SELECT rn, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT h.rn, CAST(w.item_id AS VARCHAR) AS item FROM h JOIN w USING (w)) GROUP BY rn),
dw AS (SELECT rn, unnest(range(len(ws))) AS p, unnest(ws) AS word FROM d),
bw AS (SELECT item_id, unnest(range(len(ws))) AS q, unnest(ws) AS word, len(ws) AS n FROM b),
m AS (SELECT DISTINCT rn, item_id, n, q, p - q + s AS dg FROM dw JOIN bw USING (word), (SELECT unnest([-2, -1, 0, 1, 2]) AS s)),
v AS (SELECT *, count(*) OVER (PARTITION BY rn, item_id, n, dg ORDER BY q RANGE BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ten,
             count(*) OVER (PARTITION BY rn, item_id, n, dg ORDER BY q RANGE BETWEEN CURRENT ROW AND 8 FOLLOWING) AS nine FROM m),
nr AS (SELECT rn, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near FROM (SELECT DISTINCT rn, CAST(item_id AS VARCHAR) AS item FROM v
       WHERE CASE WHEN n >= 10 THEN ten >= 9 AND q + 9 < n OR nine = 9 AND q >= 1 ELSE ten = n END) GROUP BY rn)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, sha256(coalesce(near, '')) AS near_sha256
FROM d LEFT JOIN c USING (rn) LEFT JOIN t USING (rn) LEFT JOIN nr USING (rn)
"""
