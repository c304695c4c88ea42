"""Exact deduplication by skew-safe combining: within a task, then by digest and salt, then salts; contents are compared each time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: What texts are compared without.
BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without ASCII white space; empty for null."""
    return F.coalesce(F.translate(text.cast("string"), BLANKS, ""), F.lit(""))


def digest_of(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _big(power: int) -> Column:
    return F.lit(str(1 << power)).cast("decimal(20,0)")


def packed(chars: Column, doc_id: Column) -> Column:
    """One number whose order is that of (fewest code points, largest id, null ids first); a hash aggregation can hold it."""
    place = F.coalesce(_big(63) - doc_id.cast("decimal(20,0)"), F.lit(0).cast("decimal(21,0)"))
    return (chars.cast("decimal(10,0)") * _big(65).cast("decimal(20,0)") + place).cast("decimal(34,0)")


def packed_id(best: Column) -> Column:
    rest = best % _big(65)
    return F.when(rest > 0, (_big(63) - rest).cast("long"))


def combined(rows: DataFrame, hot: DataFrame, salts: int, *, with_content: bool = False) -> DataFrame:
    """digest, best (packed) and size of every distinct content of ``rows`` (digest, content, best), and content if asked for.

    Rows are first combined within their task, which leaves one a content; these meet by digest, and those of the digests in
    ``hot`` by digest and salt, their task's number modulo ``salts``. Last, the winners of the salts are combined. Content is part of
    the key in all three, so texts that only share a digest stay apart. ``hot`` is broadcast: the caller bounds it.
    """
    marked = rows.join(F.broadcast(hot.select("digest", F.lit(True).alias("hot"))), "digest", "left")
    salt = F.when(F.col("hot"), F.spark_partition_id() % salts).otherwise(0)
    local = marked.withColumn("salt", salt).groupBy("digest", "salt", "content", "hot").agg(F.max("best").alias("best"), F.count("*").alias("size"))
    shown = F.col("content") if with_content else F.when(F.col("hot"), F.col("content")).alias("content")
    winners = materialize(local.select("digest", shown, "best", "size", "hot"), "salt-winners")
    across = winners.where("hot").groupBy("digest", "content").agg(F.max("best").alias("best"), F.sum("size").alias("size"))
    out = ["digest", "best", "size", *(["content"] if with_content else [])]
    return winners.where("hot is null").select(*out).unionByName(across.select(*out))


def _met(rows: DataFrame, groups: DataFrame, keys: list[str], share: float, broadcast_rows: int) -> DataFrame:
    """Rows with their group, if any. Groups of more than ``share`` rows, whose number that bounds, never meet rows in a shuffle."""
    if groups.count() <= broadcast_rows:
        return rows.join(F.broadcast(groups), keys, "left")
    large = F.broadcast(groups.where(F.col("size") > share))
    return rows.join(large, keys).unionByName(rows.join(large.select(*keys), keys, "left_anti").join(groups.where(F.col("size") <= share), keys, "left"))


def deduplicate(
    docs: DataFrame,
    *,
    keep: Sequence[str] | None = None,
    digest: Callable[[Column], Column] = digest_of,
    salts: int = 16,
    hot_share: int = 1000,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``digest``; ``keep`` names the columns to return, all by default.

    Texts are equal when they are identical without ASCII white space; null counts as empty, so all texts without content are one
    group. Of a group the row with the most code points in its original text stays, then the one with the smallest id, null ids
    last; of rows that repeat an id and tie in length, one. Very long texts are compared whole, an empty table gives no
    rows, and columns of ``docs`` named like an output are replaced.

    Digests are written first, with id and length. Those that occur once need no comparison; rows of the others are combined by
    content (see ``combined``). Digests with more than a ``hot_share``-th of all rows, of which there are fewer than ``hot_share``, are
    salted, and their results go back to the rows by a broadcast, the others' by digest. Only rows of a digest that turns out to have
    several contents (none is known of SHA-256) meet these by content. Contents go through one shuffle; if the
    repeated digests are at most ``broadcast_rows``, those that occur once are left out before it.
    """
    added = ("keep_id", "group_size", "kept", "digest")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    content = normalised(F.col("text"))
    best = packed(F.coalesce(F.length(F.col("text")), F.lit(0)), F.col("doc_id").cast("long"))
    base = docs.select(F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), best.alias("best"), content.alias("content"), digest(content).alias("digest"))
    rows = materialize(base.select("row", "doc_id", "best", "digest").withColumn("at", F.monotonically_increasing_id()), "digests")
    share = rows.count() / hot_share
    first = F.max(F.struct("best", -F.col("at")))
    repeated = materialize(rows.groupBy("digest").agg(F.count("*").alias("n"), first.alias("first")).where("n > 1"), "repeated-digests")
    compared = base.select("digest", "content", "best")
    if repeated.count() <= broadcast_rows:
        compared = compared.join(F.broadcast(repeated.select("digest")), "digest", "left_semi")
    hot = repeated.where(F.col("n") > share).select("digest")
    found = combined(compared, hot, salts).groupBy("digest").agg(F.count("*").alias("kinds"), F.max("best").alias("best"), F.max("size").alias("size"))
    groups = materialize(found.join(repeated.select("digest", (-F.col("first.col2")).alias("first")), "digest"), "groups")
    shared = groups.where("kinds > 1").select("digest")
    verdicts = [_judged(rows if (alone := shared.isEmpty()) else rows.join(shared, "digest", "left_anti"), groups.where("kinds = 1").drop("kinds"), ["digest"], share, broadcast_rows)]
    if not alone:
        again = materialize(base.join(shared, "digest", "left_semi").withColumn("at", F.monotonically_increasing_id()), "shared-digests")
        firsts = again.groupBy("digest", "content").agg(first.alias("first")).select("digest", "content", (-F.col("first.col2")).alias("first"))
        apart = combined(again, hot, salts, with_content=True).join(firsts, ["digest", "content"])
        verdicts.append(_judged(again, materialize(apart, "groups"), ["digest", "content"], share, broadcast_rows))
    out = verdicts[0] if alone else verdicts[0].unionByName(verdicts[1])
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], *added)


def _judged(rows: DataFrame, groups: DataFrame, keys: list[str], share: float, broadcast_rows: int) -> DataFrame:
    """Rows of no group stay on their own."""
    met = _met(rows.drop("best"), groups, keys, share, broadcast_rows)
    alone = F.col("size").isNull()
    return met.select(
        "row",
        F.when(alone, F.col("doc_id")).otherwise(packed_id(F.col("best"))).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("at") == F.col("first"))).alias("kept"),
        "digest",
    )


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=("doc_id",))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
w AS (SELECT *, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, row_number() OVER best AS k
      FROM d WINDOW best AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST, rn))
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(norm) AS text_sha256 FROM w
"""
