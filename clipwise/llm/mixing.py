"""Mixing sources to target weights by systematic sampling; DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, table

SEED = "mix-1"


def _fraction(c: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of an md5."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Target of every source, from ``source`` and ``source_size`` (one row for each).

    Sources in code point order, null last, take the weights in turn. The target is
    ``min(cap * size, level * weight)``, with the one level at which the targets add up to all
    sizes: the fixed point of capping and resharing. Ordered by the level at which each one
    reaches its cap, that level follows from running sums. The windows see one row per source.
    """
    everything = Window.partitionBy()
    named = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    order = Window.orderBy("_full", "_rank")
    ranked = (
        named.withColumn("weight", weight.cast("long"))
        .withColumn("_cap", F.col("source_size") * cap)
        .withColumn("_full", F.col("_cap") / F.col("weight"))
        .withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_pos", F.row_number().over(order))
        .withColumn("_held", F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_free", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", (F.col("_all") - F.col("_held")) / F.col("_free"))
    )
    found = F.min(F.when(F.col("_level") <= F.col("_full"), F.struct("_pos", "_level"))).over(everything)
    return ranked.withColumn("_found", found).select(
        "source",
        "source_size",
        F.when(F.col("_pos") >= F.col("_found._pos"), F.col("_found._level") * F.col("weight"))
        .otherwise(F.col("_cap").cast("double"))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[int] = (1, 2, 3),
    cap: int = 3,
    seed: str = SEED,
    rows_per_chunk: int = 200_000,
) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` and ``copies`` to every document.

    Each document of a source is expected ``target / source_size`` times. Within the source the
    expected copies are summed in the order of (bit length of the size, md5 of seed, id and text), one
    offset drawn from the seed is added, and a document is emitted once for every integer that its
    own share of the sum crosses. The order spreads the picks evenly over sizes, so the words
    taken come near the target. The same input and seed always give the same copies.

    The prefix sum has two levels: a source is cut into chunks along that order, chunk counts are
    summed over the small chunk table, and ranks within a chunk come from a window over one chunk.
    A source with a third of all rows is thus spread over many tasks; the chunks' number follows
    the row count, and the result doesn't depend on it.

    Nulls: a null text has size 0 and may be emitted, taking no words; null sources are one source,
    the last; a null id is a value like others, and rows that share an id lie in buckets by their texts. Rows that repeat
    both are ranked one by one. Very long texts count whole. An empty table gives an empty table. Columns of ``docs`` named like an output are replaced.
    """
    added = ("size", "source_size", "target", "copies")
    digits = min(5, max(1, math.ceil(math.log(max(1, docs.count() / rows_per_chunk), 16)) + 1))
    doc_hash = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.md5("text"), F.lit("null"))))
    sized = (
        docs.drop(*added)
        .withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
        .withColumn("_src", F.coalesce(F.concat(F.lit("s:"), F.col("source")), F.lit("n")))
        .withColumn("_class", F.length(F.bin("size")))
        .withColumn("_hash", doc_hash)
        .withColumn("_bucket", F.substring("_hash", 1, digits))
    )
    chunks = sized.groupBy("_src", "_class", "_bucket").agg(
        F.count("*").alias("_n"), F.sum("size").alias("_words"), F.first("source").alias("source")
    )
    per_source = chunks.groupBy("_src").agg(F.first("source").alias("source"), F.sum("_words").alias("source_size"))
    goal = targets(per_source.select("source", "source_size"), weights, cap).withColumn(
        "_src", F.coalesce(F.concat(F.lit("s:"), F.col("source")), F.lit("n"))
    )
    before = Window.partitionBy("_src").orderBy("_class", "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        chunks.select("_src", "_class", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        .join(goal.drop("source"), "_src")
        .withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("_offset", _fraction(F.concat(F.lit(f"{seed}/"), F.col("_src"))))
    )
    within = Window.partitionBy("_src", "_class", "_bucket").orderBy("_hash", "doc_id", "size")
    ranked = sized.withColumn("_k", F.row_number().over(within)).join(starts, ["_src", "_class", "_bucket"])
    k = F.col("_before") + F.col("_k")
    crossed = F.floor(F.col("_offset") + F.col("_rate") * k) - F.floor(F.col("_offset") + F.col("_rate") * (k - 1))
    return ranked.withColumn("copies", F.least(crossed, F.lit(cap)).cast("long")).select(
        *[c for c in docs.columns if c not in added], *added
    )


def emit(mixed: DataFrame) -> DataFrame:
    """One row for each copy, numbered from 1 in ``copy``."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP5_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         coalesce('s:' || source, 'n') AS src,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')) AS h
  FROM documents),
s AS (SELECT src, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
             row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
r AS (SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / weight AS lim,
             sum(source_size) OVER () AS total FROM w),
p AS (SELECT *, row_number() OVER (ORDER BY lim, rk) AS pos,
             CAST(total - coalesce(sum(cap) OVER (ORDER BY lim, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
             / CAST(sum(weight) OVER (ORDER BY lim, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lev
      FROM r),
f AS (SELECT min(pos) AS pos, arg_min(lev, pos) AS lev FROM p WHERE lev <= lim),
t AS (SELECT src, source_size, CASE WHEN p.pos >= f.pos THEN f.lev * weight ELSE CAST(cap AS DOUBLE) END AS target,
             CAST(CAST('0x' || substr(md5('{SEED}/' || src), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u
      FROM p, f),
k AS (SELECT d.*, t.source_size, t.target, t.u,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
             row_number() OVER (PARTITION BY src ORDER BY length(bin(size)), h, doc_id, size) AS rn
      FROM d JOIN t USING (src))
SELECT doc_id, size, source_size, target,
       CAST(least(floor(u + rate * rn) - floor(u + rate * (rn - 1)), 3) AS BIGINT) * size AS taken
FROM k
"""
