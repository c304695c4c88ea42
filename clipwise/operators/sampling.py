"""Seeded splits and samples: an md5 of seed and key takes the place of a random generator.

The order is the same for any partitioning. A global rank is a range-partitioned sort; where only a
share is wanted, the hash itself decides and nothing is sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hashed(seed: str, *keys: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *[k.cast("string") for k in keys]))


def fraction(seed: str, *keys: Column) -> Column:
    return F.conv(F.substring(hashed(seed, *keys), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def group_split(df: DataFrame, group: str, held: int, seed: str) -> DataFrame:
    """Adds ``split``: ``val`` for whole groups, the first by hash, else ``train``.

    max(0, groups - 1) bounds the number held out, and at least one is: a single group is all val. Only the
    table of groups is ranked.
    """
    groups = df.select(group).distinct()
    order, everything = Window.orderBy(hashed(seed, F.col(group)), group), Window.partitionBy()
    ranked = groups.select(group, F.row_number().over(order).alias("_n"), F.count("*").over(everything).alias("_g"))
    k = F.greatest(F.least(F.lit(held), F.col("_g") - 1), F.lit(1))
    return df.join(ranked, group).withColumn("split", F.when(F.col("_n") <= k, "val").otherwise("train")).drop("_n", "_g")


def _buckets(df: DataFrame, rows: int = 100_000) -> int:
    """Digits of a hash by which a group is cut into buckets of about ``rows`` rows."""
    return max(1, math.ceil(math.log(max(1.0, df.count() / rows), 16)))


def hash_placed(df: DataFrame, key: str, group: str, seed: str, name: str = "place", count: str = "_n") -> DataFrame:
    """Adds the row's place, from 1, in its group's hash order, and the group's count.

    A rank in two levels: groups are cut into buckets by the first digits of the hash, rows are ranked within a bucket and
    buckets by a running count, so that no group is sorted in one task.
    """
    digits = _buckets(df)
    keyed = df.withColumn("_h", hashed(seed, F.col(key))).withColumn("_b", F.substring("_h", 1, digits))
    sizes = keyed.groupBy(group, "_b").agg(F.count("*").alias("_c"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(group).alias("_g"), F.col("_b").alias("_b2"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_s"), F.sum("_c").over(Window.partitionBy(group)).alias(count))
    own = keyed.withColumn("_k", F.row_number().over(Window.partitionBy(group, "_b").orderBy("_h", key)))
    met = own.join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_b") == F.col("_b2")))
    return met.select(*df.columns, (F.col("_s") + F.col("_k")).alias(name), count)


def inject_references(df: DataFrame, key: str, group: str, share: float, seed: str) -> DataFrame:
    """Adds ``ref`` to round(share * n) rows of each group: another row of it, the next in a second hash order.

    The next one is found by a join on place + 1, the last one's next being the first.
    """
    placed = hash_placed(hash_placed(df, key, group, seed, "_a"), key, group, f"{seed}/ref", "_p", "_m")
    after = placed.select(F.col(group).alias("_g"), F.col(key).alias("_after"), F.when(F.col("_p") == 1, F.col("_m")).otherwise(F.col("_p") - 1).alias("_q"))
    met = placed.join(after, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_q")))
    chosen = (F.col("_a") <= F.round(F.col("_n") * share)) & (F.col("_n") > 1)
    return met.select(*df.columns, F.when(chosen, F.col("_after")).alias("ref"))


def nested(df: DataFrame, key: str, group: str, sizes: list[int], seed: str) -> DataFrame:
    """Rows of each group in hash order, with ``place`` and ``subset``, the smallest size that holds the row, else null."""
    subset = F.coalesce(*[F.when(F.col("place") <= s, s) for s in sorted(sizes)])
    return hash_placed(df, key, group, seed).drop("_n").withColumn("place", F.col("place").cast("int")).withColumn("subset", subset)


def slots(df: DataFrame, test: str, item: str, seed: str) -> DataFrame:
    """Adds ``slot``: the item's place, from 1, in its test's hash order."""
    return df.withColumn("slot", F.row_number().over(Window.partitionBy(test).orderBy(hashed(seed, F.col(test), F.col(item)), item)))


def leaked(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Keys that stand on both sides."""
    return df.groupBy(key).agg(F.count_distinct(split).alias("n")).where("n > 1").select(key)


def evenly(df: DataFrame, k: int, *order: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows at int(i * (n - 1) / (k - 1)) for i below k of each group's order."""
    w = Window.partitionBy(*keys)
    ranked = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    picks = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (F.col("_n") - 1) / max(1, k - 1)))
    return ranked.where(F.array_contains(picks, F.col("_i").cast("bigint"))).drop("_i", "_n")


def explicit_split(df: DataFrame, group: str, held: DataFrame) -> DataFrame:
    """Adds ``split``: ``val`` for the groups that ``held`` names, else ``train``."""
    named = held.select(group).distinct().withColumn("_val", F.lit(True))
    return df.join(named, group, "left").withColumn("split", F.when(F.col("_val"), "val").otherwise("train")).drop("_val")


def flipped(seed: str, *keys: Column) -> Column:
    """A fair coin for each key."""
    return fraction(seed, *keys) < 0.5


def opaque(df: DataFrame, key: str, seed: str, prefix: str = "c", keys: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``opaque``: the prefix and the key's place in hash order, with two digits or more."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(hashed(seed, *map(F.col, (*keys, key))), key))
    return df.withColumn("opaque", F.format_string(f"{prefix}%02d", place))


def capped(df: DataFrame, key: str, most: int, seed: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """At most ``most`` rows of each group, the first in hash order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(hashed(seed, *map(F.col, (*keys, key))), key))
    return df.withColumn("_n", place).where(F.col("_n") <= most).drop("_n")


def with_attention(pairs: DataFrame, key: str, a: str, b: str, seed: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The pairs, and for each group one more whose two sides are the first of a pair picked by hash; ``attention`` marks it."""
    picked = capped(pairs, key, 1, seed, keys).withColumn(b, F.col(a))
    return pairs.withColumn("attention", F.lit(False)).unionByName(picked.withColumn("attention", F.lit(True)))
