"""Greedy cuts of long recordings without a fold: where a clip that starts at a row ends, and which rows a chain of clips meets.

A greedy cut depends on the cut before it, so a fold over a recording's rows is the plain way (see ``timeline``), and holds the
recording in one row. Here every row gets the place where a clip that started there would end, by two sorts, and the
chain from the first row is found by doubling: after k rounds the first 2^k clips are known.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialize

#: Less than 1.5 and more than half of the step to the next double, relative to a positive one.
_STEP = 0.75 * 2.0**-52


@dataclass(frozen=True)
class Rule:
    """A clip ends at a row whose end is ``limit`` or more (above it if ``strict``) after the clip's start, if ``flag`` holds there."""

    limit: float
    strict: bool = False
    flag: str | None = None

    def reached(self, end: Column, start: Column) -> Column:
        return end - start > self.limit if self.strict else end - start >= self.limit

    def threshold(self, start: Column) -> Column:
        """The least end that reaches the limit in double arithmetic: ``start + limit`` or one of its neighbours."""
        near = start + self.limit
        step = F.abs(near) * F.lit(_STEP)
        tried = [near - step, near, near + step]
        return F.coalesce(*[F.when(self.reached(x, start), x) for x in tried], near + step + step)


def numbered(rows: DataFrame, *order: str, keys: Sequence[str]) -> DataFrame:
    """Rows with ``i``, their place from 0, ``n``, their group's rows, and ``before`` and ``last``, the ends of the row before and of the last one."""
    over, whole = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys)
    placed = rows.withColumn("i", (F.row_number().over(over) - 1).cast("long")).withColumn("before", F.lag("end").over(over))
    return placed.withColumn("n", F.count("*").over(whole)).withColumn("last", F.max_by("end", "i").over(whole))


def first_reached(rows: DataFrame, rules: Sequence[Rule], *, after: int, keys: Sequence[str]) -> DataFrame:
    """For every numbered row the first one, at least ``after`` places on, whose end reaches a rule: ``at``, its ``end`` and ``before``.

    Rows are sorted by start, so the rows whose clip could end at e by a rule are the first ones, up to a count that one sort of
    ends and thresholds gives. None of them may lie behind ``e - after``. With the last such row of each e as its
    value, a row's answer is the least e with a value at or beyond the row's place: a running minimum by falling values.
    Both windows are by ``keys``, so a recording is sorted in one task, spilling if need be, and not gathered.
    """
    kinds = [F.struct(F.col("end").alias("v"), F.lit(len(rules)).alias("kind")), *[F.struct(r.threshold(F.col("start")).alias("v"), F.lit(k).alias("kind")) for k, r in enumerate(rules)]]
    marks = rows.select("*", F.explode(F.array(*kinds)).alias("mark")).select("*", "mark.*").drop("mark")
    rising = Window.partitionBy(*keys).orderBy("v", "kind").rowsBetween(Window.unboundedPreceding, 0)
    counted = marks.select("*", *[F.count(F.when(F.col("kind") == k, 1)).over(rising).alias(f"c{k}") for k in range(len(rules))]).where(F.col("kind") == len(rules))
    serves = [F.when(F.col(r.flag) if r.flag else F.lit(True), F.least(F.col(f"c{k}") - 1, F.col("i") - after)) for k, r in enumerate(rules)]
    value = F.greatest(*serves, F.lit(-1).cast("long"))
    asked = counted.withColumn("ask", F.explode(F.array(F.struct(value.alias("w"), F.lit(0).alias("asks")), F.struct(F.col("i").alias("w"), F.lit(1).alias("asks"))))).select("*", "ask.*").drop("ask")
    falling = Window.partitionBy(*keys).orderBy(F.col("w").desc(), "asks").rowsBetween(Window.unboundedPreceding, 0)
    found = asked.withColumn("hit", F.min(F.when(F.col("asks") == 0, F.struct(F.col("i").alias("at"), F.col("end").alias("hit_end"), F.col("before").alias("hit_before")))).over(falling))
    return found.where("asks = 1").select(*keys, "i", "n", "start", "last", "hit.*")


def chain(steps: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """The rows of ``steps`` that the chain from place 0 meets; ``next`` is the place after ``i``, null at the end.

    In each round the rows that are known jump 2^k steps, and jumps are joined with themselves, so the rounds are the logarithm of
    the longest chain. Only places that some row jumps to are kept. Each round is written, and a lost executor costs one.
    """
    keys = list(keys)
    met = steps.where("next is not null").select(*keys, F.col("next").alias("i")).distinct().withColumn("_met", F.lit(True))
    steps = materialize(steps.join(met, [*keys, "i"], "left").where("_met or i = 0").drop("_met"), "steps")
    known, jumps = steps.where("i = 0").select(*keys, "i"), steps.where("next is not null").select(*keys, "i", "next")
    while True:
        ahead = materialize(known.join(jumps, [*keys, "i"]).select(*keys, F.col("next").alias("i")), "ahead")
        if ahead.isEmpty():
            break
        known = materialize(known.union(ahead), "known")
        jumps = materialize(jumps.join(jumps.select(*keys, F.col("i").alias("next"), F.col("next").alias("then")), [*keys, "next"]).select(*keys, "i", F.col("then").alias("next")), "jumps")
    return steps.join(known, [*keys, "i"], "left_semi")
