"""Quality gates and their calibration against labels."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwise.functions import text as T
from clipwise.functions.numbers import rounded, written

from .tables import materialize

#: Gates over a report's metrics (dur, align_min, align_mean, cer_core, sanskrit_load as ``load``, lead, trail).
BATTERY = {
    "AUTO-KEEP": "cer_core <= 0.80 AND align_min >= -45.0 AND abs(load) <= 0.40 AND dur BETWEEN 4.0 AND 20.0",
    "STRICT": "cer_core <= 0.70 AND align_min >= -40.0 AND abs(load) <= 0.30 AND dur BETWEEN 4.0 AND 18.0",
    "COMBO-A": "cer_core <= 0.70 AND align_mean >= -12.0 AND abs(load) <= 0.30 AND dur BETWEEN 4.0 AND 22.0",
    "COMBO-B": "cer_core <= 0.65 AND align_mean >= -11.0 AND abs(load) <= 0.25 AND dur BETWEEN 4.0 AND 20.0 AND lead <= 0.5 AND trail <= 0.5",
    "COMBO-C": "cer_core <= 0.60 AND align_mean >= -10.0 AND abs(load) <= 0.20 AND dur BETWEEN 4.0 AND 20.0 AND lead <= 0.4 AND trail <= 0.4",
    "COMBO-D": "cer_core <= 0.85 AND abs(load) <= 0.40 AND align_min >= -32.0",
}


def reason_histogram(df: DataFrame, reasons: str = "reasons") -> DataFrame:
    """Failures by code: reasons joined by semicolons, without the values in parentheses."""
    each = df.select(F.explode(F.split(F.col(reasons), ";")).alias("r")).where("r <> ''")
    return each.groupBy(F.substring_index("r", "(", 1).alias("reason")).agg(F.count("*").alias("n"))


def _running(counts: DataFrame, group: tuple[str, ...], x: str, sums: list[str], parts: int) -> DataFrame:
    """``counts`` (one row for each group and value) with ``up_<c>``: the sum of c over values up to the row's own, and ``all_<c>``.

    A prefix sum in two levels: rows are range-partitioned by group and value, so that no task holds more than its range, and
    each range of a group gets the totals of the ranges before it, from a table of one row a range. The ranges are
    written, as both uses must see the same ones.
    """
    ranged = materialize(counts.repartitionByRange(parts, *group, x).withColumn("_r", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy(*group, "_r").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = Window.partitionBy(*group).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    starts = totals.select(*group, "_r", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in sums], *[F.sum(f"_t_{c}").over(whole).alias(f"all_{c}") for c in sums])
    within = Window.partitionBy(*group, "_r").orderBy(x).rowsBetween(Window.unboundedPreceding, 0)
    own = ranged.select("*", *[F.sum(c).over(within).alias(f"_o_{c}") for c in sums])
    joined = own.join(starts, [*group, "_r"])
    return joined.select(*counts.columns, *[f"all_{c}" for c in sums], *[(F.col(f"_b_{c}") + F.col(f"_o_{c}")).alias(f"up_{c}") for c in sums])


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def floor_percentile(df: DataFrame, column: str, shares: tuple[float, ...], *keys: str) -> DataFrame:
    """For each share p the value at place min(n - 1, int(p * n)) of the sorted column.

    Values are counted first, and the counts summed up over ranges of values, so a class with most of the rows is
    spread over tasks; a value stands at all places between the counts before it and up to it.
    """
    return _placed_percentiles(df, column, {f"p{round(p * 100)}": p for p in shares}, keys, linear=False)


def linear_percentile(df: DataFrame, column: str, shares: dict[str, float], *keys: str) -> DataFrame:
    """For each named share p the value at place p * (n - 1), between two values on the line between them; spread like the above."""
    return _placed_percentiles(df, column, shares, keys, linear=True)


def _placed_percentiles(df: DataFrame, column: str, shares: dict[str, float], keys: tuple[str, ...], linear: bool) -> DataFrame:
    values = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("_x")).agg(F.count("*").alias("_n"))
    ranked = _running(values, keys, "_x", ["_n"], _parts(df))
    last, n = F.col("up__n") - 1, F.col("all__n")
    holds = lambda place: (place <= last) & (place > last - F.col("_n"))
    value = lambda place: F.max(F.when(holds(place), F.col("_x")))
    out = []
    for name, p in shares.items():
        at = F.lit(float(p)) * (n - 1) if linear else F.least(n - 1, F.floor(F.lit(float(p)) * n))
        low = value(F.floor(at))
        share = F.max(at - F.floor(at))
        out.append((low + (value(F.ceil(at)) - low) * share if linear else low).alias(name))
    return ranked.groupBy(*keys).agg(*out)


def unpivoted(df: DataFrame, metrics: list[str], cut: str = "is_cut") -> DataFrame:
    return df.unpivot([cut], metrics, "metric", "x").where("x is not null").withColumn("x", F.col("x").cast("double"))


def threshold_sweep(df: DataFrame, metrics: list[str], cut: str = "is_cut") -> DataFrame:
    """metric, direction, threshold, caught and flagged for every observed value, in both directions.

    Running counts over the distinct values of a metric, instead of a comparison of all rows with all thresholds; a metric with
    very many values is spread over ranges of them.
    """
    values = unpivoted(df, metrics, cut).groupBy("metric", "x").agg(F.count_if(cut).alias("cuts"), F.count_if(~F.col(cut)).alias("keeps"))
    up = _running(values, ("metric",), "x", ["cuts", "keeps"], _parts(df))
    down = lambda c: F.col(f"all_{c}") - F.col(f"up_{c}") + F.col(c)
    sides = F.array(
        F.struct(F.lit(">=").alias("direction"), down("cuts").alias("caught"), down("keeps").alias("flagged")),
        F.struct(F.lit("<=").alias("direction"), F.col("up_cuts").alias("caught"), F.col("up_keeps").alias("flagged")),
    )
    return up.select("metric", F.col("x").alias("threshold"), F.explode(sides).alias("s")).select("metric", "s.direction", "threshold", "s.caught", "s.flagged")


def best_gates(sweep: DataFrame) -> DataFrame:
    """The gate of each metric with the most cuts caught less keeps flagged; ties: caught, direction, threshold."""
    net = sweep.withColumn("net", F.col("caught") - F.col("flagged"))
    best = F.max(F.struct("net", "caught", F.when(F.col("direction") == "<=", 1).otherwise(0).alias("d"), (-F.col("threshold")).alias("t"))).alias("b")
    one = net.groupBy("metric").agg(best)
    direction = F.when(F.col("b.d") == 1, "<=").otherwise(">=")
    return one.select("metric", direction.alias("direction"), (-F.col("b.t")).alias("threshold"), F.col("b.caught").alias("caught"), (F.col("b.caught") - F.col("b.net")).alias("flagged"), F.col("b.net").alias("net"))


def or_pairs(df: DataFrame, atoms: Mapping[str, str], cut: str = "is_cut") -> DataFrame:
    """caught and flagged of each pair of atoms (name to predicate) joined by OR.

    Rows are first counted by the bits of the atoms they match, at most as many rows as there are such patterns; pairs
    are formed over those.
    """
    names = sorted(atoms)
    bits = df.select(F.col(cut).alias("_cut"), F.array(*[F.coalesce(F.expr(atoms[n]), F.lit(False)) for n in names]).alias("m"))
    patterns = bits.groupBy("m").agg(F.count_if("_cut").alias("cuts"), F.count_if(~F.col("_cut")).alias("keeps"))
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(i).alias("i"), F.lit(j).alias("j")) for i, a in enumerate(names) for j, b in enumerate(names) if i < j])
    each = patterns.withColumn("p", F.explode(pairs))
    hit = F.get("m", F.col("p.i")) | F.get("m", F.col("p.j"))
    return each.groupBy(F.col("p.a").alias("atom_a"), F.col("p.b").alias("atom_b")).agg(
        F.sum(F.when(hit, F.col("cuts")).otherwise(0)).alias("caught"), F.sum(F.when(hit, F.col("keeps")).otherwise(0)).alias("flagged")
    )


def confusion(df: DataFrame, gates: Mapping[str, str], cut: str = "is_cut") -> DataFrame:
    """For each gate (a predicate that keeps a row): kept, leak (cuts kept), caught, suspects (keeps dropped), yield.

    All gates in one pass; a null predicate drops the row.
    """
    keep = lambda g: F.coalesce(F.expr(g), F.lit(False))
    sums = [
        F.struct(
            F.lit(name).alias("gate"),
            F.count_if(keep(g)).alias("kept"),
            F.count_if(keep(g) & F.col(cut)).alias("leak"),
            F.count_if(~keep(g) & F.col(cut)).alias("caught"),
            F.count_if(~keep(g) & ~F.col(cut)).alias("suspects"),
            (F.count_if(keep(g)) / F.count("*")).alias("yield"),
        ).alias(f"g{i}")
        for i, (name, g) in enumerate(gates.items())
    ]
    one = df.agg(*sums)
    return one.select(F.explode(F.array(*one.columns)).alias("g")).select("g.*")


def class_gap(df: DataFrame, metric: str, cut: str = "is_cut") -> DataFrame:
    """Largest value among keeps and smallest among cuts."""
    return df.agg(F.max(F.when(~F.col(cut), F.col(metric))).alias("max_keep"), F.min(F.when(F.col(cut), F.col(metric))).alias("min_cut"))


def projection(kept: Column, total: Column, wanted: int) -> Column:
    """Struct of the share kept, and the rows needed to keep ``wanted``."""
    share = kept / total
    return F.struct(share.alias("share"), F.ceil(F.lit(wanted) / share).alias("needed"))


#: The production gate's bounds.
PRODUCTION = {"min_align": -1e9, "max_lead": 0.7, "max_trail": 1.0, "max_cer_core": 0.85}


def production_reasons(bounds: Mapping[str, float] = PRODUCTION, *, backbone: bool = False) -> Column:
    """Why a clip fails: ``missing_wav`` alone if it has no audio, else each bound that it breaks, with its value.

    Columns: has_wav, align_min, lead and trail (null for silence throughout), cer_core (null if not measured, which ``backbone`` makes
    a reason of its own: a clip without a word of the dictionary has nothing to compare).
    """
    rules = T.reasons(
        (F.col("align_min") < bounds["min_align"], T.with_value("low_align", F.col("align_min"))),
        (F.col("lead").isNull(), F.lit("all_silence")),
        (F.col("lead") > bounds["max_lead"], T.with_value("lead_sil", F.col("lead"))),
        (F.col("trail") > bounds["max_trail"], T.with_value("trail_sil", F.col("trail"))),
        (F.col("cer_core") > bounds["max_cer_core"], T.with_value("high_cer_core", F.col("cer_core"))),
        (F.col("cer_core").isNull() & F.lit(backbone), F.lit("no_backbone")),
    )
    return F.when(~F.coalesce(F.col("has_wav"), F.lit(False)), F.array(F.lit("missing_wav"))).otherwise(rules)


def borderline() -> Column:
    """Which conditions of the AUTO-KEEP gate a clip breaks, with their values."""
    return T.reasons(
        (F.col("cer_core") > 0.80, written("cer_core=%s", "cer_core")),
        (F.col("align_min") < -45.0, written("align_min=%s", "align_min", 1)),
        (F.abs("load") > 0.40, written("sload=%s", "load")),
        (~F.col("dur").between(4.0, 20.0), written("dur=%s", "dur", 1)),
    )


def confusion_ids(df: DataFrame, gates: Mapping[str, str], key: str, cut: str = "is_cut") -> DataFrame:
    """gate, kind (leak: a cut that is kept; suspect: a keep that is dropped) and key, a row each.

    Rows, not lists: a gate may leak any number of them.
    """
    keep = lambda g: F.coalesce(F.expr(g), F.lit(False))
    kinds = [
        F.when(keep(g) & F.col(cut), F.struct(F.lit(n).alias("gate"), F.lit("leak").alias("kind"))).when(
            ~keep(g) & ~F.col(cut), F.struct(F.lit(n).alias("gate"), F.lit("suspect").alias("kind"))
        )
        for n, g in gates.items()
    ]
    return df.select(key, F.explode(F.array_compact(F.array(*kinds))).alias("g")).select("g.*", key)


#: The shares at which candidate thresholds are taken.
SHARES = (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)


def candidates(df: DataFrame, metrics: list[str], shares: tuple[float, ...] = SHARES, cut: str = "is_cut") -> DataFrame:
    """metric and threshold: distinct floor percentiles of each metric, rounded to 4 places."""
    long = unpivoted(df, metrics, cut)
    wide = floor_percentile(long, "x", shares, "metric")
    each = F.explode(F.array(*[c for c in wide.columns if c != "metric"])).alias("x")
    return wide.select("metric", each).select("metric", rounded("x", 4).alias("threshold")).distinct()


def atoms(df: DataFrame, metrics: list[str], least: int = 3, most: int = 70, cut: str = "is_cut") -> DataFrame:
    """Candidate thresholds in both directions that catch ``least`` cuts and flag at most ``most`` keeps.

    metric, direction, threshold, caught, flagged. Rows are counted by value first, and the counts meet the few
    thresholds of their metric, which are broadcast: 15 a metric at most.
    """
    values = unpivoted(df, metrics, cut).groupBy("metric", "x").agg(F.count_if(cut).alias("cuts"), F.count_if(~F.col(cut)).alias("keeps"))
    sides = F.explode(F.array(F.lit(">="), F.lit("<="))).alias("direction")
    rules = candidates(df, metrics, cut=cut).select("metric", "threshold", sides)
    met = values.join(F.broadcast(rules), "metric")
    hit = F.when(F.col("direction") == ">=", F.col("x") >= F.col("threshold")).otherwise(F.col("x") <= F.col("threshold"))
    sums = met.groupBy("metric", "direction", "threshold").agg(
        F.sum(F.when(hit, F.col("cuts")).otherwise(0)).alias("caught"), F.sum(F.when(hit, F.col("keeps")).otherwise(0)).alias("flagged")
    )
    return sums.where((F.col("caught") >= least) & (F.col("flagged") <= most))


def top_atoms(found: DataFrame, n: int = 40) -> DataFrame:
    """The ``n`` atoms with the most cuts caught less keeps flagged; ties by metric, direction and threshold."""
    net = found.withColumn("net", F.col("caught") - F.col("flagged"))
    return net.orderBy(F.desc("net"), "metric", "direction", "threshold").limit(n)


def best_or(df: DataFrame, found: DataFrame, cut: str = "is_cut", pool: int = 40) -> DataFrame:
    """The best single atom, and the best OR of two and of three of the ``pool`` top ones: size, rule, caught, flagged.

    More cuts caught wins, then fewer keeps flagged, then the rule's text. Pairs of one metric and direction are skipped. The
    pool is collected, as a few rules are what combinations are made of; rows are then counted once by which atoms they match.
    """
    text = lambda r: f"{r['metric']} {r['direction']} {r['threshold']:.4f}"
    singles = found.select(F.lit(1).alias("size"), F.format_string("%s %s %.4f", "metric", "direction", "threshold").alias("rule"), "caught", "flagged")
    best = singles.orderBy(F.desc("caught"), "flagged", "rule").limit(1)
    rules = sorted(top_atoms(found, pool).collect(), key=text)
    n = len(rules)
    combos = [(i, j) for i in range(n) for j in range(i + 1, n) if (rules[i]["metric"], rules[i]["direction"]) != (rules[j]["metric"], rules[j]["direction"])]
    combos += [(i, j, k) for i in range(n) for j in range(i + 1, n) for k in range(j + 1, n)]
    if not combos:
        return best
    hit = lambda r: F.coalesce(F.expr(f"{r['metric']} {r['direction']} {r['threshold']!r}D"), F.lit(False))
    bits = F.lit(0).cast("bigint")
    for i, r in enumerate(rules):
        bits = bits + F.when(hit(r), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    patterns = df.select(F.col(cut).alias("_cut"), bits.alias("m")).groupBy("m").agg(F.count_if("_cut").alias("cuts"), F.count_if(~F.col("_cut")).alias("keeps"))
    masks = np.array([sum(1 << i for i in c) for c in combos], np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caught, flagged = np.zeros(len(masks), np.int64), np.zeros(len(masks), np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                m, cuts, keeps = (c.to_numpy() for c in batch.slice(a, 1000).columns)
                matched = (m[:, None] & masks[None]) != 0
                caught += cuts @ matched
                flagged += keeps @ matched
        yield pa.record_batch([pa.array(np.arange(len(masks))), pa.array(caught), pa.array(flagged)], ["i", "caught", "flagged"])

    sums = patterns.mapInArrow(count, "i bigint, caught bigint, flagged bigint").groupBy("i").agg(F.sum("caught").alias("caught"), F.sum("flagged").alias("flagged"))
    named = [(i, len(c), " OR ".join(text(rules[j]) for j in c)) for i, c in enumerate(combos)]
    sums = sums.join(df.sparkSession.createDataFrame(named, "i bigint, size int, rule string"), "i").select("size", "rule", "caught", "flagged")
    order = Window.partitionBy("size").orderBy(F.desc("caught"), "flagged", "rule")
    return best.union(sums.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n"))


def suspects(df: DataFrame, metric: str, thresholds: list[float], cut: str = "is_cut") -> DataFrame:
    """For each threshold how many keeps and cuts lie at or below it."""
    each = df.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))).where(F.col(metric) <= F.col("threshold"))
    return each.groupBy("threshold").agg(F.count_if(~F.col(cut)).alias("suspects"), F.count_if(cut).alias("caught"))
