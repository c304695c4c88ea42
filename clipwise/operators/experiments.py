"""Summaries of experiment matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialize


def summary(df: DataFrame, metric: str, *keys: str) -> DataFrame:
    """mean, population std and n of each cell; nulls are left out."""
    return df.groupBy(*keys).agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"), F.count(metric).alias("n"))


def pivoted(df: DataFrame, metric: str, row: str, column: str, values: list[str]) -> DataFrame:
    return df.groupBy(row).pivot(column, values).agg(F.avg(metric))


def best_per_group(df: DataFrame, group: str, score: str, *ties: str) -> DataFrame:
    """The row of each group with the highest score; ties go by the given columns, nulls come last."""
    order = Window.partitionBy(group).orderBy(F.desc_nulls_last(score), *ties)
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def slopes(df: DataFrame, value: str, *order: str, keys: tuple[str, ...] = (), rising: float = 0.01) -> DataFrame:
    """Adds ``delta`` to the step before and ``rising``: it is above the bound."""
    delta = F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("delta", delta).withColumn("rising", F.coalesce(delta > rising, F.lit(False)))


def favoured(difference: Column, band: float = 0.01) -> Column:
    return F.when(difference > band, "a").when(difference < -band, "b").otherwise("tie")


def delta_buckets(df: DataFrame, delta: str, *keys: str) -> DataFrame:
    """Counts of deltas below -0.05, in [-0.05, -0.02), from -0.02 on and from 0 on (the last two overlap), and the mean."""
    d = F.col(delta)
    return df.groupBy(*keys).agg(
        F.count_if(d < -0.05).alias("worse"),
        F.count_if((d >= -0.05) & (d < -0.02)).alias("slightly_worse"),
        F.count_if(d >= -0.02).alias("kept"),
        F.count_if(d >= 0).alias("better"),
        F.avg(d).alias("mean_delta"),
    )


def job_matrix(*sides: DataFrame) -> DataFrame:
    """Every combination of a few small parameter tables: the cross product that is the job list itself."""
    out = sides[0]
    for s in sides[1:]:
        out = out.crossJoin(s)
    return out


def pending(jobs: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    return jobs.join(done.select(*keys), list(keys), "left_anti")


def histogram(df: DataFrame, column: str, low: float, width: float, count: int, *keys: str) -> DataFrame:
    """Counts in ``count`` bins from ``low`` on, scaled to the largest; the last bin is closed, outliers are dropped."""
    x, high = F.col(column), low + width * count
    place = F.least(F.floor((x - low) / width), F.lit(count - 1)).cast("int")
    counts = df.where((x >= low) & (x <= high)).groupBy(*keys, place.alias("bin")).agg(F.count("*").alias("n"))
    return counts.withColumn("scaled", F.col("n") / F.max("n").over(Window.partitionBy(*keys)))


def rank_text(c: Column, missing: int = 999) -> Column:
    """Order of numeric strings; others last."""
    return F.coalesce(c.try_cast("int"), F.lit(missing))


def side_by_side(variants: dict[str, DataFrame], metric: str, *keys: str) -> DataFrame:
    """mean, std and n of each cell for several score tables, as columns ``<name>_mean`` and so on; a cell may lack some."""
    tagged = None
    for name, df in variants.items():
        one = df.select(F.lit(name).alias("_v"), *keys, F.col(metric).alias("_x"))
        tagged = one if tagged is None else tagged.unionByName(one)
    own = lambda v: F.when(F.col("_v") == v, F.col("_x"))
    cols = [f.alias(f"{v}_{n}") for v in variants for f, n in ((F.avg(own(v)), "mean"), (F.stddev_pop(own(v)), "std"), (F.count(own(v)), "n"))]
    return tagged.groupBy(*keys).agg(*cols)


def paired_means(pairs: DataFrame, a: str, b: str, *keys: str) -> DataFrame:
    """Mean of each side and of their difference, b less a."""
    return pairs.groupBy(*keys).agg(F.avg(a).alias("mean_a"), F.avg(b).alias("mean_b"), F.avg(F.col(b) - F.col(a)).alias("mean_delta"), F.count("*").alias("n"))


def correlation_distance(df: DataFrame, a: str, b: str, *keys: str) -> DataFrame:
    """One less Pearson's correlation, as ``distance``."""
    return df.groupBy(*keys).agg((1 - F.corr(a, b)).alias("distance"))


def mean_of_means(df: DataFrame, value: str, unit: str, place: str, *keys: str) -> DataFrame:
    """Mean of ``value`` by place within each unit, averaged over units, as ``level``: a long-term average spectrum."""
    first = df.groupBy(*keys, unit, place).agg(F.avg(value).alias("_m"))
    return first.groupBy(*keys, place).agg(F.avg("_m").alias("level"))


def pitch_summary(df: DataFrame, pitch: str, formant: str, *keys: str) -> DataFrame:
    """Median, 10th and 90th percentile of the pitch, medians and spread of the formant; nulls are left out."""
    return df.groupBy(*keys).agg(
        F.median(pitch).alias("mid"), F.percentile(pitch, 0.1).alias("p10"), F.percentile(pitch, 0.9).alias("p90"), F.median(formant).alias("formant"), F.stddev_pop(formant).alias("spread")
    )


def composite_distance(f1: Column, f2: Column, spread: Column, f0: Column) -> Column:
    """hypot(f1 / 100, f2 / 250) + |spread| / 150 + |f0| / 20, over differences."""
    return F.hypot(f1 / 100, f2 / 250) + F.abs(spread) / 150 + F.abs(f0) / 20


def semitone_rmse(df: DataFrame, a: str, b: str, *keys: str, least: int = 5) -> DataFrame:
    """Root mean square of aligned semitone differences, null under ``least`` pairs."""
    d = 12 * F.log2(F.col(a) / F.col(b))
    return df.where((F.col(a) > 0) & (F.col(b) > 0)).groupBy(*keys).agg(F.when(F.count("*") >= least, F.sqrt(F.avg(d * d))).alias("rmse"), F.count("*").alias("n"))


def class_scores(df: DataFrame, logits: list[str], label: str) -> DataFrame:
    """Adds ``probabilities`` (softmax of the logits) and ``nll``, the negative log of the label's (from 0)."""
    all_ = F.array(*logits)
    most = F.greatest(*logits) if len(logits) > 1 else F.col(logits[0])
    powers = F.transform(all_, lambda x: F.exp(x - most))
    total = F.aggregate(powers, F.lit(0.0), lambda s, x: s + x)
    return df.withColumn("probabilities", F.transform(powers, lambda x: x / total)).withColumn("nll", F.log(total) + most - F.get(all_, F.col(label)))


def confused(df: DataFrame, actual: str, predicted: str, least: int = 5) -> DataFrame:
    """Pairs of different classes that were taken for each other ``least`` times."""
    counts = df.where(F.col(actual) != F.col(predicted)).groupBy(actual, predicted).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least)


def accuracy_sweep(df: DataFrame, score: str, truth: str, thresholds: list[float]) -> DataFrame:
    """Share of right decisions (score > threshold) for each threshold, in one pass."""
    sums = [F.struct(F.lit(float(t)).alias("threshold"), F.avg(((F.col(score) > t) == F.col(truth)).cast("int")).alias("accuracy")).alias(f"t{i}") for i, t in enumerate(thresholds)]
    one = df.agg(*sums)
    return one.select(F.explode(F.array(*one.columns)).alias("t")).select("t.*")


def normalised(df: DataFrame, value: str, *keys: str, few: int = 10_000) -> DataFrame:
    """Adds ``z``: the value less its group's mean, over its population deviation. Statistics are aggregated and written, then joined.

    Those of at most ``few`` groups go to all rows, which stay where they are: a few classes of a large table would be a task each.
    """
    stats = materialize(df.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s")), "statistics")
    stats = F.broadcast(stats) if stats.count() <= few else stats
    return df.join(stats, list(keys)).withColumn("z", F.try_divide(F.col(value) - F.col("_m"), F.col("_s"))).drop("_m", "_s")


def crosstab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of each row's values; absent ones are 0."""
    return df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).fillna(0)
