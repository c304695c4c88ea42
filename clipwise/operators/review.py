"""Human review and blind listening tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decisions(report: DataFrame, saved: DataFrame, key: str) -> DataFrame:
    """The gate's decision, replaced by a saved one; ``override`` where the two differ."""
    joined = report.join(saved.select(key, F.col("decision").alias("_saved")), key, "left")
    gate = F.when(F.col("status") == "PASS", "keep").otherwise("cut")
    joined = joined.withColumn("gate", gate).withColumn("decision", F.coalesce("_saved", "gate"))
    return joined.withColumn("reviewed", F.col("_saved").isNotNull()).withColumn("override", F.col("decision") != F.col("gate")).drop("_saved")


def progress(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if("reviewed").alias("reviewed"),
        F.count_if(F.col("decision") == "keep").alias("kept"),
        F.count_if("override").alias("overridden"),
    )


def decoded_key(df: DataFrame, encoded: str) -> DataFrame:
    """Slots of a base64 JSON map: a row for each ``slot`` and ``identity``."""
    answer = F.from_json(F.unbase64(encoded).cast("string"), "map<string,string>")
    return df.select("*", F.explode(answer).alias("slot", "identity")).drop(encoded)


def ratings(df: DataFrame, *keys: str) -> DataFrame:
    """Mean of ratings above 0 and their number."""
    given = F.when(F.col("rating") > 0, F.col("rating"))
    return df.groupBy(*keys).agg(F.avg(given).alias("mean_rating"), F.count(given).alias("n_rated"))


def recommended(means: DataFrame, control: str, close: float = 0.25) -> DataFrame:
    """The best identity but the control; ``warn`` if the control is within ``close`` of it."""
    one = means.agg(
        F.max(F.when(F.col("identity") != control, F.struct("mean_rating", F.col("identity")))).alias("b"),
        F.max(F.when(F.col("identity") == control, F.col("mean_rating"))).alias("c"),
    )
    return one.select(F.col("b.identity").alias("identity"), F.col("b.mean_rating").alias("mean_rating"), F.coalesce(F.col("c") >= F.col("b.mean_rating") - close, F.lit(False)).alias("warn"))


def abx(df: DataFrame, *keys: str, chance: float = 0.65) -> DataFrame:
    """Share of right answers without abstentions (null), and whether it is no better than chance."""
    rate = F.avg(F.col("correct").cast("int"))
    return df.groupBy(*keys).agg(rate.alias("accuracy"), F.count("correct").alias("n_answered"), F.coalesce(rate < chance, F.lit(True)).alias("at_chance"))


def tag_counts(df: DataFrame, tags: str, *keys: str) -> DataFrame:
    """How often each tag of an array was given, a row each."""
    return df.select(*keys, F.explode(tags).alias("tag")).groupBy(*keys, "tag").agg(F.count("*").alias("n"))


def preferences(df: DataFrame, *keys: str) -> DataFrame:
    """Counts of ear's choices and of their agreement with a metric, and whether the attention check was passed.

    ``picked`` is A, B, same or null, ``a`` and ``b`` say what stood on each side, ``favoured`` what the metric prefers (or tie),
    ``attention`` marks the pair of identical sides. A tie counts as scored, but agrees with nothing.
    """
    real = ~F.col("attention")
    ear = F.when(F.col("picked") == "A", F.col("a")).when(F.col("picked") == "B", F.col("b")).otherwise("same")
    chosen = real & F.coalesce(F.col("picked") != "same", F.lit(False))
    return df.withColumn("_ear", ear).groupBy(*keys).agg(
        F.count_if(real & (F.col("_ear") == "orig")).alias("ear_orig"),
        F.count_if(real & (F.col("_ear") == "dn")).alias("ear_dn"),
        F.count_if(real & (F.col("_ear") == "same")).alias("same"),
        F.count_if(real & (F.col("favoured") == "orig")).alias("metric_orig"),
        F.count_if(chosen).alias("scored"),
        F.count_if(chosen & (F.col("_ear") == F.col("favoured"))).alias("agreed"),
        F.max(F.when(F.col("attention"), F.coalesce(F.col("picked") == "same", F.lit(False)))).alias("attentive"),
    )
