"""Biases and latent factors of a sparse table of ratings, by block-partitioned alternating least squares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import materialize, scratch_root


@dataclass(frozen=True)
class Factors:
    """``mean``, user (user, bu, fu) and item (item, bi, fi) tables; a side's vector is null where its rows were too few to have one."""

    mean: float
    users: DataFrame
    items: DataFrame


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def fit(ratings: DataFrame, *, rank: int = 8, ridge: float = 0.1, rounds: int = 10, shrink: float = 5.0, seed: int = 1, blocks: int = 10) -> Factors:
    """Fits ``ratings`` (user int, item int, rating double; one row a pair, rows with a null are left out).

    Biases are means of what the mean and the other side's bias leave, shrunk as if there were ``shrink`` more ratings of 0. Factors are
    fitted to the rest: users and items lie in ``blocks`` blocks each, and in turn each block solves its rows' least squares from the
    vectors that other blocks send it, so no side is ever whole in a task. Rounds are cut by checkpoints in the
    shared folder. An empty table gives a mean of 0 and empty sides.
    """
    spark = ratings.sparkSession
    known = materialize(ratings.where("user is not null and item is not null and rating is not null").select(F.col("user").cast("int"), F.col("item").cast("int"), F.col("rating").cast("double")), "ratings")
    mean = known.agg(F.avg("rating")).first()[0] or 0.0

    def bias(rest: Column, df: DataFrame, side: str, name: str) -> DataFrame:
        return df.groupBy(side).agg((F.sum(rest) / (F.count("*") + shrink)).alias(name))

    # Each table is written once and the next reads it; users' biases are taken from the residuals, where they stand in each row.
    items = materialize(bias(F.col("rating") - mean, known, "item", "bi"), "item-biases")
    less = known.join(items, "item")
    users = bias(F.col("rating") - mean - F.col("bi"), less, "user", "bu")
    rest = materialize(less.join(users, "user").select("user", "item", (F.col("rating") - mean - F.col("bi") - F.col("bu")).alias("rating"), "bu"), "residuals")
    users = materialize(rest.groupBy("user").agg(F.first("bu").alias("bu")), "user-biases")
    if rest.isEmpty():
        return Factors(mean, users.withColumn("fu", F.lit(None).cast("array<float>")), items.withColumn("fi", F.lit(None).cast("array<float>")))
    spark.sparkContext.setCheckpointDir(scratch_root(spark))
    model = ALS(rank=rank, regParam=ridge, maxIter=rounds, seed=seed, userCol="user", itemCol="item", ratingCol="rating", numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=4).fit(rest.select("user", "item", "rating"))
    side = lambda vectors, name, to: vectors.select(F.col("id").alias(name), F.col("features").alias(to))
    return Factors(mean, materialize(users.join(side(model.userFactors, "user", "fu"), "user", "left"), "users"), materialize(items.join(side(model.itemFactors, "item", "fi"), "item", "left"), "items"))


def predict(pairs: DataFrame, model: Factors) -> DataFrame:
    """Pairs (user, item) with ``by_bias`` and ``by_factors``; an unknown side has no bias and no vector, and counts as average."""
    joined = pairs.join(model.users, "user", "left").join(model.items, "item", "left")
    base = F.lit(model.mean) + F.coalesce("bu", F.lit(0.0)) + F.coalesce("bi", F.lit(0.0))
    return joined.withColumn("by_bias", base).withColumn("by_factors", base + F.coalesce(dot(F.col("fu"), F.col("fi")), F.lit(0.0))).drop("bu", "bi", "fu", "fi")


def errors(held: DataFrame, model: Factors) -> DataFrame:
    """Root mean square errors over held-out ratings: ``n``, ``bias_rmse`` and ``factor_rmse``."""
    rmse = lambda c: F.sqrt(F.avg(F.pow(F.col("rating") - F.col(c), F.lit(2.0))))
    return predict(held, model).agg(F.count("*").alias("n"), rmse("by_bias").alias("bias_rmse"), rmse("by_factors").alias("factor_rmse"))
