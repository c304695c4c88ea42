"""Vector arithmetic on arrays, in doubles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """The vector over its length, which counts as 1e-12 at least."""
    n = F.greatest(norm(v), F.lit(1e-12))
    return F.transform(v, lambda x: x / n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.greatest(norm(a), F.lit(1e-12)) * F.greatest(norm(b), F.lit(1e-12)))


def mean(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """Mean vector of each group as ``mean``.

    Components are averaged by place, partially before the shuffle: a group's rows never meet in one task.
    """
    each = df.select(*keys, F.posexplode(doubles(F.col(vector))).alias("_at", "_x"))
    means = each.groupBy(*keys, "_at").agg(F.avg("_x").alias("_x"))
    whole = F.transform(F.array_sort(F.collect_list(F.struct("_at", "_x"))), lambda s: s["_x"])
    return means.groupBy(*keys).agg(whole.alias("mean"))


def centroid(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """Mean vector of each group, scaled to length 1, as ``centroid``."""
    return mean(df, vector, *keys).select(*keys, unit(F.col("mean")).alias("centroid"))


def loudness_gain(rms: Column, peak: Column, target: Column, guard: float = 0.99) -> Column:
    """Gain that brings ``rms`` to ``target`` without a peak above ``guard``."""
    gain = F.coalesce(F.try_divide(target, rms), F.lit(1.0))
    return F.when(peak * gain > guard, F.lit(guard) / peak).otherwise(gain)


def semitones(a: Column, b: Column) -> Column:
    return 12 * F.log2(a / b)


def latent_score(a: Column, b: Column, bias_a: Column, bias_b: Column) -> Column:
    """Dot product of two factors and both biases."""
    return dot(a, b) + bias_a + bias_b


def principal(df: DataFrame, vector: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and the ``k`` main axes (rows) of all vectors; each axis's largest component is positive.

    Tasks add up their moments, which are summed in groups of rows of the matrix; the driver gets one matrix of the vectors'
    length squared, whatever their number.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(0).to_pylist(), np.float64)
                x = np.hstack([np.ones((len(x), 1)), x])
                total = x.T @ x + (0 if total is None else total)
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    rows = df.where(F.col(vector).isNotNull()).select(doubles(F.col(vector)).alias("v")).mapInArrow(moments, "i bigint, row array<double>")
    each = rows.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    got = each.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "x"))).alias("row")).orderBy("i").collect()
    m = np.array([[c["x"] for c in r["row"]] for r in got])
    n, mean_ = m[0, 0], m[0, 1:] / m[0, 0]
    values, axes = np.linalg.eigh(m[1:, 1:] / n - np.outer(mean_, mean_))
    out = axes[:, np.argsort(-values)[:k]].T
    return mean_, out * np.sign(out[np.arange(len(out)), np.abs(out).argmax(axis=1)])[:, None]


def projected(df: DataFrame, vector: str, mean_: np.ndarray, axes: np.ndarray, name: str = "projection") -> DataFrame:
    """Adds the vector's coordinates on the axes."""
    centred = F.zip_with(doubles(F.col(vector)), F.lit(mean_.tolist()), lambda x, y: x - y)
    return df.withColumn("_c", centred).withColumn(name, F.array(*[dot(F.col("_c"), F.lit(a.tolist())) for a in axes])).drop("_c")


def nearest(rows: DataFrame, asked: DataFrame, key: str, vector: str, *, block: int = 2048, shard: int = 20_000) -> DataFrame:
    """query, neighbour and cos: for each row of ``asked`` the other row with the highest cosine (9 places; ties: the smaller key).

    Rows are dealt to shards and queries to blocks by a hash; each pair meets in one task, as a matrix product of at most
    about ``shard`` by ``block`` rows, and gives one row a query. Null vectors take no part; all have the same length.
    """
    shards, blocks = max(1, -(-rows.count() // shard)), max(1, -(-asked.count() // block))
    side = lambda df, own, n, other, m: df.where(F.col(vector).isNotNull()).select(
        F.col(key).alias("id"), unit(doubles(F.col(vector))).alias("u"), F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other)
    )
    left = side(rows, "s", shards, "b", blocks)
    right = side(asked, "b", blocks, "s", shards).select(*left.columns)

    def meet(a: pa.Table, q: pa.Table) -> pa.Table:
        if not a.num_rows or not q.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "neighbour": pa.array([], pa.int64()), "r": pa.array([], pa.float64()), "cos": pa.array([], pa.float64())})
        matrix = lambda t: t["u"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        ids, names, m = a["id"].to_numpy(), q["id"].to_numpy(), matrix(a)
        order = np.argsort(ids, kind="stable")
        ids, m = ids[order], m[order]
        out: list[list[np.ndarray]] = [[], [], []]
        for i in range(0, len(names), 256):
            cos = matrix(q.slice(i, 256)) @ m.T
            cos[names[i : i + 256, None] == ids[None]] = -np.inf
            best = np.round(cos, 9).argmax(axis=1)  # the first of equal ones has the smallest id
            top = cos[np.arange(len(best)), best]
            for to, x in zip(out, (names[i : i + 256], ids[best], top), strict=True):
                to.append(x[np.isfinite(top)])
        query, neighbour, top = map(np.concatenate, out)
        return pa.table({"query": query, "neighbour": neighbour, "r": np.round(top, 9), "cos": top})

    hits = left.groupBy("s", "b").cogroup(right.groupBy("s", "b")).applyInArrow(meet, "query bigint, neighbour bigint, r double, cos double")
    best = hits.groupBy("query").agg(F.max(F.struct("r", (-F.col("neighbour")).alias("neg"), "cos")).alias("b"))
    return best.select("query", (-F.col("b.neg")).alias("neighbour"), F.col("b.cos").alias("cos"))
