"""Exact top-k inner-product search by MaxScore over sharded postings."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null where a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(n, -1)


def maxscore(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, seeds: int = 256):
    """The ``k`` best rows of one shard for every query: (query_id, id, score) arrays.

    A component is a term, and a shard's column of it that term's postings. A term adds between
    its lower and its upper bound in the shard. ``theta`` is the k-th best score so far, at first over a few
    seeds. Terms are taken by their range; those at the end, whose upper bounds together can't
    lift any row to ``theta``, are non-essential. Essential postings are added up for all rows, then
    the others are probed, a few terms at a time, for rows that can still reach ``theta``.
    Equal scores stay competitive, so ties are exact.
    """
    n, dim = rows.shape
    limit = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(dim, 1)
    kind = np.float64 if limit < 2**52 else object  # exact sums either way
    postings = np.ascontiguousarray(rows.T.astype(kind))
    low, high = (rows.min(axis=0), rows.max(axis=0)) if dim else (rows[:0, :0].sum(axis=0),) * 2
    low, high = low.astype(kind), high.astype(kind)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for query_id, raw in zip(query_ids, queries, strict=True):
        q = raw.astype(kind)
        upper, lower = np.maximum(q * low, q * high), np.minimum(q * low, q * high)
        order = np.argsort(-(upper - lower).astype(np.float64), kind="stable")
        rest = np.concatenate([np.cumsum(upper[order][::-1])[::-1], np.zeros(1, kind)])  # what terms from t on can add
        own = ids == query_id
        first = np.flatnonzero(~own)[:seeds]
        scores = q @ postings[:, first]
        theta = np.sort(scores)[-k] if len(first) >= k else None
        if theta is None or len(first) == n - int(own.sum()):
            alive, scores = first, scores
        else:
            # Non-essential: without essential terms (at their lower bounds) no row reaches theta.
            floor = np.concatenate([np.zeros(1, kind), np.cumsum(lower[order])])
            cut = int(np.argmax(floor + rest < theta)) if (floor + rest < theta).any() else dim
            scores = q[order[:cut]] @ postings[order[:cut]] if cut else np.zeros(n, kind)
            alive = np.flatnonzero((scores + rest[cut] >= theta) & ~own)
            scores = scores[alive]
            for t in range(cut, dim, 8):
                terms = order[t : t + 8]
                scores = scores + q[terms] @ postings[np.ix_(terms, alive)]
                still = scores + rest[min(t + 8, dim)] >= theta
                alive, scores = alive[still], scores[still]
                if len(alive) > k:
                    theta = max(theta, np.sort(scores + 0)[-k] + sum(lower[order[t + 8 :]]))
        best = np.lexsort((ids[alive], -scores.astype(np.float64) if kind is np.float64 else [-x for x in scores]))[:k]
        found.append((np.full(len(best), query_id), ids[alive][best], scores[best].astype(np.int64)))
    return [np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else ((), (), ()))]


def search(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 5,
    rows_per_shard: int = 65_536,
    queries_per_block: int = 16_384,
    least_rows: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id and score of every query's ``k`` highest integer inner products.

    Both tables have ``vec_id`` (long) and ``vector`` (array of long). Rows are dealt to shards by a
    hash of the id and the vector, queries to blocks; every block meets every shard once, in a task that holds
    ``rows_per_shard`` rows and ``queries_per_block`` queries on average, whatever the sizes of the
    tables (at 64 components 34 MB and 8 MB); a small table has shards of ``least_rows`` rows and more, one for each core. So
    rows are copied once for every block, and queries once for every shard. Shards return ``k`` rows for a query; a rank per
    query merges them.

    Null vectors and null ids take no part. A row with the query's id is not its candidate. Ties go to the
    smaller id; repeated query rows count once, repeated candidate rows each. Vectors of
    different lengths don't meet. An empty table gives no rows. Sums are exact; a score beyond a long raises. Other columns, such
    as shard, block or dim, take no part.
    """
    n = vectors.count()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    shards = max(1, math.ceil(n / rows_per_shard), min(cores, math.ceil(n / least_rows)))
    blocks = max(1, math.ceil(queries.count() / queries_per_block))
    usable = "vec_id is not null and vector is not null"
    side = lambda df, own, n, other, m: df.where(usable).select(
        "vec_id",
        "vector",
        F.size("vector").alias("dim"),
        F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int").alias(own),
        F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other),
    )
    keys = ["dim", "shard", "block"]
    left = side(vectors, "shard", shards, "block", blocks)
    right = side(queries.select("vec_id", "vector").distinct(), "block", blocks, "shard", shards).select(*left.columns)

    def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        got = maxscore(
            rows["vec_id"].to_numpy(),
            _matrix(rows["vector"], rows.num_rows),
            asked["vec_id"].to_numpy(),
            _matrix(asked["vector"], asked.num_rows),
            k,
        )
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, got), strict=True)))

    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", quantised(F.col("embedding")).alias("vector"))
    return search(rows, rows.where("vec_id % 50 = 0"))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
