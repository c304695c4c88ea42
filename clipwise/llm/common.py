"""What the operators share: tables, words, scratch tables and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: what lies between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only; ``lower`` would change other letters too, but is faster on ASCII."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's scratch tables, in the one that ``spark.checkpoint.dir`` names and all executors share.

    Only in local mode, where one machine is all there is, a folder of our own stands in for an unset one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"{tempfile.gettempdir()}/clipwise-checkpoints"
    return f"{root.rstrip('/')}/clipwise/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for a scratch table. Results read from these, so they stay until ``drop_scratch``."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Deletes this application's scratch tables; for the end of a run, when all results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage with a written table, which outlives any executor."""
    spark = df.sparkSession
    df.write.parquet(path := scratch(spark, name))
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run meanwhile pass at most ``rows`` rows to Python at once, on both sides of the pipe; for rows that hold whole sets."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def arrow_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs run meanwhile pass at most about ``size`` bytes to Python at once; both sides of the pipe hold a few such batches a task."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Returns what Arrow's pool and the C library keep for later; workers are reused, and each would keep its largest task's memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, whose memory goes back to the system when a partition ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def grouped_batches(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Splits a stream that is sorted by ``key`` into one table for each key.

    Holds one key's rows at a time, and one batch.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _lowest(df: DataFrame, column: Column, write: bool) -> DataFrame:
    """a and m, the least of ``column``, for every node a of ``df``."""
    low = df.groupBy("a").agg(column.alias("m"))
    return materialize(low, "lowest") if write else low


def connected_components(edges: DataFrame, name: str = "components", *, split_edges: int = 10_000) -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star rounds.

    ``edges`` has two long columns ``a`` and ``b``; repeated edges, loops and edges in either
    direction are allowed, rows with a null are ignored. Returns ``node`` and ``component`` (the
    component's smallest node) for every node that has an edge. Each round is two
    aggregations over the edges and is written to the shared folder, so nothing is gathered on
    the driver and a lost executor costs one round.

    Hot nodes are pre-aggregated before the shuffle. Edges then meet their node's minimum; from ``split_edges`` edges on the
    minima are written first, so that the join is one of two plain shuffles, whose hot keys AQE splits (a join in the stage
    of the aggregation isn't split).
    """
    edges = materialize(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        name,
    )
    before, n = None, edges.count()
    while n:
        write = n >= split_edges
        # Large star: every larger neighbour of a node points to its smallest neighbour.
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _lowest(both, F.least(F.min("b"), F.col("a")), write)
        large = (
            both.join(low, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        large = materialize(large, "large-star") if write else large
        # Small star: a node and its smaller neighbours point to the smallest of them.
        low = _lowest(large, F.min("b"), write)
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        edges = materialize(small, name)
        n, total = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, total) == before:
            break
        before = n, total
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
