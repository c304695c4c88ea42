"""A matrix of jobs as a stream: each micro-batch does the jobs that nothing has done yet, and commits by its number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def done(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """What batches have written, with the number of each in ``batch``."""
    return spark.read.schema(f"{schema}, batch bigint").parquet(out)


def resume(spark: SparkSession, jobs: DataFrame, out: str, checkpoint: str, keys: list[str], work: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    """Does ``work`` on the new jobs of a stream, appends to ``out`` and returns it; ``schema`` is what ``work`` returns, the keys included.

    A batch's rows are the folder ``batch=<number>``, which the batch replaces as a whole. A run that dies between the write and the
    checkpoint does the same batch again, over the same files, and leaves no row twice. Jobs repeated within a batch, or done by an
    earlier one, are left out; a batch doesn't look at its own folder, so a repetition does the same jobs. Keys aren't null.
    """

    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{out}/batch=-1")  # so that there is a table before the first batch

    def commit(batch: DataFrame, number: int) -> None:
        before = done(spark, out, schema).where(F.col("batch") < number).select(*keys)
        todo = batch.dropDuplicates(keys).join(before, keys, "left_anti")
        work(todo).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = jobs.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return done(spark, out, schema)
