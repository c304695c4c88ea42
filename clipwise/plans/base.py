"""Registration of queries, and the driver's tables in the roles that the operators expect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwise.operators.tables import materialize, scratch

__all__ = ["ORACLE_SQL", "QUERIES", "TURNS_SQL", "hinted", "materialize", "query", "scratch", "table", "turns"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query with its DuckDB SQL, if it has one."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hinted(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most so many rows, else without."""
    return F.broadcast(df) if df.count() <= rows else df


#: ``events`` as turns: the user is the lecture, the event type the speaker, times are hours.
TURNS_SQL = """turns AS (
  SELECT event_id AS id, user_id AS lecture, event_type AS speaker,
         CAST(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS DOUBLE) / 3600000000.0 AS "start",
         CAST(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS DOUBLE) / 3600000000.0 + value / 5.0 AS "end"
  FROM events)"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)").cast("double")
    start = micros / F.lit(3600000000.0)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("lecture"), F.col("event_type").alias("speaker"), start.alias("start"), (start + F.col("value") / F.lit(5.0)).alias("end")
    )
