"""Work on one recording after another, where a recording that fails is set aside and the others go on."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import scratch


@dataclass(frozen=True)
class Isolated:
    """``results`` of the groups that went well, ``flagged`` ones with their reason, and how many there were of each."""

    results: DataFrame
    flagged: DataFrame
    counts: dict[str, int]


def isolated(rows: DataFrame, keys: Sequence[str], work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> Isolated:
    """``work`` on each group of ``keys`` (not null), by itself: a group that raises gives one flagged row, with ``error:`` and what was raised.

    ``work`` takes a group's rows, which fit a task, and returns rows of ``schema``, which are put after the keys. A group's rows
    come out all or not at all. Results of the wrong columns count as a failure of their group. The work is done once: its
    rows are written, and both tables read from there; counts are observed meanwhile. A lost executor repeats
    only its own groups, and a worker that dies outright still ends the job.
    """
    spark, keys = rows.sparkSession, list(keys)
    result = StructType.fromDDL(schema) if hasattr(StructType, "fromDDL") else spark.createDataFrame([], schema).schema
    names = result.fieldNames()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        key = {k: group[k].iloc[0] for k in keys}
        try:
            out, reason = work(group)[names].copy(), None
        except Exception as e:  # noqa: BLE001  whatever a group's work raises is that group's reason
            out, reason = pd.DataFrame({n: [None] for n in names}), f"error:{e}"
        for k, v in key.items():
            out[k] = v
        out["_reason"], out["_rows"] = reason, len(group)
        out["_lead"] = [True, *[False] * (len(out) - 1)][: len(out)]
        return out[[*keys, *names, "_reason", "_rows", "_lead"]]

    done = rows.groupBy(*keys).applyInPandas(run, f"{fields}, {', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in result.fields)}, _reason string, _rows long, _lead boolean")
    seen = Observation()
    bad = F.col("_reason").isNotNull()
    observed = done.observe(seen, F.count(F.when(~bad, 1)).alias("results"), F.count(F.when(~bad & F.col("_lead"), 1)).alias("groups"), F.count(F.when(bad, 1)).alias("flagged"))
    observed.write.parquet(path := scratch(spark, "isolated"))
    table = spark.read.schema(done.schema).parquet(path)
    flagged = table.where(bad).select(*keys, F.col("_reason").alias("reason"), F.col("_rows").alias("rows"))
    return Isolated(table.where(~bad).select(*keys, *names), flagged, dict(seen.get))
