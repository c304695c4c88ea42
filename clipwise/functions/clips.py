"""Words to clips as a table function, for SQL: a recording's words go by in order, and only the open clip is held."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import DoubleType, IntegerType, Row, StructType


class ClipsOf:
    """``SELECT * FROM clips_of(TABLE(words) PARTITION BY lecture ORDER BY (start, end, id))``.

    The rows of ``timeline.greedy_clips`` for each partition: ``first``, ``last`` (from 0), ``start``, ``end``, after the columns named in ``keys``
    (a list separated by commas, ``lecture`` unless given), which the partition's rows share. The table has ``start``, ``end`` and ``stops``. A clip
    is closed when it lasts ``most``, or ``least`` at a word that stops; those outside 4 to 30 are dropped. Rows without a start or end
    are passed over, but count as places. An empty table gives no rows.
    """

    HARD = (4.0, 30.0)

    @staticmethod
    def analyze(words: AnalyzeArgument, keys: AnalyzeArgument | None = None, least: AnalyzeArgument | None = None, most: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not words.isTable:
            raise ValueError("clips_of takes a table: clips_of(TABLE(words) PARTITION BY lecture ORDER BY start)")
        have = {f.name: f.dataType for f in words.dataType.fields}
        named = ClipsOf.listed(keys.value if keys else "lecture")
        if lacking := [c for c in (*named, "start", "end", "stops") if c not in have]:
            raise ValueError(f"clips_of needs the columns {', '.join(lacking)}")
        schema = StructType()
        for k in named:
            schema = schema.add(k, have[k])
        return AnalyzeResult(schema.add("first", IntegerType()).add("last", IntegerType()).add("start", DoubleType()).add("end", DoubleType()))

    @staticmethod
    def listed(keys: str) -> list[str]:
        return [k.strip() for k in keys.split(",") if k.strip()]

    def __init__(self) -> None:
        self.place, self.first, self.start, self.end, self.key = -1, None, None, None, ()

    def eval(self, words: Row, keys: str = "lecture", least: float = 9.0, most: float = 20.0) -> Iterator[tuple]:
        self.place += 1
        start, end = words["start"], words["end"]
        self.key = tuple(words[k] for k in self.listed(keys))
        if start is None or end is None:
            return
        if self.first is None:
            self.first, self.start = self.place, start
        self.end, self.last = end, self.place
        if end - self.start >= most or (words["stops"] and end - self.start >= least):
            yield from self._closed()

    def terminate(self) -> Iterator[tuple]:
        if self.first is not None:
            yield from self._closed()

    def _closed(self) -> Iterator[tuple]:
        if self.HARD[0] <= self.end - self.start <= self.HARD[1]:
            yield (*self.key, self.first, self.last, self.start, self.end)
        self.first = None


def register(spark: SparkSession) -> None:
    spark.udtf.register("clips_of", udtf(ClipsOf))
