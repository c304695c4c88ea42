"""Gap merges over a stream of turns: the rows of ``timeline.merge_gaps``, an interval at a time, as event time passes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: What a stream of turns has: ``ts`` is the instant of ``start``, both rise together.
TURNS = "lecture bigint, id bigint, speaker string, start double, end double, ts timestamp"
#: Turns as they are kept in a state: those of a batch are one value, as a store takes each value by itself. ``own`` marks the target's.
PACKED = np.dtype([("micros", "i8"), ("id", "i8"), ("own", "?"), ("start", "f8"), ("end", "f8")])
MERGED = "lecture bigint, iv bigint, start double, end double"
#: Transformations with state and timers need this store.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class GapMerge(StatefulProcessor):
    """State of one lecture: turns that aren't final yet, the open interval, and other speakers' turns that can still veto.

    A turn is final once the watermark has reached it, as later rows start beyond; final turns are taken in order of start, end
    and id, as in the batch. An interval is emitted when a target turn starts a new one, or when the watermark has passed its end
    by more than the gap. Other turns go as soon as they end before whatever gap may come, so the state holds the
    delay's worth of turns and the long ones, not the recording.
    """

    def __init__(self, target: str, gap: float, veto: bool, second: float, origin: float) -> None:
        self.target, self.gap, self.veto, self.second, self.origin = target, gap, veto, second, origin

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "turns binary")
        self.open = handle.getValueState("open", "iv bigint, start double, end double")
        self.others = handle.getValueState("others", "spans binary")
        self.taken = handle.getValueState("taken", "iv bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for batch in rows:
            own = batch["speaker"].to_numpy() == self.target
            columns = batch["ts"].astype("datetime64[us]").astype("int64"), batch["id"], own, batch["start"], batch["end"]
            new.append(np.empty(len(batch), PACKED))
            for to, values in zip(PACKED.names, columns, strict=True):
                new[-1][to] = values
        if new and len(turns := np.concatenate(new)):
            self.waiting.appendValue((turns.tobytes(),))
            self.handle.registerTimer(int(turns["micros"].min()) // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Takes what the watermark has passed, and asks to be called again for what it hasn't."""
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        held = [bytes(r[0]) for r in self.waiting.get()]
        waiting = np.frombuffer(b"".join(held), PACKED)
        final = waiting["micros"] <= reached
        ready, later = waiting[final], waiting[~final]
        ready = ready[np.lexsort((ready["id"], ready["end"], ready["start"]))].tolist()
        if len(ready):
            self.waiting.clear()
            if len(later):
                self.waiting.appendValue((later.tobytes(),))
        closed = self._take(ready, reached)
        wake = [int(later["micros"].min()) // 1000 + 1] if len(later) else []
        if self.open.exists():
            wake.append(int(((self.open.get()[2] + self.gap) / self.second + self.origin) * 1000) + 2)
        if wake:
            self.handle.registerTimer(max(int(min(wake)), timerValues.getCurrentWatermarkInMs() + 1))
        if closed:
            yield pd.DataFrame([(key[0], *c) for c in closed], columns=["lecture", "iv", "start", "end"])

    def _take(self, ready: list[tuple], reached: int) -> list[tuple]:
        open_ = tuple(self.open.get()) if self.open.exists() else None
        count = self.taken.get()[0] if self.taken.exists() else 0
        others = np.frombuffer(bytes(self.others.get()[0])).reshape(-1, 2).tolist() if self.others.exists() else []
        before, closed = list(others), []
        for _, _, own, start, end in ready:
            if not own:
                others.append([start, end])
        for _, _, own, start, end in ready:
            if not own:
                continue
            joins = open_ is not None and start - open_[2] <= self.gap
            if joins and self.veto:
                joins = not any(a < start and b > open_[2] for a, b in others)
            if joins:
                open_ = (open_[0], open_[1], end)
            else:
                if open_ is not None:
                    closed.append(open_)
                count += 1
                open_ = (count, start, end)
        now = (reached / 1e6 - self.origin) * self.second
        if open_ is not None and now - open_[2] > self.gap:
            closed.append(open_)
            open_ = None
        frontier = min(now, open_[2]) if open_ is not None else now
        others = [o for o in others if o[1] > frontier]
        if others != before:
            self.others.clear()
            if others:
                self.others.update((np.array(others).tobytes(),))
        if count:
            self.taken.update((count,))
        if open_ is not None:
            self.open.update(open_)
        else:
            self.open.clear()
        return closed

    def close(self) -> None:
        pass


def merge_gaps(turns: DataFrame, target: str, gap: float, *, veto: bool = True, delay: str = "1 hour", second: float = 1.0, origin: float = 0.0) -> DataFrame:
    """Merged intervals of the target speaker of a stream of ``TURNS``, appended as they close: lecture, iv (from 1), start, end.

    ``second`` is how much of ``start`` a second of ``ts`` is, ``origin`` the epoch second at which ``start`` is 0. Rows may come in any order and be split over any micro-batches:
    as long as none is more than ``delay`` late, the result is that of the batch; later rows are dropped by the
    watermark. Turns end no earlier than they start and ``ts`` isn't null; a null speaker is another one, rows without a start, an
    end or a lecture are left out. The session needs the RocksDB state store (``STORE``).
    """
    known = turns.where("lecture is not null and start is not null and end is not null").select(
        F.col("lecture").cast("long"), F.col("id").cast("long"), F.coalesce("speaker", F.lit("")).alias("speaker"), F.col("start").cast("double"), F.col("end").cast("double"), "ts"
    )
    return known.withWatermark("ts", delay).groupBy("lecture").transformWithStateInPandas(
        statefulProcessor=GapMerge(target, gap, veto, second, origin), outputStructType=MERGED, outputMode="append", timeMode="eventTime"
    )


def merge_to_table(spark: SparkSession, turns: DataFrame, out: str, checkpoint: str, target: str, gap: float, **options) -> DataFrame:
    """Takes what has arrived, appends closed intervals to ``out`` and returns that table; a rerun goes on from the checkpoint."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        query = merge_gaps(turns, target, gap, **options).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return spark.read.schema(MERGED).parquet(out)
