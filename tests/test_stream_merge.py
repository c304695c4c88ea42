"""The streaming gap merge against the batch, over random micro-batches with restarts between them."""

import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from clipwise.operators import timeline
from pyspark.sql import functions as F

pytest.importorskip("google.protobuf")
from clipwise.streaming import merging  # noqa: E402

SCHEMA = "lecture long, id long, speaker string, start double, end double"


def stamped(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_micros((F.col("start") * 1e6).cast("long")))


def streamed(spark, root, parts, **options):
    """Each part is a run of the query from its checkpoint, over files of which each is a micro-batch."""
    out = None
    for part in parts:
        for j in range(0, len(part), 80):
            stamped(spark, part[j : j + 80]).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(merging.TURNS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        out = merging.merge_to_table(spark, stream, f"{root}/out", f"{root}/state", "t", 0.25, **options)
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("veto", [True, False])
def test_any_split_gives_the_rows_of_the_batch(spark, tmp_path, veto):
    rnd = random.Random(4 + veto)
    rows = []
    for i in range(300):
        a = round(rnd.uniform(0, 220), 3)
        rows.append((rnd.randint(1, 3), i, rnd.choice(["t", "t", "o", None]), a, a + rnd.choice([0.0, 0.1, 1.0, 5.0, 30.0])))
    rows.append((0, 10**6, "o", 1e6, 1e6))  # moves the watermark past all others
    arrived = sorted(rows, key=lambda r: r[3] + rnd.uniform(0, 40))
    cuts = sorted(rnd.sample(range(1, len(rows)), 2))
    parts = [arrived[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
    got = streamed(spark, tmp_path, parts, delay="41 seconds", veto=veto)
    named = [(a, i, s or "", x, y) for a, i, s, x, y in rows]
    assert got == sorted(map(tuple, timeline.merge_gaps(spark.createDataFrame(named, SCHEMA), "t", 0.25, veto=veto).select("lecture", "iv", "start", "end").collect()))


def test_late_rows_and_odd_rows(spark, tmp_path):
    first = [(1, 0, "t", 10.0, 11.0), (1, 1, "t", 11.2, 12.0), (1, 2, "t", 200.0, 201.0), (None, 3, "t", 1.0, 2.0), (1, 4, "t", 100.0, None)]
    second = [(1, 5, "t", 12.1, 13.0), (1, 6, "t", 201.1, 202.0), (0, 7, "o", 9000.0, 9000.0)]
    assert streamed(spark, tmp_path, [first, second], delay="10 seconds") == [(1, 1, 10.0, 12.0), (1, 2, 200.0, 202.0)]


def test_turns_of_a_batch_are_one_value_of_the_state():
    """A store takes each value by itself: a lecture's turns cost one call and one value, however many they are."""
    kept, timers = [], []
    state = SimpleNamespace(appendValue=kept.append, appendList=kept.extend)
    processor = merging.GapMerge("t", 6.0, True, 1.0, 0.0)
    processor.init(SimpleNamespace(getListState=lambda *_: state, getValueState=lambda *_: state, registerTimer=timers.append))
    rows = pd.DataFrame({"ts": pd.to_datetime(range(100), unit="s"), "id": range(100), "speaker": ["t", "o"] * 50, "start": [float(i) for i in range(100)], "end": [i + 0.5 for i in range(100)]})
    assert list(processor.handleInputRows((1,), iter([rows[:60], rows[60:]]), None)) == []
    assert len(kept) == 1 and timers == [1]
    turns = np.frombuffer(kept[0][0], merging.PACKED)
    assert turns["start"].tolist() == list(range(100)) and turns["own"].tolist() == [True, False] * 50 and turns["micros"].tolist() == [i * 1_000_000 for i in range(100)]
