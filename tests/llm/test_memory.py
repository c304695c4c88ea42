"""What tasks hold: parts of a batch or tile at a time, and nothing once they end."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql.types import StringType, StructField, StructType

from clipwise.llm import common, jaccard, pii, toxicity


class Rows:
    """Stands for a DataFrame of texts; what would run in a task comes out as it is."""

    schema = StructType([StructField("text", StringType())])

    def drop(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_texts_go_back_in_parts_and_memory_at_the_end(monkeypatch):
    ends = []
    monkeypatch.setattr(common, "give_back", lambda: ends.append(1))
    texts = [f"du idiot {i}" if i % 3 else f"mail a{i}@b.org" for i in range(1000)]
    batch = pa.record_batch([pa.array(texts)], ["text"])
    for run in (toxicity.score(Rows(), toxicity.Model({"idiot": 3.0})), pii.redact(Rows())):
        out = [*run(iter([batch]))]
        assert max(b.num_rows for b in out) <= 256 and sum(b.num_rows for b in out) == 1000
        assert ends.pop() and not ends


def test_bitmaps_are_packed_in_parts():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, n, np.uint64) for n in (0, 1, 20_000, *rng.integers(1, 50, 500))]
    tracemalloc.start()
    got = jaccard.bitmaps(sets, 1 << 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < got.nbytes + (16 << 20)  # a byte for each bit were 33 MB
    for s, row in zip(sets, got, strict=True):
        assert set(np.flatnonzero(np.unpackbits(row.view(np.uint8)))) == {int(x) & 0xFFFF for x in s}
