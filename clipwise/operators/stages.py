"""Model stages as pluggable transforms: diarisation, speaker vectors, alignment and recognition.

A model is a function of a pandas batch; the stage fixes the table that it reads and writes, so the engine takes a model's
output and a precomputed table alike. ``make`` runs once in each task, where it may load weights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: What each stage returns for rows of clips or lectures.
CONTRACTS = {
    "turns": "lecture string, id bigint, speaker string, start double, end double",
    "vectors": "lecture string, id bigint, vector array<double>",
    "words": "lecture string, id bigint, word string, start double, end double, score double",
    "texts": "clip bigint, hypothesis string",
}

Model = Callable[[pd.DataFrame], pd.DataFrame]


def run_stage(rows: DataFrame, kind: str, make: Callable[[], Model]) -> DataFrame:
    """The stage's table of all rows. A batch that lacks a column of the contract raises."""
    schema = CONTRACTS[kind]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for batch in batches:
            yield model(batch)[names]

    return rows.mapInPandas(run, schema)


def resumed(rows: DataFrame, done: DataFrame, key: str, kind: str, make: Callable[[], Model]) -> DataFrame:
    """``done`` and the stage's output for the rows that it lacks; what is done is not computed again."""
    return done.unionByName(run_stage(rows.join(done.select(key).distinct(), key, "left_anti"), kind, make))
