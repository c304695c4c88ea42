"""The retired classifier of sentences, from their texts: how many words are foreign, and how many stand in a row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialize

#: A word with its marks, hyphens and apostrophes; a citation is a bracketed note with a capital or the word "verse".
WORD = r"[\p{L}\p{M}][\p{L}\p{M}'’-]*"
NOTE, CITATION = r"\[[^\]]*\]", r"\[(\p{Lu}[^\]]*|verse)\]"


def split_sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ``nr`` (from 0) and ``sentence``; an end mark before white space ends one. Null texts have none."""
    return docs.select(key, F.posexplode(F.split(F.col(text), r"[.?!][\x09-\x0D\x20]+")).alias("nr", "sentence"))


def foreign_runs(sentences: DataFrame, lexicon: DataFrame, *, keys: tuple[str, ...], text: str = "sentence", broadcast_rows: int = 100_000, unique: bool = False) -> DataFrame:
    """keys (which name a sentence), n words, ``f`` (share outside the lexicon), ``r`` (most of them in a row) and ``cited``.

    Words are compared in lower case with ``lexicon.word``, whose size decides how they meet. Bracketed notes aren't read, but may be
    citations. Runs are islands: foreign words of one sentence with equal difference of place and rank. A sentence without
    words, or a null one, has no share and no run, 0 both. Where keys are ``unique`` and the lexicon is small, each sentence is judged in its
    row, and nothing is shuffled; else sentences of equal keys count as one.
    """
    if unique:
        lexicon = materialize(lexicon.select("word").where("word is not null").distinct(), "lexicon")
        if lexicon.count() <= 10 * broadcast_rows:  # words alone, some 16 MB
            return _runs_in_rows(sentences, lexicon.toArrow()["word"].combine_chunks(), keys, text)
    words = sentences.select(*keys, F.posexplode(F.regexp_extract_all(F.lower(F.regexp_replace(text, NOTE, " ")), F.lit(WORD), F.lit(0))).alias("place", "word"))
    known = lexicon.select("word").distinct().withColumn("known", F.lit(True))
    known = F.broadcast(known) if known.count() <= broadcast_rows else known
    marked = words.join(known, "word", "left").withColumn("foreign", F.col("known").isNull())
    rank = F.row_number().over(Window.partitionBy(*keys, "foreign").orderBy("place"))
    islands = marked.withColumn("island", F.col("place") - rank).groupBy(*keys, "foreign", "island").agg(F.count("*").alias("run"))
    each = islands.groupBy(*keys).agg(
        F.sum("run").alias("n"), F.sum(F.when(F.col("foreign"), F.col("run")).otherwise(0)).alias("outside"), F.max(F.when(F.col("foreign"), F.col("run")).otherwise(0)).alias("r")
    )
    cited = sentences.select(*keys, F.coalesce(F.col(text).rlike(CITATION), F.lit(False)).alias("cited"))
    joined = cited.join(each, list(keys), "left")
    share = F.coalesce(F.try_divide(F.col("outside"), F.col("n")), F.lit(0.0))
    return joined.select(*keys, F.coalesce("n", F.lit(0)).alias("n"), share.alias("f"), F.coalesce("r", F.lit(0)).alias("r"), "cited")


def _runs_in_rows(sentences: DataFrame, lexicon: pa.Array, keys: tuple[str, ...], text: str) -> DataFrame:
    """As above, by a pass over the words of each batch of rows."""
    shared = sentences.sparkSession.sparkContext.broadcast(lexicon)
    words = F.regexp_extract_all(F.lower(F.regexp_replace(text, NOTE, " ")), F.lit(WORD), F.lit(0))
    rows = sentences.select(*keys, F.coalesce(F.col(text).rlike(CITATION), F.lit(False)).alias("cited"), F.coalesce(words, F.array().cast("array<string>")).alias("_words"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("_words")
            n = own.value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(n)
            away = ~pc.is_in(own.flatten(), value_set=known).to_numpy(zero_copy_only=False)
            place = np.arange(len(away))
            # The place before a run: that of the last word of the lexicon, or of the row before.
            before = np.where(away, -1, place)
            starts = (ends - n)[n > 0]
            before[starts] = np.maximum(before[starts], starts - 1)
            run = place - np.maximum.accumulate(before) if len(away) else place
            longest, outside = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            if len(starts):
                longest[n > 0] = np.maximum.reduceat(run, starts)
                outside[n > 0] = np.add.reduceat(away.astype(np.int64), starts)
            f = np.divide(outside, n, out=np.zeros(len(n)), where=n > 0)
            yield pa.record_batch([*(batch.column(k) for k in keys), pa.array(n), pa.array(f), pa.array(longest), batch.column("cited")], [*keys, "n", "f", "r", "cited"])

    kinds = ", ".join(f"`{k}` {kind}" for k, kind in rows.select(*keys).dtypes)
    return rows.mapInArrow(judge, f"{kinds}, n bigint, f double, r bigint, cited boolean")


def reason(share: Column, run: Column, cited: Column) -> Column:
    """Why a sentence is dropped: half of its words foreign, four in a row with a citation, or seven in a row; empty if it stays."""
    return F.when(share >= 0.5, "frac>=0.5").when((run >= 4) & cited, "verse(run>=4+cited)").when(run >= 7, "run>=7").otherwise("")


def kind(share: Column, run: Column, cited: Column) -> Column:
    return F.when(reason(share, run, cited) == "", "KEEP").otherwise("DROP")
