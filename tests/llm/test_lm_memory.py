"""What passes to Python at once in the language model."""

from pyspark.sql import functions as F

from clipwise.llm import lm


def test_lm_passes_few_bytes_to_python_at_once(spark, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}
    before, write = spark.conf.get(name), lm.materialize
    monkeypatch.setattr(lm, "materialize", lambda df, to: (seen.update({to: spark.conf.get(name)}), write(df, to))[1])
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a b c"), F.col("id").cast("string")).alias("text"))
    assert lm.score_texts(docs, F.col("doc_id") % 7 == 2).count() == 60
    assert {"block-words", "word-factors", "lm-scores"} <= seen.keys() and set(seen.values()) == {str(lm.BATCH)}
    assert spark.conf.get(name) == before
