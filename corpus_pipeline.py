"""The corpus pipeline: what a training corpus of ``documents`` goes through, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwise.llm import decontaminate, jaccard, mixing, pii, toxicity
from clipwise.llm.common import materialize, scratch, table


def _without(docs: DataFrame, ids: DataFrame, key: str = "doc_id", rows: int = 500_000) -> DataFrame:
    """Rows whose id isn't in ``ids``, which are broadcast only if they are few (8 bytes each)."""
    return docs.join(F.broadcast(ids) if ids.count() <= rows else ids, key, "left_anti")


def _all(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _packed(docs: DataFrame, *own: str) -> DataFrame:
    """``own`` columns and, as one struct, all others, so that none of these can clash with an operator's."""
    return docs.select(*own, F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in own]).alias("_rest"))


def _unpacked(columns: list[str], *own: str) -> list[Column]:
    return [F.col(c) if c in own else F.col("_rest").getField(c).alias(c) for c in columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.7) -> DataFrame:
    """Documents that the toxicity grammar scores below the threshold.

    Empty and null texts, which no clause of the grammar matches, stay, with whatever id; repeated rows are judged alike, very
    long texts whole. Columns of ``docs`` come out as they went in, one named ``score`` too. Empty tables give no rows;
    without labels the grammar's seed words judge.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs.where(~toxicity.held_out()).select("doc_id", "text"), labels)
    return toxicity.score(_packed(docs, "text"), model).where(F.col("score") < threshold).select(*_unpacked(docs.columns, "text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that shares 80 % of its five-word shingles.

    Empty and null texts and null ids are in no group and stay. Different texts under one id are documents of their own (in
    the graph each goes by a 64-bit hash of id and text); of rows that repeat id and text one stays, that with the smallest hash of
    its other columns. Very long texts are compared whole, an empty table gives no rows, and all columns stay as they are.
    """
    repeated = materialize(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        grouped = jaccard.components(docs.select("doc_id", "text"))
        return _without(docs, grouped.where("component_id <> doc_id").select("doc_id").distinct()).select(*_all(docs))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(F.lit(True).alias("_"), *others)
    few = F.broadcast(repeated) if repeated.count() <= 500_000 else repeated
    again = docs.join(few, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min_by(rest, F.xxhash64(*others) if others else F.lit(1)).alias("_rest"))
    once = _without(docs, repeated).select("doc_id", "text", rest.alias("_rest"), F.col("doc_id").cast("long").alias("_node"))
    rows = materialize(once.unionByName(again.withColumn("_node", F.xxhash64("doc_id", "text"))), "near-duplicate-rows")
    grouped = jaccard.components(rows.select(F.col("_node").alias("doc_id"), "text")).where("doc_id is not null")
    grouped = grouped.select(F.col("doc_id").alias("_node"), "component_id").distinct()
    named = materialize(grouped.join(rows.where("_node is not null").select("_node", "doc_id"), "_node"), "near-duplicate-groups")
    best = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "_node")).alias("_best"), F.count("*").alias("_n")).where("_n > 1")
    gone = named.join(best, "component_id").where("_node <> _best._node").select("_node")
    return _without(rows, materialize(gone, "near-duplicates"), "_node").select(*_unpacked(docs.columns, "doc_id", "text"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words, or the whole of a shorter item, of the benchmark.

    Null and empty texts have no words and stay, null ids count as any, repeated rows stay or go together, very long texts are
    searched whole. An empty benchmark drops nothing. All columns stay as they are, also those named like the operator's.
    """
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    own = ("doc_id", "text")
    found = decontaminate.find(_packed(docs, *own), items, write_words=False)
    return found.where(~F.col("contaminated")).select(*_unpacked(docs.columns, *own))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind in brackets and ``n_chars`` counted anew.

    Null texts stay null (as does their count) and empty ones empty; repeated rows change alike, very long texts are read
    whole; other columns stay as they are, and an empty table gives no rows.
    """
    redacted = pii.redact(_packed(docs, "text")).withColumn("n_chars", F.length("text").cast("long"))
    return redacted.select(*_unpacked(docs.columns, "text", "n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes of a document, with its size, its source's size and target and the copy's number.

    Null texts have size 0, null sources are one source, repeated rows are picked one by one. The mix's columns are size,
    source_size, target, copies and copy; one that ``docs`` has already keeps the documents' values, and the mix's is
    named mix_ and its name. An empty table gives no rows.
    """
    own = ("doc_id", "text", "source")
    mixed = mixing.emit(mixing.mix(_packed(docs, *own)))
    added = [F.col(c).alias(f"mix_{c}" if c in docs.columns else c) for c in ("size", "source_size", "target", "copies", "copy")]
    return mixed.select(*_unpacked(docs.columns, *own), *added)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("source_mix", mix_sources),
]

#: Neither the grammar's learned weights nor the CRF can be put in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(path := scratch(spark, f"stage-{name}"))
        docs = spark.read.parquet(path)
    return docs
