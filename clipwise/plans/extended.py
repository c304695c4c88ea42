"""Queries over sentences, table functions, set-aside groups, factors and resumable jobs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwise.functions import clips
from clipwise.functions.numbers import rounded
from clipwise.operators import factors, quarantine, selection, sentences
from clipwise.streaming.resumable import resume
from clipwise.streaming.windows import EVENTS

from . import timelines  # noqa: F401  its SQL is used here
from .base import ORACLE_SQL, query, scratch, table, turns


@query("clips_by_sql", ORACLE_SQL["greedy_clips"])
def clips_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy clips by the table function, called from SQL."""
    clips.register(spark)
    words = turns(spark, sf_dir).withColumn("stops", F.col("id") % 3 == 0)
    sql = "SELECT lecture, first, last, round(`end` - start, 6) AS dur FROM clips_of(TABLE({words}) PARTITION BY lecture ORDER BY (start, `end`, id))"
    return spark.sql(sql, words=words)


_WORDS = r"regexp_extract_all(lower(regexp_replace({}, '\[[^\]]*\]', ' ', 'g')), '[\p{{L}}\p{{M}}][\p{{L}}\p{{M}}''’-]*')"


@query(
    "sentence_kinds",
    rf"""WITH s AS (SELECT doc_id, unnest(range(len(p))) AS nr, unnest(p) AS sentence FROM (SELECT doc_id, string_split_regex(text, '[.?!][\x09-\x0D\x20]+') AS p FROM documents)),
lex AS (SELECT w FROM (SELECT DISTINCT doc_id, unnest({_WORDS.format("text")}) AS w FROM documents WHERE lang = 'en') GROUP BY w HAVING count(*) >= 5),
t AS (SELECT doc_id, nr, unnest(range(len(ws))) AS place, unnest(ws) AS w FROM (SELECT doc_id, nr, {_WORDS.format("sentence")} AS ws FROM s)),
m AS (SELECT *, w NOT IN (SELECT w FROM lex) AS away FROM t),
g AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id, nr, away ORDER BY place) AS k FROM m),
i AS (SELECT doc_id, nr, away, k, count(*) AS run FROM g GROUP BY ALL),
e AS (SELECT doc_id, nr, sum(run) AS n, coalesce(sum(run) FILTER (WHERE away), 0) AS outside, coalesce(max(run) FILTER (WHERE away), 0) AS r FROM i GROUP BY ALL),
j AS (SELECT s.doc_id, s.nr, regexp_matches(sentence, '\[(\p{{Lu}}[^\]]*|verse)\]') AS cited, coalesce(outside / n, 0.0) AS f, coalesce(r, 0) AS r FROM s LEFT JOIN e USING (doc_id, nr)),
k AS (SELECT *, CASE WHEN f >= 0.5 THEN 'frac>=0.5' WHEN r >= 4 AND cited THEN 'verse(run>=4+cited)' WHEN r >= 7 THEN 'run>=7' ELSE '' END AS reason FROM j)
SELECT doc_id, CAST(nr AS INTEGER) AS nr, round(f, 6) AS f, CAST(r AS BIGINT) AS r, CASE WHEN reason = '' THEN 'KEEP' ELSE 'DROP' END AS kind, reason FROM k""",
)
def sentence_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retired classifier over every sentence; the lexicon is what five English documents use."""
    docs = table(spark, sf_dir, "documents")
    words = F.regexp_extract_all(F.lower(F.regexp_replace("text", sentences.NOTE, " ")), F.lit(sentences.WORD), F.lit(0))
    unique = docs.groupBy("doc_id").count().where("count > 1").isEmpty()
    # Of rows with an id of their own each counts a word once, so words are counted before they are shuffled.
    used = docs.where("lang = 'en'").select("doc_id", F.explode(F.array_distinct(words)).alias("word"))
    lexicon = (used if unique else used.distinct()).groupBy("word").count().where("count >= 5")
    found = sentences.foreign_runs(sentences.split_sentences(docs), lexicon, keys=("doc_id", "nr"), unique=unique)
    sides = F.col("f"), F.col("r"), F.col("cited")
    return found.select("doc_id", "nr", rounded("f", 6).alias("f"), "r", sentences.kind(*sides).alias("kind"), sentences.reason(*sides).alias("reason"))


def _talk(lecture: pd.DataFrame) -> pd.DataFrame:
    """Hours of talk of a lecture; a turn under 2 ms breaks it."""
    long = lecture["end"] - lecture["start"]
    if len(short := lecture[long < 0.0002]):
        raise ValueError(f"turn {short['id'].min()} has no length")
    return pd.DataFrame({"n": [len(lecture)], "talk": [round(float(long.sum()), 6)]})


@query(
    "lecture_failures",
    """WITH t AS (SELECT user_id AS lecture, event_id AS id, CAST(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS DOUBLE) / 3600000000.0 AS s, value / 5.0 AS d FROM events),
l AS (SELECT lecture, count(*) AS n, sum((s + d) - s) AS talk, min(id) FILTER (WHERE (s + d) - s < 0.0002) AS bad FROM t GROUP BY 1)
SELECT lecture, CASE WHEN bad IS NULL THEN n END AS n, CASE WHEN bad IS NULL THEN round(talk, 4) END AS talk, 'error:turn ' || bad || ' has no length' AS reason FROM l""",
)
def lecture_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each lecture's talk, or why it was set aside."""
    done = quarantine.isolated(turns(spark, sf_dir), ["lecture"], _talk, "n bigint, talk double")
    out = selection.union_all(done.results, done.flagged.select("lecture", "reason"))
    return out.select("lecture", "n", rounded("talk", 4).alias("talk"), "reason")


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' mean discounts of parts, in percent."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).agg((F.avg("l_discount") * 100).alias("rating"))


@query("factor_errors")
def factor_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors over a tenth of the cells, which the fit doesn't see: customers by parts, and vectors by their components."""
    cells = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("user"), F.posexplode("embedding").alias("item", "rating")).withColumn("rating", F.col("rating").cast("double") * 10)
    out = []
    for name, ratings, ridge in (("parts", _ratings(spark, sf_dir), 1.0), ("vectors", cells, 0.05)):
        held = F.pmod(F.xxhash64("user", "item"), F.lit(10)) == 0
        model = factors.fit(ratings.where(~held), ridge=ridge)
        out.append(factors.errors(ratings.where(held), model).select(F.lit(name).alias("table"), "n", rounded("bias_rmse", 3).alias("bias_rmse"), rounded("factor_rmse", 3).alias("factor_rmse")))
    return selection.union_all(*out)


_BIAS = """WITH r AS (SELECT o_custkey, l_partkey, avg(l_discount) * 100 AS rating FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
b AS (SELECT l_partkey AS item, round(sum(rating - (SELECT avg(rating) FROM r)) / (count(*) + 5.0), 6) AS bias FROM r GROUP BY 1)"""


@query("part_biases", f"{_BIAS} (SELECT 'top' AS side, item, bias FROM b ORDER BY bias DESC, item LIMIT 5) UNION ALL (SELECT 'bottom', item, bias FROM b ORDER BY bias, item LIMIT 5)")
def part_biases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts with the five highest and lowest biases of the fitted model."""
    items = factors.fit(_ratings(spark, sf_dir), rank=2, rounds=2).items.select("item", rounded("bi", 6).alias("bias"))
    side = lambda name, *order: selection.top(items, 5, *order).select(F.lit(name).alias("side"), "item", "bias")
    return selection.union_all(side("top", F.desc("bias"), "item"), side("bottom", "bias", "item"))


@query("resumed_jobs", "SELECT DISTINCT user_id, event_type, md5(user_id || ':' || event_type) AS result FROM events")
def resumed_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair of user and event type is a job, done once by a stream that is run twice."""
    root = scratch(spark, "jobs")
    work = lambda jobs: jobs.select("user_id", "event_type", F.md5(F.concat_ws(":", "user_id", "event_type")).alias("result"))
    for _ in range(2):
        stream = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir).select("user_id", "event_type")
        out = resume(spark, stream, f"{root}/out", f"{root}/state", ["user_id", "event_type"], work, "user_id bigint, event_type string, result string")
    return out.drop("batch")
