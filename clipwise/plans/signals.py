"""Queries over clips of samples, and the stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwise.functions.numbers import rounded
from clipwise.functions.signal import clip_features, wav_bytes
from clipwise.sources import audio, files
from clipwise.streaming import merging
from clipwise.streaming.windows import EVENTS, as_utc, stream_to_table

from .base import TURNS_SQL, query, scratch, table


@query(
    "clip_loudness",
    "SELECT user_id AS clip, round(sqrt(avg(value * value / 250000.0)), 6) AS rms, round(max(value) / 500.0, 6) AS peak, round(count(*) / 16000.0, 6) AS duration FROM events GROUP BY 1",
)
def clip_loudness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of clips, the values of a user standing for the samples of one."""
    samples = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "value"))), lambda s: s["value"] / 500)
    clips = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("clip")).agg(samples.alias("samples"))
    return clip_features(clips).select("clip", *[rounded(c, 6).alias(c) for c in ("rms", "peak", "duration")])


@query(
    "windowed_counts_stream",
    """SELECT date_trunc('day', ts) AS "start", event_type, count(*) AS n, round(sum(value), 4) AS total FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""",
)
def windowed_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed windows of a stream over the table's files."""
    root = scratch(spark, "stream")
    out = stream_to_table(spark, sf_dir, f"{root}/out", f"{root}/state", names="events.parquet")
    return out.withColumn("total", rounded("total", 4))


@query(
    "gap_merge_stream",
    f"""WITH {TURNS_SQL},
w AS (SELECT (epoch_ms(max(ts)) - 3600000 - epoch_ms(TIMESTAMP '2024-01-01')) / 3600000.0 AS reached FROM events),
t AS (SELECT turns.*, reached FROM turns, w WHERE "start" <= reached),
own AS (SELECT *, lag("end") OVER (PARTITION BY lecture ORDER BY "start", "end", id) AS g0 FROM t WHERE speaker = 'view'),
flag AS (SELECT *, CASE WHEN g0 IS NOT NULL AND "start" - g0 <= 6.0 AND NOT EXISTS (SELECT 1 FROM t o WHERE o.lecture = own.lecture AND o.speaker <> 'view' AND o."start" < own."start" AND o."end" > own.g0) THEN 0 ELSE 1 END AS br FROM own),
grp AS (SELECT *, sum(br) OVER (PARTITION BY lecture ORDER BY "start", "end", id ROWS UNBOUNDED PRECEDING) AS iv FROM flag),
iv AS (SELECT lecture, iv, min("start") AS s, arg_max("end", row("start", "end", id)) AS e, any_value(reached) AS reached, max(iv) OVER (PARTITION BY lecture) AS final FROM grp GROUP BY lecture, iv)
SELECT lecture, CAST(iv AS BIGINT) AS iv, round(s, 6) AS s, round(e, 6) AS e FROM iv WHERE iv < final OR reached - e > 6.0""",
)
def gap_merge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intervals that a stream of turns has closed when its files end, an hour behind the last turn."""
    ts = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)").cast("double") / F.lit(3600000000.0)
    events = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stream = events.select(F.col("user_id").alias("lecture"), F.col("event_id").alias("id"), F.col("event_type").alias("speaker"), ts.alias("start"), (ts + F.col("value") / F.lit(5.0)).alias("end"), as_utc(F.col("ts")).alias("ts"))
    root = scratch(spark, "merging")
    out = merging.merge_to_table(spark, stream, f"{root}/out", f"{root}/state", "view", 6.0, second=1 / 3600, origin=1704067200.0)
    return out.select("lecture", "iv", rounded("start", 6).alias("s"), rounded("end", 6).alias("e"))


def _wavs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WAV file for each user, whose samples are the whole parts of its values by event; 16 bits hold them all."""
    samples = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "value"))), lambda s: ((F.floor(s["value"]) + 0.25) / 32767).cast("float"))
    clips = table(spark, sf_dir, "events").groupBy("user_id").agg(samples.alias("samples"))
    return clips.select("user_id", F.concat(F.col("user_id").cast("string"), F.lit(".wav")).alias("name"), wav_bytes("samples").alias("content"))


@query(
    "clip_ranges",
    """WITH e AS (SELECT user_id, floor(value) AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events)
SELECT user_id || '.wav' AS file, count(*) AS frames, CAST(sum(v) AS BIGINT) AS total, 2 * count(*) AS bytes FROM e WHERE i >= 16 AND i < 48 GROUP BY 1""",
)
def clip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are written, and 2 ms of each read back by seeking: the bytes read are those of 32 frames."""
    files.write_files(_wavs(spark, sf_dir), path := scratch(spark, "wavs"))
    blocks = audio.wav_blocks(spark, path, block_frames=8).where("start >= 0.001 and start < 0.003")
    total = F.aggregate("samples", F.lit(0.0), lambda a, x: a + x.cast("double") * 32768)
    return blocks.groupBy("file").agg(F.sum(F.size("samples")).cast("long").alias("frames"), F.round(F.sum(total)).cast("long").alias("total"), F.sum("bytes").alias("bytes"))


@query(
    "clip_files",
    "SELECT user_id || '.wav' AS name, 44 + 2 * count(*) AS bytes FROM events WHERE user_id % 2 = 0 GROUP BY user_id",
)
def clip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and sizes in a folder that held all users' clips before it got those of the even ones."""
    clips = _wavs(spark, sf_dir)
    path = scratch(spark, "clips")
    files.write_files(clips, path)
    files.write_files(clips.where("user_id % 2 = 0"), path)
    return files.file_names(spark, path).select("name", "bytes")
