"""Queries over events as speaker turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipwise.functions.numbers import rounded
from clipwise.operators import experiments, sampling, timeline

from .base import TURNS_SQL, query, table, turns

TARGET = "view"

_OWN = f"""own AS (SELECT *, lag("end") OVER (PARTITION BY lecture ORDER BY "start", "end", id) AS g0 FROM turns WHERE speaker = '{TARGET}')"""
_VETO = """AND NOT EXISTS (SELECT 1 FROM turns o WHERE o.lecture = own.lecture AND o.speaker <> 'view' AND o."start" < own."start" AND o."end" > own.g0)"""


def _merged_sql(veto: bool, gap: float = 6.0) -> str:
    return f"""{TURNS_SQL}, {_OWN},
flag AS (SELECT *, CASE WHEN g0 IS NOT NULL AND "start" - g0 <= {gap} {_VETO if veto else ''} THEN 0 ELSE 1 END AS br FROM own),
grp AS (SELECT *, sum(br) OVER (PARTITION BY lecture ORDER BY "start", "end", id ROWS UNBOUNDED PRECEDING) AS iv FROM flag),
iv AS (SELECT lecture, CAST(iv AS BIGINT) AS iv, min("start") AS s, arg_max("end", row("start", "end", id)) AS e FROM grp GROUP BY lecture, iv)"""


def _merged(spark: SparkSession, sf_dir: str, veto: bool, gap: float = 6.0) -> DataFrame:
    return timeline.merge_gaps(turns(spark, sf_dir), TARGET, gap, veto=veto)


_IV = "SELECT lecture, iv, round(s, 6) AS s, round(e, 6) AS e FROM iv"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("lecture", "iv", rounded("start", 6).alias("s"), rounded("end", 6).alias("e"))


@query("gap_merge", f"WITH {_merged_sql(False)} {_IV}")
def gap_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_merged(spark, sf_dir, False))


@query("gap_merge_veto", f"WITH {_merged_sql(True)} {_IV}")
def gap_merge_veto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_merged(spark, sf_dir, True))


@query(
    "interval_overlap",
    f"""WITH {_merged_sql(True)},
w AS (SELECT * FROM turns WHERE speaker = 'click'),
o AS (SELECT w.lecture, w.id, w."end" - w."start" AS dur, coalesce(sum(CASE WHEN iv.s IS NOT NULL THEN greatest(0.0, least(w."end", iv.e) - greatest(w."start", iv.s)) END), 0.0) AS overlap
      FROM w LEFT JOIN iv ON iv.lecture = w.lecture AND iv.s <= w."end" AND iv.e >= w."start" GROUP BY w.lecture, w.id, w."start", w."end")
SELECT lecture, id, round(overlap, 6) AS overlap, overlap / greatest(0.000001, dur) >= 0.9 AS is_target FROM o""",
)
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = turns(spark, sf_dir).where("speaker = 'click'")
    return timeline.covered(words, _merged(spark, sf_dir, True)).select("lecture", "id", rounded("overlap", 6).alias("overlap"), "is_target")


@query(
    "interval_end_asof",
    f"""WITH {_merged_sql(True)},
p AS (SELECT lecture, id, "end" AS t FROM turns WHERE speaker = 'error')
SELECT p.lecture, p.id, round(coalesce(arg_min(iv.e, iv.s), p.t), 6) AS iv_end
FROM p LEFT JOIN iv ON iv.lecture = p.lecture AND iv.s - 0.001 <= p.t AND p.t <= iv.e + 0.001 GROUP BY p.lecture, p.id, p.t""",
)
def interval_end_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = turns(spark, sf_dir).where("speaker = 'error'").select("lecture", "id", F.col("end").alias("t"))
    return timeline.end_asof(points, _merged(spark, sf_dir, True)).select("lecture", "id", rounded("iv_end", 6).alias("iv_end"))


@query(
    "target_runs",
    f"""WITH {TURNS_SQL}, g AS (SELECT *, sum(CASE WHEN speaker IN ('view', 'click', 'signup') THEN 0 ELSE 1 END) OVER (PARTITION BY lecture ORDER BY "start", id ROWS UNBOUNDED PRECEDING) AS run FROM turns)
SELECT lecture, CAST(run AS BIGINT) AS run, count(*) AS n, round(max("end") - min("start"), 6) AS span FROM g WHERE speaker IN ('view', 'click', 'signup') GROUP BY lecture, run""",
)
def target_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = turns(spark, sf_dir).withColumn("is_target", F.col("speaker").isin("view", "click", "signup"))
    found = timeline.runs(flagged, "is_target", "start", "id")
    return found.groupBy("lecture", "run").agg(F.count("*").alias("n"), rounded(F.max("end") - F.min("start"), 6).alias("span"))


@query(
    "greedy_clips",
    f"""WITH RECURSIVE {TURNS_SQL},
w AS (SELECT lecture, "start" AS s, "end" AS e, id % 3 = 0 AS stops, row_number() OVER (PARTITION BY lecture ORDER BY "start", "end", id) AS rn, count(*) OVER (PARTITION BY lecture) AS n FROM turns),
r AS (
  SELECT lecture, rn, n, CAST(0 AS BIGINT) AS f, s AS s0, e, (e - s >= 20.0 OR (stops AND e - s >= 9.0) OR n = 1) AS flush FROM w WHERE rn = 1
  UNION ALL
  SELECT w.lecture, w.rn, w.n, CASE WHEN r.flush THEN w.rn - 1 ELSE r.f END, CASE WHEN r.flush THEN w.s ELSE r.s0 END, w.e,
         (w.e - CASE WHEN r.flush THEN w.s ELSE r.s0 END >= 20.0 OR (w.stops AND w.e - CASE WHEN r.flush THEN w.s ELSE r.s0 END >= 9.0) OR w.rn = w.n)
  FROM r JOIN w ON w.lecture = r.lecture AND w.rn = r.rn + 1)
SELECT lecture, CAST(f AS INTEGER) AS first, CAST(rn - 1 AS INTEGER) AS last, round(e - s0, 6) AS dur FROM r WHERE flush AND e - s0 BETWEEN 4.0 AND 30.0""",
)
def greedy_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = turns(spark, sf_dir).withColumn("stops", F.col("id") % 3 == 0)
    return timeline.greedy_clips(words).select("lecture", "first", "last", rounded(F.col("end") - F.col("start"), 6).alias("dur"))


@query(
    "pack_segments",
    f"""WITH RECURSIVE {TURNS_SQL},
w AS (SELECT lecture, "start" AS s, "end" AS e, row_number() OVER (PARTITION BY lecture ORDER BY "start", "end", id) AS rn FROM turns),
r AS (
  SELECT lecture, rn, CAST(1 AS BIGINT) AS p, s AS s0, e, CAST(1 AS BIGINT) AS parts FROM w WHERE rn = 1
  UNION ALL
  SELECT w.lecture, w.rn, CASE WHEN w.e - r.s0 <= 15.0 THEN r.p ELSE w.rn END, CASE WHEN w.e - r.s0 <= 15.0 THEN r.s0 ELSE w.s END, w.e,
         CASE WHEN w.e - r.s0 <= 15.0 THEN r.parts + 1 ELSE 1 END
  FROM r JOIN w ON w.lecture = r.lecture AND w.rn = r.rn + 1),
l AS (SELECT lecture, p, s0, arg_max(e, rn) AS e, CAST(max(parts) AS INTEGER) AS parts FROM r GROUP BY lecture, p, s0)
SELECT lecture, round(s0, 6) AS s, round(e, 6) AS e, parts FROM l WHERE e - s0 BETWEEN 3.0 AND 30.0""",
)
def pack_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.pack_segments(turns(spark, sf_dir)).select("lecture", rounded("start", 6).alias("s"), rounded("end", 6).alias("e"), "parts")


@query(
    "pad_clips",
    f"""WITH {TURNS_SQL}, w AS (SELECT *, coalesce(lag("end") OVER o, 0.0) AS p, coalesce(lead("start") OVER o, "end" + 1) AS nx FROM turns WINDOW o AS (PARTITION BY lecture ORDER BY "start", id))
SELECT lecture, id, round(greatest("start" - 0.15, p, 0.0), 6) AS cut_start, round("end" + least(0.15, greatest(0.0, nx - "end")), 6) AS cut_end FROM w""",
)
def pad_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.pad(turns(spark, sf_dir)).select("lecture", "id", rounded("cut_start", 6).alias("cut_start"), rounded("cut_end", 6).alias("cut_end"))


@query(
    "talk_time",
    f"""WITH {TURNS_SQL}, t AS (SELECT lecture, speaker, sum("end" - "start") AS talk, count(*) AS n FROM turns GROUP BY lecture, speaker)
SELECT lecture, arg_max(speaker, row(talk, speaker)) AS top_speaker, round(max(talk), 6) AS top_talk, CAST(sum(n) AS BIGINT) AS turns FROM t GROUP BY lecture""",
)
def talk_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = turns(spark, sf_dir).groupBy("lecture", "speaker").agg(F.sum(F.col("end") - F.col("start")).alias("talk"), F.count("*").alias("n"))
    return each.groupBy("lecture").agg(F.max_by("speaker", F.struct("talk", "speaker")).alias("top_speaker"), rounded(F.max("talk"), 6).alias("top_talk"), F.sum("n").alias("turns"))


@query(
    "duration_summary",
    f"""WITH {TURNS_SQL} SELECT speaker, count(*) AS n, round(sum("end" - "start") / 60.0, 6) AS total, round(min("end" - "start"), 6) AS least, round(avg("end" - "start"), 6) AS mean, round(max("end" - "start"), 6) AS most,
 count(*) FILTER (WHERE "end" - "start" BETWEEN 4.0 AND 30.0) AS within FROM turns GROUP BY speaker""",
)
def duration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("end") - F.col("start")
    return turns(spark, sf_dir).groupBy("speaker").agg(
        F.count("*").alias("n"), rounded(F.sum(d) / 60, 6).alias("total"), rounded(F.min(d), 6).alias("least"), rounded(F.avg(d), 6).alias("mean"), rounded(F.max(d), 6).alias("most"), F.count_if(d.between(4, 30)).alias("within")
    )


_SIGNAL = "s AS (SELECT user_id AS lecture, event_id AS frame, CASE WHEN event_type = 'error' THEN NULL ELSE 80 + value END AS f0, value AS f1 FROM events)"


def _signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("lecture"), F.col("event_id").alias("frame"), F.when(F.col("event_type") != "error", 80 + F.col("value")).alias("f0"), F.col("value").alias("f1")
    )


@query(
    "smooth_median3",
    f"""WITH {_SIGNAL}, w AS (SELECT *, lag(1) OVER o IS NULL OR lead(1) OVER o IS NULL AS edge, median(f0) OVER (PARTITION BY lecture ORDER BY frame ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM s WINDOW o AS (PARTITION BY lecture ORDER BY frame))
SELECT lecture, frame, round(CASE WHEN edge THEN f0 ELSE m END, 6) AS f0 FROM w""",
)
def smooth_median3(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _signal(spark, sf_dir)
    return s.select("lecture", "frame", rounded(timeline.median3(s, "f0", "frame"), 6).alias("f0"))


@query(
    "octave_fix",
    f"""WITH {_SIGNAL}, m AS (SELECT *, median(f0) OVER (PARTITION BY lecture) AS mid, count(f0) OVER (PARTITION BY lecture) AS n FROM s)
SELECT lecture, frame, round(CASE WHEN n >= 5 THEN f0 / pow(2.0, greatest(0, least(ceil(log2(f0 / (mid * 1.6))), floor(log2(f0 / 75.0))))) ELSE f0 END, 6) AS f0 FROM m WHERE f0 IS NOT NULL""",
)
def octave_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mids = _signal(spark, sf_dir).groupBy("lecture").agg(F.median("f0").alias("mid"), F.count("f0").alias("n"))
    s = _signal(spark, sf_dir).where("f0 is not null").join(mids, "lecture")
    fixed = F.when(F.col("n") >= 5, timeline.octave_fix(F.col("f0"), F.col("mid"))).otherwise(F.col("f0"))
    return s.select("lecture", "frame", rounded(fixed, 6).alias("f0"))


_STABLE = f"""{_SIGNAL},
st AS (SELECT *, row_number() OVER (PARTITION BY lecture ORDER BY frame) AS rn, coalesce(count(f0) OVER o >= 5 AND stddev_pop(f0) OVER o < 45, FALSE) AS stable FROM s
       WINDOW o AS (PARTITION BY lecture ORDER BY frame ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
rr AS (SELECT *, sum(CASE WHEN stable THEN 0 ELSE 1 END) OVER (PARTITION BY lecture ORDER BY frame ROWS UNBOUNDED PRECEDING) AS run FROM st),
runs AS (SELECT lecture, CAST(run AS BIGINT) AS run, count(*) AS length, min(rn) AS t0, max(rn) AS t1, median(f1) AS f1 FROM rr WHERE stable GROUP BY lecture, run HAVING count(*) >= 3)"""


def _stable_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("lecture").orderBy("frame")
    around = order.rowsBetween(-3, 3)
    stable = F.coalesce((F.count("f0").over(around) >= 5) & (F.stddev_pop("f0").over(around) < 45), F.lit(False))
    s = _signal(spark, sf_dir).withColumn("rn", F.row_number().over(order)).withColumn("stable", stable)
    found = timeline.runs(s, "stable", "frame").groupBy("lecture", "run")
    return found.agg(F.count("*").alias("length"), F.min("rn").alias("t0"), F.max("rn").alias("t1"), F.median("f1").alias("f1")).where("length >= 3")


@query("stable_runs", f"WITH {_STABLE} SELECT lecture, run, length, CAST(t0 AS INTEGER) AS t0, CAST(t1 AS INTEGER) AS t1, round(f1, 6) AS f1 FROM runs")
def stable_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stable_runs(spark, sf_dir).withColumn("f1", rounded("f1", 6))


@query(
    "spaced_topk",
    f"""WITH RECURSIVE {TURNS_SQL},
o AS (SELECT lecture, id, "start" AS tc, row_number() OVER (PARTITION BY lecture ORDER BY "start" - "end", "start", id) AS rn FROM turns),
r AS (SELECT lecture, rn, [tc] AS picked, [id] AS ids FROM o WHERE rn = 1
  UNION ALL
  SELECT o.lecture, o.rn,
         CASE WHEN len(r.picked) < 6 AND len(list_filter(r.picked, lambda p: abs(o.tc - p) <= 24.0)) = 0 THEN list_append(r.picked, o.tc) ELSE r.picked END,
         CASE WHEN len(r.picked) < 6 AND len(list_filter(r.picked, lambda p: abs(o.tc - p) <= 24.0)) = 0 THEN list_append(r.ids, o.id) ELSE r.ids END
  FROM r JOIN o ON o.lecture = r.lecture AND o.rn = r.rn + 1)
SELECT lecture, unnest(arg_max(ids, rn)) AS id FROM r GROUP BY lecture""",
)
def spaced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(spark, sf_dir).withColumn("length", F.col("end") - F.col("start")).withColumn("tc", F.col("start"))
    return timeline.spaced_topk(rows, 24.0, 6).select("lecture", "id")


@query(
    "histogram_scaled",
    """WITH h AS (SELECT event_type, CAST(least(floor((value - 0) / 10), 18) AS INTEGER) AS bin, count(*) AS n FROM events WHERE value BETWEEN 0 AND 190 GROUP BY 1, 2)
SELECT event_type, bin, n, round(n / CAST(max(n) OVER (PARTITION BY event_type) AS DOUBLE), 6) AS scaled FROM h""",
)
def histogram_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiments.histogram(table(spark, sf_dir, "events"), "value", 0, 10, 19, "event_type").withColumn("scaled", rounded("scaled", 6))


@query(
    "envelope",
    """WITH e AS (SELECT user_id AS lecture, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS l FROM events),
b AS (SELECT lecture, CAST(i * 20 // l AS BIGINT) AS bucket, max(value) AS top FROM e GROUP BY 1, 2)
SELECT lecture, bucket, round(top / max(top) OVER (PARTITION BY lecture), 6) AS level FROM b""",
)
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id")
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("lecture"), "value", (F.row_number().over(w.orderBy("event_id")) - 1).alias("i"), F.count("*").over(w).alias("l"))
    b = e.groupBy("lecture", F.floor(F.col("i") * 20 / F.col("l")).alias("bucket")).agg(F.max("value").alias("top"))
    return b.select("lecture", "bucket", rounded(F.col("top") / F.max("top").over(Window.partitionBy("lecture")), 6).alias("level"))


@query(
    "even_picks",
    """WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, event_id FROM e WHERE list_contains(list_transform(range(0, 5), lambda k: CAST(floor(k * (n - 1) / 4.0) AS BIGINT)), i)""",
)
def even_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.evenly(table(spark, sf_dir, "events").select("user_id", "event_id"), 5, "event_id", keys=("user_id",))


@query(
    "edge_silence",
    """WITH e AS (SELECT user_id AS lecture, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, max(value) OVER (PARTITION BY user_id) AS top, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT lecture, CAST(min(i) AS INTEGER) AS lead, CAST(max(n) - 1 - max(i) AS BIGINT) AS trail FROM e WHERE 20 * log10(value / top) > -12 GROUP BY lecture""",
)
def edge_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id")
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("lecture"), "value", (F.row_number().over(w.orderBy("event_id")) - 1).alias("i"), F.max("value").over(w).alias("top"), F.count("*").over(w).alias("n"))
    loud = e.where(20 * F.log10(F.col("value") / F.col("top")) > -12)
    return loud.groupBy("lecture").agg(F.min("i").alias("lead"), (F.max("n") - 1 - F.max("i")).alias("trail"))


@query(
    "windowed_counts",
    """SELECT date_trunc('day', ts) AS "start", event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""",
)
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling days over the batch; the stream in ``clipwise.streaming`` uses the same transformation."""
    events = table(spark, sf_dir, "events")
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    return events.groupBy(day.alias("start"), "event_type").agg(F.count("*").alias("n"), rounded(F.sum("value"), 4).alias("total"))
