"""Queries over tracks, spectra and turns, exports, and the whole way from turns to a clean manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipwise.functions import text as T
from clipwise.functions import vectors as V
from clipwise.functions.numbers import rounded, rounded_column
from clipwise.operators import experiments, gates, selection, timeline
from clipwise.sources.io import tsv_lines
from clipwise.streaming.windows import sessions, sliding_levels

from .base import TURNS_SQL, hinted, materialize, query, scratch, table, turns
from .reports import _GATED, CLIPS_SQL, clips, report
from .texts import LEXICON, _sql_cer
from .timelines import _SIGNAL, TARGET, _merged, _merged_sql, _signal

_ALL = f"""{_merged_sql(True)},
o AS (SELECT w.*, coalesce(sum(CASE WHEN iv.s IS NOT NULL THEN greatest(0.0, least(w."end", iv.e) - greatest(w."start", iv.s)) END), 0.0) AS overlap
      FROM turns w LEFT JOIN iv ON iv.lecture = w.lecture AND iv.s <= w."end" AND iv.e >= w."start" GROUP BY ALL),
fl AS (SELECT *, overlap / greatest(0.000001, "end" - "start") >= 0.9 AS is_target, CAST(-(id * 7 % 60) AS DOUBLE) AS score FROM o)"""

_LIFE = f"""{_ALL},
ru AS (SELECT *, CAST(sum(CASE WHEN is_target THEN 0 ELSE 1 END) OVER (PARTITION BY lecture ORDER BY "start", "end", id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM fl),
w AS (SELECT lecture, run, id, speaker, "start" AS s, "end" AS e, score, id % 3 = 0 AS stops, row_number() OVER k AS rn, count(*) OVER (PARTITION BY lecture, run) AS n, lag("end") OVER k AS pe, lead("start") OVER k AS ns
      FROM ru WHERE is_target WINDOW k AS (PARTITION BY lecture, run ORDER BY "start", "end", id)),
r AS (
  SELECT lecture, run, rn, n, CAST(0 AS BIGINT) AS f, s AS s0, e, (e - s >= 20.0 OR (stops AND e - s >= 9.0) OR n = 1) AS flush FROM w WHERE rn = 1
  UNION ALL
  SELECT w.lecture, w.run, w.rn, w.n, CASE WHEN r.flush THEN w.rn - 1 ELSE r.f END, CASE WHEN r.flush THEN w.s ELSE r.s0 END, w.e,
         (w.e - CASE WHEN r.flush THEN w.s ELSE r.s0 END >= 20.0 OR (w.stops AND w.e - CASE WHEN r.flush THEN w.s ELSE r.s0 END >= 9.0) OR w.rn = w.n)
  FROM r JOIN w ON w.lecture = r.lecture AND w.run = r.run AND w.rn = r.rn + 1),
c AS (SELECT lecture, run, f, rn - 1 AS l, s0, e FROM r WHERE flush AND e - s0 BETWEEN 4.0 AND 30.0),
x AS (SELECT c.*, a.pe, b.ns, (SELECT min(score) FROM w WHERE w.lecture = c.lecture AND w.run = c.run AND w.rn BETWEEN c.f + 1 AND c.l + 1) AS align_min,
        coalesce((SELECT arg_min(iv.e, iv.s) FROM iv WHERE iv.lecture = c.lecture AND iv.s - 0.001 <= c.e AND c.e <= iv.e + 0.001), c.e) AS iv_end
      FROM c JOIN w a ON a.lecture = c.lecture AND a.run = c.run AND a.rn = c.f + 1 JOIN w b ON b.lecture = c.lecture AND b.run = c.run AND b.rn = c.l + 1),
cut AS (SELECT *, greatest(s0 - 0.15, coalesce(pe, greatest(0.0, s0 - 1)), 0.0) AS cs, least(e + least(0.15, greatest(0.0, coalesce(ns, e + 1) - e)), iv_end) AS ce FROM x),
nu AS (SELECT *, row_number() OVER (PARTITION BY lecture ORDER BY run, f) AS k FROM cut)"""


def _steps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every turn as a word, with its run of target words, and the cut clips; both written, as several steps read them."""
    iv = materialize(_merged(spark, sf_dir, True), "intervals")
    words = timeline.covered(turns(spark, sf_dir), iv)
    words = words.withColumn("score", (-(F.col("id") * 7 % 60)).cast("double")).withColumn("stops", F.col("id") % 3 == 0)
    words = materialize(timeline.runs(words, "is_target", "start", "end", "id"), "words")
    found = timeline.greedy_clips(words, keys=("lecture", "run"))
    return words, materialize(timeline.pad_runs(words, found, iv), "cut")


@query("run_pads", f"WITH RECURSIVE {_LIFE} SELECT lecture, run, CAST(f AS INTEGER) AS first, round(cs, 6) AS cut_start, round(ce, 6) AS cut_end FROM cut")
def run_pads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steps(spark, sf_dir)[1].select("lecture", "run", "first", rounded("cut_start", 6).alias("cut_start"), rounded("cut_end", 6).alias("cut_end"))


#: The production gate's bounds for these turns, whose pads are at most 0.15.
_BOUNDS = {"min_align": -50.0, "max_lead": 0.14, "max_trail": 0.14, "max_cer_core": 0.25}
_SPOKEN = ["view", "click", "purchase", "error"]
_CORE = "array_to_string(list_filter(regexp_extract_all({}, '[a-z'']+'), lambda x: x IN (" + ", ".join(f"'{w}'" for w in _SPOKEN) + ")), ' ')"


@query(
    "lecture_lifecycle",
    f"""WITH RECURSIVE {_LIFE},
tx AS (SELECT n.lecture, n.run, n.f, string_agg(w.speaker, ' ' ORDER BY w.rn) AS ref, coalesce(string_agg(w.speaker, ' ' ORDER BY w.rn) FILTER (w.id % 5 <> 0), '') AS hyp FROM nu n JOIN w ON w.lecture = n.lecture AND w.run = n.run AND w.rn BETWEEN n.f + 1 AND n.l + 1 GROUP BY ALL),
co AS (SELECT *, {_CORE.format("ref")} AS rc, {_CORE.format("hyp")} AS hc FROM tx),
ce AS (SELECT lecture, run, f, CASE WHEN hyp = '' THEN 1.0 WHEN rc = '' THEN NULL ELSE {_sql_cer("rc", "hc")} END AS core FROM co),
g AS (SELECT nu.*, core, CASE WHEN lecture % 17 = 0 THEN 'missing_wav' ELSE array_to_string(list_filter([CASE WHEN align_min < -50.0 THEN printf('low_align(%.2f)', align_min) END, CASE WHEN s0 - cs > 0.14 THEN printf('lead_sil(%.2f)', s0 - cs) END,
  CASE WHEN ce.ce > 0.14 THEN printf('trail_sil(%.2f)', ce.ce) END, CASE WHEN core > 0.25 THEN printf('high_cer_core(%.2f)', core) END, CASE WHEN core IS NULL THEN 'no_backbone' END], lambda x: x IS NOT NULL), ';') END AS reasons
  FROM nu JOIN (SELECT c.lecture AS cl, c.run AS cr, c.f AS cf, c.core, n.ce - n.e AS ce FROM ce c JOIN nu n ON n.lecture = c.lecture AND n.run = c.run AND n.f = c.f) ce ON nu.lecture = cl AND nu.run = cr AND nu.f = cf)
SELECT lecture || '_' || printf('%04d', k) AS clip, round(ce - cs, 2) AS dur, align_min, round(core, 6) AS cer_core, reasons, reasons = '' AS clean FROM g""",
)
def lecture_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From turns to a gated report: target intervals, words inside them, runs, greedy clips, pads, numbers, texts and the production gate.

    A word is its speaker's name, and the recogniser misses every fifth one; a seventeenth of the lectures has no audio.
    """
    keys = ["lecture", "run"]
    words, cut = _steps(spark, sf_dir)
    words = selection.placed(words.select(*keys, "id", "speaker", "start", "end"), "start", "end", "id", keys=tuple(keys))
    said = words.join(cut.select(*keys, "first", "last"), keys).where((F.col("place") - 1).between(F.col("first"), F.col("last")))
    rows = said.groupBy(*keys, "first").agg(F.array_sort(F.collect_list(F.struct("place", "id", "speaker"))).alias("ws"))
    text = lambda ws: F.array_join(F.transform(ws, lambda w: w["speaker"]), " ")
    heard = F.filter("ws", lambda w: w["id"] % 5 != 0)
    rates = rows.select(*keys, "first", T.error_rates(text(F.col("ws")), text(heard), _SPOKEN)["cer_core"].alias("cer_core"))
    measured = cut.join(rates, [*keys, "first"]).withColumn("lead", F.col("start") - F.col("cut_start")).withColumn("trail", F.col("cut_end") - F.col("end")).withColumn("has_wav", F.col("lecture") % 17 != 0)
    named = selection.numbered(measured, "run", "first", prefix=F.concat(F.col("lecture").cast("string"), F.lit("_")), keys=("lecture",))
    why = gates.production_reasons(_BOUNDS, backbone=True)
    return named.select(
        F.col("id").alias("clip"), rounded(F.col("cut_end") - F.col("cut_start"), 2).alias("dur"), "align_min", rounded("cer_core", 6).alias("cer_core"), F.array_join(why, ";").alias("reasons"), (F.size(why) == 0).alias("clean")
    )


@query("word_drop", f"WITH {_ALL} SELECT lecture, round(1 - count(*) FILTER (WHERE is_target) / CAST(greatest(1, count(*)) AS DOUBLE), 6) AS dropped, 1 - count(*) FILTER (WHERE is_target) / CAST(greatest(1, count(*)) AS DOUBLE) > 0.6 AS flagged FROM fl GROUP BY lecture")
def word_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = timeline.covered(turns(spark, sf_dir), _merged(spark, sf_dir, True))
    share = 1 - F.count_if("is_target") / F.greatest(F.lit(1), F.count("*")).cast("double")
    return words.groupBy("lecture").agg(rounded(share, 6).alias("dropped"), (share > 0.6).alias("flagged"))


_VOTE = f"""{TURNS_SQL},
t AS (SELECT lecture, speaker, sum("end" - "start") AS talk, avg(CASE WHEN "end" - "start" >= 2.0 THEN (id * 13 % 100) / 100.0 END) AS cos FROM turns GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY lecture ORDER BY cos DESC NULLS LAST, speaker) AS k, row_number() OVER (PARTITION BY lecture ORDER BY talk DESC, speaker) AS tk FROM t),
v AS (SELECT lecture, max(CASE WHEN k = 1 THEN speaker END) AS winner, max(CASE WHEN k = 1 THEN cos END) AS c1, max(CASE WHEN k = 2 THEN cos END) AS c2, max(CASE WHEN tk = 1 THEN speaker END) AS loudest FROM rk GROUP BY lecture)"""


@query(
    "lecture_flags",
    f"""WITH {_VOTE} SELECT lecture, winner, round(c1, 6) AS cos, array_to_string(list_filter([CASE WHEN c1 < 0.5 THEN printf('low_cosine(%.3f)', c1) END, CASE WHEN c1 - c2 < 0.05 THEN printf('low_margin(%.3f)', c1 - c2) END,
 CASE WHEN winner <> loudest THEN 'cosine!=talktime' END], lambda x: x IS NOT NULL), ';') AS flags FROM v WHERE c1 IS NOT NULL""",
)
def lecture_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which speaker is the target by mean similarity of turns of 2 and more (shorter ones count as talk only), and flags."""
    dur = F.col("end") - F.col("start")
    sim = F.when(dur >= 2.0, (F.col("id") * 13 % 100).cast("double") / 100)
    # Sums of doubles depend on their order, and flags on the last digit: turns are added up by id, however they are dealt.
    whole = Window.partitionBy("lecture", "speaker").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = turns(spark, sf_dir).withColumn("sim", sim).select("lecture", "speaker", F.sum(dur).over(whole).alias("talk"), F.try_divide(F.sum("sim").over(whole), F.count("sim").over(whole)).alias("cos"))
    t = t.groupBy("lecture", "speaker").agg(F.first("talk").alias("talk"), F.first("cos").alias("cos"))

    ranked = t.groupBy("lecture").agg(
        F.array_sort(F.collect_list(F.when(F.col("cos").isNotNull(), F.struct((-F.col("cos")).alias("v"), "speaker")))).alias("r"),
        F.min(F.struct((-F.col("talk")).alias("v"), "speaker"))["speaker"].alias("loudest"),
    ).where(F.size("r") > 0)
    c1, c2 = -F.col("r")[0]["v"], -F.get("r", F.lit(1))["v"]
    winner = F.col("r")[0]["speaker"]
    flags = T.reasons((c1 < 0.5, T.with_value("low_cosine", c1, 3)), (c1 - c2 < 0.05, T.with_value("low_margin", c1 - c2, 3)), (winner != F.col("loudest"), F.lit("cosine!=talktime")))
    return ranked.select("lecture", winner.alias("winner"), rounded(c1, 6).alias("cos"), F.array_join(flags, ";").alias("flags"))


@query("long_words", f'WITH {TURNS_SQL} SELECT lecture, count(*) AS n, round(max("end" - "start"), 6) AS longest FROM turns WHERE "end" - "start" > 3.0 GROUP BY lecture')
def long_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    dur = F.col("end") - F.col("start")
    return turns(spark, sf_dir).where(dur > 3.0).groupBy("lecture").agg(F.count("*").alias("n"), rounded(F.max(dur), 6).alias("longest"))


@query("aligned_words", "WITH w AS (SELECT event_id, CASE event_type WHEN 'error' THEN '<star>' WHEN 'signup' THEN ' ' ELSE event_type END AS word FROM events) SELECT event_id, word FROM w WHERE trim(word) NOT IN ('<star>', '')")
def aligned_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.when(F.col("event_type") == "error", "<star>").when(F.col("event_type") == "signup", " ").otherwise(F.col("event_type"))
    return selection.speech(table(spark, sf_dir, "events").select("event_id", word.alias("word")))


_LINES = """sp AS (SELECT conv_id, turn, role, string_split(text, chr(10)) AS ls FROM conversations WHERE text IS NOT NULL),
li AS (SELECT conv_id, turn, role, unnest(range(len(ls))) AS nr, unnest(ls) AS l FROM sp),
ln AS (SELECT conv_id, turn, nr, CASE WHEN nr = 0 AND turn % 3 = 1 THEN 'Guest: ' || l WHEN nr = 0 AND turn % 3 = 2 AND role = 'user' THEN 'Target: ' || l ELSE l END AS line FROM li),
h AS (SELECT *, regexp_matches(line, '^\\s*([A-Za-z][A-Za-z .]{1,30}):\\s*(.*)$') AS header, CASE WHEN regexp_matches(line, '^\\s*([A-Za-z][A-Za-z .]{1,30}):\\s*(.*)$') THEN regexp_matches(line, '^Target:') END AS own FROM ln),
f AS (SELECT *, coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, nr ROWS UNBOUNDED PRECEDING), TRUE) AS kept FROM h)"""


@query("target_lines", f"WITH {_LINES} SELECT conv_id, turn, CAST(nr AS INTEGER) AS nr, CASE WHEN header THEN regexp_extract(line, '^\\s*([A-Za-z][A-Za-z .]{{1,30}}):\\s*(.*)$', 2) ELSE line END AS line FROM f WHERE kept")
def target_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of the target speaker's turns by the headers within them, some turns being given one."""
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.posexplode(F.split("text", "\n")).alias("nr", "l"))
    opens = F.col("nr") == 0
    line = F.when(opens & (F.col("turn") % 3 == 1), F.concat(F.lit("Guest: "), "l")).when(opens & (F.col("turn") % 3 == 2) & (F.col("role") == "user"), F.concat(F.lit("Target: "), "l")).otherwise(F.col("l"))
    return timeline.target_lines(lines.select("conv_id", "turn", "nr", line.alias("line")), "^Target:", "turn", "nr", keys=("conv_id",))


@query(
    "stable_tracks",
    f"""WITH {_SIGNAL} SELECT lecture, frame, coalesce(count(f0) OVER o >= 5 AND stddev_pop(f0) OVER o < 70 AND count(f1) OVER o >= 5 AND stddev_pop(f1) OVER o < 45, FALSE) AS stable FROM s
WINDOW o AS (PARTITION BY lecture ORDER BY frame ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
)
def stable_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames around which both tracks are measured and steady."""
    s = _signal(spark, sf_dir)
    return s.select("lecture", "frame", timeline.stable(s, {"f0": 70, "f1": 45}, "frame").alias("stable"))


@query(
    "frame_energy",
    """WITH e AS (SELECT user_id AS lecture, row_number() OVER w - 1 AS i, sqrt(avg(value * value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)) AS e FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
k AS (SELECT * FROM e WHERE i % 2 = 0)
SELECT lecture, CAST(i // 2 AS BIGINT) AS frame, round(20 * log10(greatest(e / max(e) OVER (PARTITION BY lecture), 1e-10)), 6) AS db FROM k""",
)
def frame_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("lecture"), "event_id", "value")
    return timeline.frame_energy(e, "value", 4, 2, "event_id").select("lecture", "frame", rounded("db", 6).alias("db"))


@query("stride_frames", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events) WHERE i % 4 = 0")
def stride_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = selection.placed(table(spark, sf_dir, "events").select("user_id", "event_id"), "event_id", keys=("user_id",))
    return ranked.where((F.col("place") - 1) % 4 == 0).drop("place")


@query(
    "trailing_trim",
    """WITH e AS (SELECT user_id AS lecture, event_id, abs(value) AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, max(abs(value)) OVER (PARTITION BY user_id) AS p FROM events),
l AS (SELECT *, max(CASE WHEN v > p * 0.5011872336272722 THEN i END) OVER (PARTITION BY lecture) AS last FROM e)
SELECT lecture, event_id FROM l WHERE i <= last + 2""",
)
def trailing_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("lecture"), "event_id", "value")
    return timeline.trailing_trim(e, "value", 2, "event_id", threshold=-6.0).select("lecture", "event_id")


_GRID = """pt AS (SELECT user_id AS lecture, CAST(event_id AS DOUBLE) AS x, value AS y FROM events), gr AS (SELECT lecture, unnest(range(CAST(500 * floor(min(x) / 500) AS BIGINT), CAST(500 * ceil(max(x) / 500) AS BIGINT) + 1, 500))::DOUBLE AS x FROM pt GROUP BY lecture),
ab AS (SELECT g.lecture, g.x, arg_max(p.x, p.x) FILTER (WHERE p.x <= g.x) AS ax, arg_max(p.y, p.x) FILTER (WHERE p.x <= g.x) AS ay, arg_min(p.x, p.x) FILTER (WHERE p.x >= g.x) AS bx, arg_min(p.y, p.x) FILTER (WHERE p.x >= g.x) AS by_ FROM gr g JOIN pt p USING (lecture) GROUP BY 1, 2)"""


@query("interpolated_grid", f"WITH {_GRID} SELECT lecture, x, round(CASE WHEN ax IS NULL THEN by_ WHEN bx IS NULL OR ax = bx THEN ay ELSE ay + (by_ - ay) * ((x - ax) / (bx - ax)) END, 6) AS y FROM ab")
def interpolated_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "events").select(F.col("user_id").alias("lecture"), F.col("event_id").cast("double").alias("x"), F.col("value").alias("y"))
    return timeline.interpolated_every(points.where("lecture IS NOT NULL"), 500, "x", "y").withColumn("y", rounded_column("y", 6))


@query("ordered_turns", f'WITH {TURNS_SQL} SELECT lecture, id, CAST(row_number() OVER (PARTITION BY lecture ORDER BY "start", "end", id) AS INTEGER) AS place FROM turns')
def ordered_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.placed(turns(spark, sf_dir), "start", "end", "id", keys=("lecture",)).select("lecture", "id", "place")


@query(
    "segments_export",
    f"""WITH {TURNS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY lecture ORDER BY "start", "end", id) AS clip FROM turns)
SELECT lecture, CAST(clip AS INTEGER) AS clip, round("start", 3) AS "start", round("end", 3) AS "end", round("end" - "start", 3) AS dur, speaker FROM n""",
)
def segments_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments in the order of their start, numbered anew, times to the millisecond."""
    t = selection.placed(turns(spark, sf_dir), "start", "end", "id", keys=("lecture",))
    return t.select("lecture", F.col("place").alias("clip"), rounded("start", 3).alias("start"), rounded("end", 3).alias("end"), rounded(F.col("end") - F.col("start"), 3).alias("dur"), "speaker")


_TSV = "clip || chr(9) || regexp_extract(audio, '([^/]+)$', 1) || chr(9) || decision || chr(9) || replace(coalesce(text, ''), chr(9), ' ')"
_FILE = "regexp_extract(audio, '([^/]+)$', 1)"


@query(
    "review_export",
    f"""WITH {_GATED} SELECT 'tsv' AS form, {_TSV} AS line FROM report
UNION ALL SELECT 'jsonl', '{{"clip":' || clip || ',"file":"' || {_FILE} || '","decision":"' || decision || '","dur":' || round(dur * 100)::BIGINT || '}}' FROM report""",
)
def review_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of a review's export: lines of tab-separated text, and JSON lines with durations in hundredths of a second."""
    rows = report(spark, sf_dir).withColumn("file", T.basename(F.col("audio")))
    fields = F.struct("clip", "file", "decision", F.round(F.col("dur") * 100).cast("bigint").alias("dur"))
    return selection.union_all(rows.select(F.lit("tsv").alias("form"), tsv_lines(rows, "clip", "file", "decision", "text").alias("line")), rows.select(F.lit("jsonl").alias("form"), F.to_json(fields).alias("line")))


@query(
    "blind_export",
    """WITH i AS (SELECT conv_id AS test, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY md5('s5:' || conv_id || ':' || turn), turn) AS INTEGER) AS slot, turn AS item, role FROM conversations)
SELECT test, '{"test":' || test || ',"items":[' || string_agg('{"slot":' || slot || ',"item":' || item || ',"role":"' || role || '"}', ',' ORDER BY slot) || ']}' AS json FROM i GROUP BY test""",
)
def blind_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of a blind test as one JSON object a test, with its slots in order."""
    from clipwise.operators import sampling

    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("test"), F.col("turn").alias("item"), "role")
    items = F.array_sort(F.collect_list(F.struct("slot", "item", "role"))).alias("items")
    return sampling.slots(rows, "test", "item", "s5").groupBy("test").agg(items).select("test", F.to_json(F.struct("test", "items")).alias("json"))


_ITEM = """'{"clip":' || clip || ',"status":"' || status || '","decision":"' || decision || '"}'"""


@query("gallery_dataset", f"WITH {_GATED} SELECT lecture, CAST(row_number() OVER (PARTITION BY lecture ORDER BY clip) AS INTEGER) AS place, {_ITEM} AS item FROM report")
def gallery_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a page about a lecture embeds: an item a row, in the order of the page, so that no lecture is one list."""
    rows = selection.placed(report(spark, sf_dir).select("lecture", "clip", "status", "decision"), "clip", keys=("lecture",))
    return rows.select("lecture", "place", F.to_json(F.struct("clip", "status", "decision")).alias("item"))


_LONG = "v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), lo AS (SELECT vec_id, label, unnest(range(1, len(x) + 1)) AS bin, unnest(x) AS y FROM v), m AS (SELECT label, bin, avg(my) AS level FROM (SELECT label, vec_id % 5 AS u, bin, avg(y) AS my FROM lo GROUP BY 1, 2, 3) GROUP BY 1, 2)"


def _spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select("label", (F.col("vec_id") % 5).alias("u"), F.posexplode(V.doubles(F.col("embedding"))).alias("bin", "y"))
    return experiments.mean_of_means(v.withColumn("bin", (F.col("bin") + 1).cast("bigint")), "y", "u", "bin", "label")


@query("mean_spectrum", f"WITH {_LONG} SELECT label, bin, round(level, 8) AS level FROM m")
def mean_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spectra(spark, sf_dir).withColumn("level", rounded("level", 8))


@query("spectrum_distance", f"WITH {_LONG} SELECT a.label, round(1 - corr(a.level, b.level), 6) AS distance FROM m a JOIN m b ON b.bin = a.bin AND b.label = 0 GROUP BY a.label")
def spectrum_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _spectra(spark, sf_dir)
    both = m.join(hinted(m.where("label = 0").select("bin", F.col("level").alias("other"))), "bin")
    return experiments.correlation_distance(both, "level", "other", "label").withColumn("distance", rounded("distance", 6))


@query("pitch_summary", f"WITH {_SIGNAL} SELECT lecture, round(median(f0), 6) AS mid, round(quantile_cont(f0, 0.1), 6) AS p10, round(quantile_cont(f0, 0.9), 6) AS p90, round(median(f1), 6) AS formant, round(stddev_pop(f1), 6) AS spread FROM s GROUP BY lecture")
def pitch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = experiments.pitch_summary(_signal(spark, sf_dir), "f0", "f1", "lecture")
    return found.withColumns({c: rounded(c, 6) for c in found.columns if c != "lecture"})


_SUM = f"{_SIGNAL}, q AS (SELECT lecture, median(f0) AS mid, median(f1) AS formant, stddev_pop(f1) AS spread FROM s GROUP BY lecture)"


@query("voice_distance", f"WITH {_SUM} SELECT a.lecture, round(sqrt(pow((a.formant - b.formant) / 100, 2) + pow((a.mid - b.mid) / 250, 2)) + abs(a.spread - b.spread) / 150 + abs(a.mid - b.mid) / 20, 6) AS distance FROM q a, q b WHERE b.lecture = (SELECT min(lecture) FROM q)")
def voice_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each voice's summary from the first one's, a table of one row."""
    q = experiments.pitch_summary(_signal(spark, sf_dir), "f0", "f1", "lecture")
    ref = q.orderBy("lecture").limit(1).select(F.col("mid").alias("m0"), F.col("formant").alias("f0"), F.col("spread").alias("s0"))
    d = experiments.composite_distance(F.col("formant") - F.col("f0"), F.col("mid") - F.col("m0"), F.col("spread") - F.col("s0"), F.col("mid") - F.col("m0"))
    return q.crossJoin(F.broadcast(ref)).select("lecture", rounded(d, 6).alias("distance"))


@query("semitone_rmse", "SELECT user_id AS lecture, round(CASE WHEN count(*) >= 5 THEN sqrt(avg(pow(12 * log2((80 + value) / (100 + event_id % 50)), 2))) END, 6) AS rmse, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1")
def semitone_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("event_type <> 'error'").select(F.col("user_id").alias("lecture"), (80 + F.col("value")).alias("a"), (100 + F.col("event_id") % 50).alias("b"))
    return experiments.semitone_rmse(e, "a", "b", "lecture").withColumn("rmse", rounded("rmse", 6))


@query("rounded_even", "SELECT event_id, round_even(CAST(event_id AS DECIMAL(18, 3)) / 8, 2)::DOUBLE AS r FROM events")
def rounded_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-even rounding, over eighths, which binary numbers hold exactly."""
    return table(spark, sf_dir, "events").select("event_id", F.bround(F.col("event_id").cast("double") / 8, 2).alias("r"))


_LATENT = "v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), sc AS (SELECT a.vec_id, list_inner_product(a.x, b.x) + a.label * 0.1 + b.label * 0.1 AS score FROM v a JOIN v b ON b.vec_id = a.vec_id + 1)"


def _latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select("vec_id", V.doubles(F.col("embedding")).alias("x"), (F.col("label") * F.lit(0.1)).alias("b"))
    other = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y"), F.col("b").alias("c"))
    return v.join(other, "vec_id").select("vec_id", V.latent_score(F.col("x"), F.col("y"), F.col("b"), F.col("c")).alias("score"))


@query("latent_scores", f"WITH {_LATENT} SELECT vec_id, round(score, 6) AS score FROM sc")
def latent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latent(spark, sf_dir).withColumn("score", rounded("score", 6))


@query("top_bottom", f"WITH {_LATENT} (SELECT 'top' AS side, vec_id FROM sc ORDER BY score DESC, vec_id LIMIT 5) UNION ALL (SELECT 'bottom', vec_id FROM sc ORDER BY score, vec_id LIMIT 5)")
def top_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _latent(spark, sf_dir)
    side = lambda name, *order: selection.top(s, 5, *order).select(F.lit(name).alias("side"), "vec_id")
    return selection.union_all(side("top", F.desc("score"), "vec_id"), side("bottom", "score", "vec_id"))


@query("principal_axes")
def principal_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates on the three main axes of all vectors; tested against a decomposition in memory."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("x"))
    done = V.projected(v, "x", *V.principal(v, "x", 3))
    return done.select("vec_id", *[rounded(F.get("projection", F.lit(i)), 6).alias(f"pc{i + 1}") for i in range(3)])


@query(
    "sessions",
    """WITH e AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 1 DAY THEN 0 ELSE 1 END AS br FROM events),
g AS (SELECT *, sum(br) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, min(ts) AS "start", max(ts) AS last, count(*) AS n, round(sum(value), 4) AS total FROM g GROUP BY user_id, k""",
)
def session_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a user's events less than a day apart; the same transformation serves a stream."""
    return sessions(table(spark, sf_dir, "events"), "1 day").withColumn("total", rounded("total", 4))


@query(
    "sliding_levels",
    """SELECT CAST(w AS TIMESTAMP) AS "start", event_type, round(sqrt(avg(value * value)), 6) AS level, count(*) AS n
FROM (SELECT *, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS w FROM events) GROUP BY 1, 2""",
)
def sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_levels(table(spark, sf_dir, "events"), "2 days", "1 day").withColumn("level", rounded("level", 6))


_DIA = "".join(k for k, v in T.ASCII_OF.items() if v and k.isalpha()).lower()
_DIA = "".join(dict.fromkeys(c for c in _DIA if c.isalpha()))


@query(
    "diacritic_ratio",
    f"""WITH t AS (SELECT doc_id, lower(text) AS x FROM documents), c AS (SELECT doc_id, len(regexp_extract_all(x, '[a-z{_DIA}''’]+')) AS n, len(regexp_extract_all(x, '[a-z{_DIA}''’]*(?:[{_DIA}]|[a-z][''’][a-z])[a-z{_DIA}''’]*')) AS k FROM t)
SELECT doc_id, round(CASE WHEN n > 0 THEN k / CAST(n AS DOUBLE) ELSE 0.0 END, 6) AS ratio FROM c""",
)
def diacritic_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", rounded(T.diacritic_ratio(F.col("text")), 6).alias("ratio"))


@query("ascii_rows", "SELECT doc_id, NOT regexp_matches(text, '[^\\x00-\\x7F]') AS ascii FROM documents")
def ascii_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.is_ascii(F.col("text")).alias("ascii"))


@query("parsed_ids", "SELECT p_partkey, list_transform(list_filter(string_split_regex(p_partkey || ', ' || p_size || '  x7,' || p_partkey * 3, '[,\\s]+'), lambda x: regexp_matches(x, '^\\d+$')), lambda x: CAST(x AS BIGINT)) AS ids FROM part")
def parsed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.concat(F.col("p_partkey").cast("string"), F.lit(", "), F.col("p_size").cast("string"), F.lit("  x7,"), (F.col("p_partkey") * 3).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", selection.parsed_ids(listed).alias("ids"))


_DROP = ", ".join(f"'{w}'" for w in LEXICON[:6])


@query("words_removed", f"WITH w AS (SELECT item_id, regexp_split_to_array(trim(text), '\\s+') AS ws FROM benchmark) SELECT item_id, array_to_string(list_filter(ws, lambda x: lower(x) NOT IN ({_DROP})), ' ') AS text FROM w")
def words_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", T.without_words(F.col("text"), LEXICON[:6]).alias("text"))


@query("named_columns", "SELECT n_nationkey AS a, n_name AS b, n_regionkey AS c FROM nation")
def named_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separated text without a header, read with names and types: the table is written as lines of it first."""
    path = scratch(spark, "named")
    lines = table(spark, sf_dir, "nation").select(F.concat_ws("|", "n_nationkey", "n_name", "n_regionkey").alias("value"))
    lines.write.text(path)
    return spark.read.schema("a int, b string, c int").option("sep", "|").csv(path)
