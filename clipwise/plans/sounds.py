"""Queries over spectra: a user's values, by event, stand for the samples of a clip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwise.functions.numbers import rounded
from clipwise.operators import spectra

from .base import query, table


def _clips(spark: SparkSession, sf_dir: str, column: str = "user_id") -> DataFrame:
    samples = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "value"))), lambda s: s["value"] / 500)
    return table(spark, sf_dir, "events").groupBy(F.col(column).alias("clip")).agg(samples.alias("samples"))


#: Windows of 16 samples every 8, with half a window of silence at both ends.
_FRAMES = """s AS (SELECT user_id AS clip, value / 500.0 AS y, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 + 8 AS i FROM events),
n AS (SELECT clip, greatest(count(*) + 16, 16) AS len FROM s GROUP BY clip),
f AS (SELECT clip, unnest(range(0, (len - 16) // 8 + 1)) AS frame FROM n),
w AS (SELECT f.clip, f.frame, s.i - 8 * f.frame AS j, s.y * (0.5 - 0.5 * cos(2 * pi() * (s.i - 8 * f.frame) / 15)) AS y FROM f JOIN s ON s.clip = f.clip AND s.i BETWEEN 8 * f.frame AND 8 * f.frame + 15),
p AS (SELECT clip, frame, k, pow(sum(y * cos(2 * pi() * k * j / 16)), 2) + pow(sum(y * sin(2 * pi() * k * j / 16)), 2) AS power FROM w, (SELECT unnest(range(0, 9)) AS k) GROUP BY ALL)"""
_MEL = """pt AS (SELECT i, 700 * (pow(10, (2595 * log10(1 + 8000 / 700.0) * i / 5.0) / 2595) - 1) AS hz FROM (SELECT unnest(range(0, 6)) AS i)),
fi AS (SELECT a.i AS band, k, greatest(0, least((k * 1000.0 - a.hz) / (b.hz - a.hz), (c.hz - k * 1000.0) / (c.hz - b.hz))) AS wt FROM pt a JOIN pt b ON b.i = a.i + 1 JOIN pt c ON c.i = a.i + 2, (SELECT unnest(range(0, 9)) AS k)),
m AS (SELECT clip, frame, band, sum(power * wt) AS v FROM p JOIN fi USING (k) GROUP BY ALL),
md AS (SELECT clip, frame, band, 10 * log10(greatest(v, 1e-10) / greatest(max(v) OVER (PARTITION BY clip), 1e-10)) AS db FROM m)"""
_SMALL = {"size": 16, "hop": 8}


@query(
    "clip_spectrogram",
    f"""WITH {_FRAMES} SELECT clip, CAST(frame AS INTEGER) AS frame, CAST(k AS INTEGER) AS bin, round(10 * log10(greatest(power, 1e-10) / greatest(max(power) OVER (PARTITION BY clip), 1e-10)), 3) + 0.0 AS db FROM p WHERE k <= 5""",
)
def clip_spectrogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spectra.spectrogram(_clips(spark, sf_dir), 16, 8, top=8000.0)
    bins = found.select("clip", "frame", F.posexplode("power").alias("bin", "db")).where("bin <= 5")
    return bins.withColumn("db", rounded("db", 3) + 0.0)


@query("clip_mel", f"WITH {_FRAMES}, {_MEL} SELECT clip, CAST(frame AS INTEGER) AS frame, CAST(band AS INTEGER) AS band, round(db, 3) + 0.0 AS db FROM md")
def clip_mel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra.mel(_clips(spark, sf_dir), 4, **_SMALL).select("clip", "frame", F.posexplode("mel").alias("band", "db")).withColumn("db", rounded("db", 3) + 0.0)


@query(
    "clip_cepstra",
    f"""WITH {_FRAMES}, {_MEL} SELECT clip, CAST(frame AS INTEGER) AS frame, CAST(c AS INTEGER) AS c, round(sum(greatest(db, -80) * cos(c * (2 * band + 1) * pi() / 8) * sqrt(0.5)), 3) + 0.0 AS v FROM md, (SELECT unnest(range(1, 4)) AS c) GROUP BY ALL""",
)
def clip_cepstra(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spectra.cepstra(_clips(spark, sf_dir), 4, 4, **_SMALL).select("clip", "frame", F.posexplode("c").alias("c", "v"))
    return found.select("clip", "frame", (F.col("c") + 1).alias("c"), (rounded("v", 3) + 0.0).alias("v"))


@query(
    "voice_spectra",
    f"""WITH {_FRAMES}, c AS (SELECT clip, k, 10 * log10(greatest(avg(power), 1e-12)) AS db FROM p GROUP BY ALL), g AS (SELECT clip % 5 AS voice, k, avg(db) AS level FROM c GROUP BY ALL)
SELECT voice, CAST(k AS INTEGER) AS bin, round(level - max(level) OVER (PARTITION BY voice), 4) + 0.0 AS level FROM g""",
)
def voice_spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = _clips(spark, sf_dir)
    voices = table(spark, sf_dir, "events").select(F.col("user_id").alias("clip"), (F.col("user_id") % 5).alias("voice")).distinct()
    return spectra.pooled(clips, voices, **_SMALL).withColumn("level", rounded("level", 4) + 0.0)


@query("cepstral_distances")
def cepstral_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each clip against the next; tested against plain loops."""
    clips = _clips(spark, sf_dir)
    pairs = clips.select(F.col("clip").alias("a"), (F.col("clip") + 1).alias("b")).join(clips.select(F.col("clip").alias("b")), "b", "left_semi")
    return spectra.cepstral_distance(pairs, clips, n=8, mels=16, size=64, hop=16).select("a", "b", rounded("mcd", 4).alias("mcd"))


@query("pitch_distances")
def pitch_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of a user's clicks and views, values standing for pitches; tested against plain loops."""
    track = lambda kind: F.array_sort(F.collect_list(F.when(F.col("event_type") == kind, F.struct("event_id", F.when(F.col("value") >= 20, F.col("value")).alias("f")))))
    tracks = table(spark, sf_dir, "events").groupBy("user_id").agg(track("click").alias("a"), track("view").alias("b"))
    pitches = tracks.select("user_id", *[F.transform(c, lambda x: x["f"]).alias(c) for c in "ab"])
    return spectra.pitch_distance(pitches).select("user_id", rounded("f0_rmse", 4).alias("f0_rmse"))


@query(
    "cut_clips",
    """WITH s AS (SELECT user_id AS clip, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, max(value) OVER (PARTITION BY user_id) AS top FROM events),
q AS (SELECT clip, min(i) FILTER (WHERE v / 500 > top / 500 * 0.5011872336272722) AS a, max(i) FILTER (WHERE v / 500 > top / 500 * 0.5011872336272722) AS b, count(*) AS n FROM s GROUP BY clip),
c AS (SELECT clip, count(*) AS n, round(sum(v / 500), 6) AS total FROM s WHERE i >= 8 AND i < 40 GROUP BY clip)
SELECT clip, coalesce(c.n, 0) AS cut_n, c.total AS cut_total, least(q.b + 1 + 3, q.n) - greatest(q.a - 3, 0) AS trimmed_n FROM q LEFT JOIN c USING (clip)""",
)
def cut_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two milliseconds of each clip, and how much of it is left without silence at its ends."""
    clips = _clips(spark, sf_dir).withColumn("c", spectra.cut(F.col("samples"), F.lit(0.0005), F.lit(0.0025)))
    total = F.when(F.size("c") > 0, rounded(F.aggregate("c", F.lit(0.0), lambda a, x: a + x), 6))
    trimmed = F.size(spectra.without_silence(F.col("samples"), threshold=-6.0, keep=3 / 16000))
    return clips.select("clip", F.size("c").cast("long").alias("cut_n"), total.alias("cut_total"), trimmed.cast("long").alias("trimmed_n"))


@query("joined_clips", "SELECT user_id % 20 AS clip, count(*) + 7200 * count(DISTINCT user_id) AS n, round(sum(value / 500), 5) AS total FROM events GROUP BY 1")
def joined_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a pause after each: users by their number's last two digits, modulo 20."""
    parts = _clips(spark, sf_dir).select((F.col("clip") % 20).alias("to"), F.col("clip").alias("at"), "samples")
    files = spectra.joined(parts, "at", key="to")
    return files.select(F.col("to").alias("clip"), F.size("samples").cast("long").alias("n"), rounded(F.aggregate("samples", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


_REGIONS = [("low", 0.0, 60.0, 0.0, 60.0), ("mid", 40.0, 150.0, 0.0, 150.0), ("high", 100.0, 600.0, 0.0, 600.0)]


@query(
    "vowel_spaces",
    f"""WITH r(vowel, a, b, c, d) AS (VALUES {", ".join(f"('{v}', {a}, {b}, {c}, {d})" for v, a, b, c, d in _REGIONS)}),
f AS (SELECT event_type AS voice, value AS f1, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS f2 FROM events)
SELECT voice, vowel, count(*) AS n, round(median(f1), 6) AS f1, round(median(f2), 6) AS f2 FROM f JOIN r ON f1 BETWEEN a AND b AND f2 BETWEEN c AND d GROUP BY ALL""",
)
def vowel_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of pairs of values in three regions, which overlap."""
    from pyspark.sql import Window

    before = F.lag("value").over(Window.partitionBy("user_id").orderBy("event_id"))
    frames = table(spark, sf_dir, "events").select(F.col("event_type").alias("voice"), F.col("value").alias("f1"), before.alias("f2"))
    regions = spark.createDataFrame(_REGIONS, "vowel string, f1_low double, f1_high double, f2_low double, f2_high double")
    return spectra.vowel_space(frames, regions).select("voice", "vowel", "n", rounded("f1", 6).alias("f1"), rounded("f2", 6).alias("f2"))
