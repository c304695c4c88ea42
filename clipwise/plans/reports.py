"""Queries over a clip report: documents stand for clips, with measures derived from their ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwise.functions import text as T
from clipwise.functions.numbers import rounded
from clipwise.operators import experiments, gates, review, sampling, selection

from .base import query, table
from .texts import _LIST, LEXICON

CLIPS_SQL = """clips AS (
  SELECT d.doc_id AS clip, 'clips/' || d.source || '/' || printf('%06d', d.doc_id) || '.wav' AS audio, d.source AS lecture, d.lang, d.text,
         CAST(d.n_chars % 2500 AS DOUBLE) / 100.0 + 0.003 AS dur, CAST(-(d.doc_id * 7 % 60) AS DOUBLE) AS align_min, CAST(-(d.doc_id * 11 % 200) AS DOUBLE) / 10.0 AS align_mean,
         CAST(d.doc_id * 13 % 100 AS DOUBLE) / 100.0 AS cer_core, CAST(d.doc_id * 17 % 100 - 50 AS DOUBLE) / 100.0 AS load, CASE WHEN d.doc_id % 23 <> 0 THEN CAST(d.doc_id * 3 % 10 AS DOUBLE) / 10.0 END AS lead,
         CAST(d.doc_id * 5 % 13 AS DOUBLE) / 10.0 AS trail, d.doc_id % 29 <> 0 AS has_wav, l.quality = 0 AS is_cut, CASE WHEN l.quality = 0 THEN 'cut' WHEN l.quality = 1 THEN 'keep' END AS saved
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    tenth = lambda x, by: x.cast("double") / F.lit(by)
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return docs.select(
        i.alias("clip"),
        F.concat(F.lit("clips/"), "source", F.lit("/"), F.format_string("%06d", "doc_id"), F.lit(".wav")).alias("audio"),
        F.col("source").alias("lecture"),
        "lang",
        "text",
        (tenth(F.col("n_chars") % 2500, 100.0) + 0.003).alias("dur"),
        (-(i * 7 % 60)).cast("double").alias("align_min"),
        tenth(-(i * 11 % 200), 10.0).alias("align_mean"),
        tenth(i * 13 % 100, 100.0).alias("cer_core"),
        tenth(i * 17 % 100 - 50, 100.0).alias("load"),
        F.when(i % 23 != 0, tenth(i * 3 % 10, 10.0)).alias("lead"),
        tenth(i * 5 % 13, 10.0).alias("trail"),
        (i % 29 != 0).alias("has_wav"),
        (F.col("quality") == 0).alias("is_cut"),
        F.when(F.col("quality") == 0, "cut").when(F.col("quality") == 1, "keep").alias("saved"),
    )


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clips(spark, sf_dir).where("is_cut is not null")


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clips(spark, sf_dir).withColumn("r", gates.production_reasons({**gates.PRODUCTION, "min_align": -50.0}))


_GATED = f"""{CLIPS_SQL},
gated AS (SELECT *, CASE WHEN NOT has_wav THEN 'missing_wav' ELSE array_to_string(list_filter([
    CASE WHEN align_min < -50.0 THEN printf('low_align(%.2f)', align_min) END, CASE WHEN lead IS NULL THEN 'all_silence' END, CASE WHEN lead > 0.7 THEN printf('lead_sil(%.2f)', lead) END,
    CASE WHEN trail > 1.0 THEN printf('trail_sil(%.2f)', trail) END, CASE WHEN cer_core > 0.85 THEN printf('high_cer_core(%.2f)', cer_core) END], lambda x: x IS NOT NULL), ';') END AS reasons FROM clips),
report AS (SELECT *, CASE WHEN reasons = '' THEN 'PASS' ELSE 'FAIL' END AS status, coalesce(saved, CASE WHEN reasons = '' THEN 'keep' ELSE 'cut' END) AS decision, saved IS NOT NULL AS reviewed,
   coalesce(saved, CASE WHEN reasons = '' THEN 'keep' ELSE 'cut' END) <> CASE WHEN reasons = '' THEN 'keep' ELSE 'cut' END AS override FROM gated)"""


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production gate's report with the reviewers' decisions."""
    gated = _rules(spark, sf_dir).withColumn("status", T.status(F.col("r"))).withColumn("reasons", F.array_join("r", ";")).drop("r")
    saved = gated.where("saved is not null").select("clip", F.col("saved").alias("decision"))
    return review.decisions(gated, saved, "clip")


@query("production_report", f"WITH {_GATED} SELECT clip, status, reasons FROM report")
def production_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, sf_dir).select("clip", "status", "reasons")


@query("clean_manifest", f"WITH {_GATED} SELECT clip, audio, dur FROM report WHERE status = 'PASS'")
def clean_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, sf_dir).where("status = 'PASS'").select("clip", "audio", "dur")


@query("kept_rows", f"WITH {_GATED} SELECT clip, reviewed, override FROM report WHERE decision = 'keep'")
def kept_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.kept(report(spark, sf_dir)).select("clip", "reviewed", "override")


_VIEW = "SELECT 'fail' AS view, clip FROM report WHERE status = 'FAIL' UNION ALL SELECT 'unrev', clip FROM report WHERE NOT reviewed UNION ALL SELECT 'ovr', clip FROM report WHERE override UNION ALL SELECT 'none', clip FROM report WHERE lecture = 'src1'"


@query("review_views", f"WITH {_GATED} {_VIEW}")
def review_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each view's rows; ``none`` is a view without rows over one lecture, which falls back to all of them."""
    rows = report(spark, sf_dir)
    one = rows.where("lecture = 'src1'").withColumn("override", F.lit(False))
    sides = [selection.view(rows, v).select(F.lit(v).alias("view"), "clip") for v in selection.VIEWS]
    return selection.union_all(*sides, selection.view(one, "ovr").select(F.lit("none").alias("view"), "clip"))


_ENG = f"CASE WHEN len(ts) > 0 THEN len(list_filter(ts, lambda x: x IN ({_LIST}))) / CAST(len(ts) AS DOUBLE) ELSE 0.0 END"
_TOK = f"""{CLIPS_SQL}, tk AS (SELECT *, regexp_extract_all(lower(text), '[a-z'']+') AS ts FROM clips), en AS (SELECT *, {_ENG} AS english FROM tk)"""
_SHARE = f"""{CLIPS_SQL}, w AS (SELECT clip, lang, unnest(regexp_extract_all(lower(text), '[a-z'']+')) AS word FROM clips),
lex AS (SELECT word FROM (SELECT DISTINCT clip, word FROM w WHERE lang = 'en') GROUP BY word HAVING count(*) >= 5),
sh AS (SELECT clip, count(*) FILTER (WHERE word IN (SELECT word FROM lex)) / CAST(count(*) AS DOUBLE) AS english FROM w GROUP BY clip),
en AS (SELECT clips.*, coalesce(sh.english, 0.0) AS english FROM clips LEFT JOIN sh USING (clip))"""


def lexicon(rows: DataFrame) -> DataFrame:
    """The words that five or more English clips use."""
    words = rows.where("lang = 'en'").select("clip", F.explode(T.tokens(F.col("text"))).alias("word")).distinct()
    return words.groupBy("word").count().where("count >= 5").select("word")


@query("reference_clips", f"WITH {_SHARE} SELECT clip, audio FROM en WHERE dur BETWEEN 5 AND 12 AND english >= 0.85 AND clip % 7 <> 0")
def reference_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips that may serve as references, but for those that are held out."""
    rows = clips(spark, sf_dir)
    out = rows.where("clip % 7 = 0").select(T.stem(F.col("audio")).alias("stem"))
    return selection.references(rows, lexicon(rows), out).select("clip", "audio")


@query("prompt_clips", f"WITH {_SHARE} SELECT clip FROM en WHERE dur BETWEEN 6 AND 12 AND english >= 0.9 AND lower(text) NOT LIKE '%hmm%' AND text NOT LIKE '%[%'")
def prompt_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clips(spark, sf_dir)
    return selection.prompts(rows, lexicon(rows)).select("clip")


@query("index_subset", f"WITH {CLIPS_SQL} SELECT clip, lecture FROM clips WHERE clip IN (1, 5, 9, 150)")
def index_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.only(clips(spark, sf_dir), "clip", "1,5 9, x 150").select("clip", "lecture")


@query("first_clips", f"WITH {CLIPS_SQL} SELECT clip FROM clips ORDER BY audio LIMIT 25")
def first_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.first_rows(clips(spark, sf_dir), 25, "audio").select("clip")


@query("manifest_paths", f"WITH {CLIPS_SQL} SELECT clip, 'work/' || regexp_extract(audio, '([^/]+)$', 1) AS local, lecture || '/clips/' || regexp_extract(audio, '([^/]+)$', 1) AS shared, dur * 2 AS dur, text IS NOT NULL AS has_text FROM clips")
def manifest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths under a prefix and under the lecture's folder; one field is replaced and the others pass through."""
    rows = clips(spark, sf_dir).withColumns({"dur": F.col("dur") * 2})
    shared = selection.with_prefix(F.col("audio"), F.concat("lecture", F.lit("/clips")))
    return rows.select("clip", selection.with_prefix(F.col("audio"), "work").alias("local"), shared.alias("shared"), "dur", F.col("text").isNotNull().alias("has_text"))


@query(
    "borderline_reasons",
    f"""WITH {CLIPS_SQL} SELECT clip, array_to_string(list_filter([CASE WHEN cer_core > 0.8 THEN printf('cer_core=%.2f', cer_core) END, CASE WHEN align_min < -45.0 THEN printf('align_min=%.1f', align_min) END,
 CASE WHEN abs(load) > 0.4 THEN printf('sload=%.2f', load) END, CASE WHEN NOT dur BETWEEN 4.0 AND 20.0 THEN printf('dur=%.1f', dur) END], lambda x: x IS NOT NULL), ', ') AS why
FROM clips WHERE NOT is_cut AND NOT ({gates.BATTERY["AUTO-KEEP"]})""",
)
def borderline_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each keep is a suspect of the AUTO-KEEP gate."""
    rows = _labelled(spark, sf_dir).where(~F.col("is_cut") & ~F.expr(gates.BATTERY["AUTO-KEEP"]))
    return rows.select("clip", F.array_join(gates.borderline(), ", ").alias("why"))


@query("word_list_share", f"WITH {_TOK} SELECT clip, list_contains(ts, 'the') AND list_contains(ts, 'of') AS both, round({_ENG}, 6) AS english FROM en")
def word_list_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = T.tokens(F.col("text"))
    rows = clips(spark, sf_dir).select("clip", ts.alias("ts"))
    return rows.select("clip", (F.array_contains("ts", "the") & F.array_contains("ts", "of")).alias("both"), rounded(T.share_of(F.col("ts"), LEXICON), 6).alias("english"))


_BATTERY = " UNION ALL ".join(
    f"""SELECT '{g}' AS gate, count(*) FILTER (WHERE {p}) AS kept, count(*) FILTER (WHERE ({p}) AND is_cut) AS leak, count(*) FILTER (WHERE coalesce(NOT ({p}), TRUE) AND is_cut) AS caught,
 count(*) FILTER (WHERE coalesce(NOT ({p}), TRUE) AND NOT is_cut) AS suspects, round(count(*) FILTER (WHERE {p}) / CAST(count(*) AS DOUBLE), 6) AS yield FROM lab"""
    for g, p in gates.BATTERY.items()
)
_LAB = f"{CLIPS_SQL}, lab AS (SELECT * FROM clips WHERE is_cut IS NOT NULL)"


@query("gate_battery", f"WITH {_LAB} {_BATTERY}")
def gate_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed gates, recommended and strict ones among them, in one pass over a report."""
    return gates.confusion(_labelled(spark, sf_dir), gates.BATTERY).withColumn("yield", rounded("yield", 6))


_IDS = " UNION ALL ".join(
    f"SELECT '{g}' AS gate, 'leak' AS kind, clip FROM lab WHERE ({p}) AND is_cut UNION ALL SELECT '{g}', 'suspect', clip FROM lab WHERE coalesce(NOT ({p}), TRUE) AND NOT is_cut" for g, p in gates.BATTERY.items()
)


@query("gate_confusion_ids", f"WITH {_LAB} {_IDS}")
def gate_confusion_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.confusion_ids(_labelled(spark, sf_dir), gates.BATTERY, "clip")


@query("cut_reasons", f"WITH {_GATED} SELECT DISTINCT split_part(x, '(', 1) AS reason FROM (SELECT unnest(string_split(reasons, ';')) AS x FROM report WHERE is_cut) WHERE x <> ''")
def cut_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct reasons among the cuts."""
    return gates.reason_histogram(report(spark, sf_dir).where("is_cut")).select("reason")


_METRICS = ["cer_core", "align_min", "load", "trail"]
_FLOOR = ", ".join(f"max(CASE WHEN i = least(c - 1, CAST(floor(CAST({p} AS DOUBLE) * c) AS BIGINT)) THEN x END) AS p{round(p * 100)}" for p in gates.SHARES)
_CAND = f"""{_LAB}, u AS ({" UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS x, is_cut FROM lab" for m in _METRICS)}),
rk AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY x) - 1 AS i, count(*) OVER (PARTITION BY metric) AS c FROM u),
fl AS (SELECT metric, {_FLOOR} FROM rk GROUP BY metric),
cand AS (SELECT DISTINCT metric, round(unnest([{", ".join(f"p{round(p * 100)}" for p in gates.SHARES)}]), 4) AS threshold FROM fl),
swept AS (SELECT metric, direction, threshold, count(*) FILTER (WHERE is_cut AND hit) AS caught, count(*) FILTER (WHERE NOT is_cut AND hit) AS flagged
  FROM (SELECT c.*, d.direction, u.is_cut, CASE WHEN d.direction = '>=' THEN u.x >= c.threshold ELSE u.x <= c.threshold END AS hit FROM cand c JOIN u USING (metric), (SELECT unnest(['>=', '<=']) AS direction) d) GROUP BY 1, 2, 3),
atoms AS (SELECT * FROM swept WHERE caught >= 3 AND flagged <= 70)"""


@query("quantile_candidates", f"WITH {_CAND} SELECT * FROM cand")
def quantile_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.candidates(_labelled(spark, sf_dir), _METRICS)


def _atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.atoms(_labelled(spark, sf_dir), _METRICS)


@query("atom_filter", f"WITH {_CAND} SELECT * FROM atoms")
def atom_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _atoms(spark, sf_dir)


@query("top_rules", f"WITH {_CAND} SELECT *, caught - flagged AS net FROM atoms ORDER BY net DESC, metric, direction, threshold LIMIT 40")
def top_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.top_atoms(_atoms(spark, sf_dir))


_HIT = " OR ".join(f"(metric = '{m}' AND CASE WHEN direction = '>=' THEN lab.{m} >= threshold ELSE lab.{m} <= threshold END)" for m in _METRICS)


@query(
    "or_gates",
    f"""WITH {_CAND},
pool AS (SELECT *, row_number() OVER (ORDER BY printf('%s %s %.4f', metric, direction, threshold)) - 1 AS i, printf('%s %s %.4f', metric, direction, threshold) AS t
  FROM (SELECT * FROM atoms ORDER BY caught - flagged DESC, metric, direction, threshold LIMIT 40)),
m AS (SELECT lab.clip, lab.is_cut, pool.i FROM lab JOIN pool ON {_HIT}),
combos AS (SELECT 2 AS size, a.t || ' OR ' || b.t AS rule, [a.i, b.i] AS ids FROM pool a JOIN pool b ON a.i < b.i WHERE a.metric <> b.metric OR a.direction <> b.direction
  UNION ALL SELECT 3, a.t || ' OR ' || b.t || ' OR ' || c.t, [a.i, b.i, c.i] FROM pool a JOIN pool b ON a.i < b.i JOIN pool c ON b.i < c.i),
s AS (SELECT size, rule, count(DISTINCT CASE WHEN m.is_cut THEN m.clip END) AS caught, count(DISTINCT CASE WHEN NOT m.is_cut THEN m.clip END) AS flagged FROM (SELECT size, rule, unnest(ids) AS i FROM combos) LEFT JOIN m USING (i) GROUP BY size, rule
  UNION ALL SELECT 1, printf('%s %s %.4f', metric, direction, threshold), caught, flagged FROM atoms)
SELECT CAST(size AS INTEGER) AS size, rule, caught, flagged FROM (SELECT *, row_number() OVER (PARTITION BY size ORDER BY caught DESC, flagged, rule) AS k FROM s) WHERE k = 1""",
)
def or_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best gate of one, two and three atoms."""
    rows = _labelled(spark, sf_dir)
    return gates.best_or(rows, gates.atoms(rows, _METRICS))


@query(
    "abs_sweep",
    f"""WITH {_LAB}, g AS (SELECT abs(load) AS x, count(*) FILTER (WHERE is_cut) AS cuts, count(*) FILTER (WHERE NOT is_cut) AS keeps FROM lab GROUP BY 1)
SELECT x AS threshold, CAST(sum(cuts) OVER d AS BIGINT) AS caught, CAST(sum(keeps) OVER d AS BIGINT) AS flagged FROM g WINDOW d AS (ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def abs_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir).select(F.abs("load").alias("load"), "is_cut")
    return gates.threshold_sweep(rows, ["load"]).where("direction = '>='").select("threshold", "caught", "flagged")


@query("align_suspects", f"WITH {_LAB} SELECT CAST(t AS DOUBLE) AS threshold, count(*) FILTER (WHERE NOT is_cut) AS suspects, count(*) FILTER (WHERE is_cut) AS caught FROM lab, (SELECT unnest([-50, -45, -40, -38, -35]) AS t) WHERE align_min <= t GROUP BY t")
def align_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.suspects(_labelled(spark, sf_dir), "align_min", [-50, -45, -40, -38, -35])


_FAIL_FIRST = f"WITH {_GATED} SELECT lecture, clip, CAST(row_number() OVER (PARTITION BY lecture ORDER BY (status = 'FAIL') DESC, align_min, clip) AS INTEGER) AS place FROM report"


@query("fail_first", _FAIL_FIRST)
def fail_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = (F.desc(F.col("status") == "FAIL"), "align_min", "clip")
    return selection.placed(report(spark, sf_dir), *order, keys=("lecture",)).select("lecture", "clip", "place")


@query("worst_rate", f"WITH {CLIPS_SQL}, t AS (SELECT clip, CASE WHEN dur > 0 THEN length(text) / dur ELSE 0.0 END AS rate FROM clips ORDER BY rate, clip LIMIT 6) SELECT clip, round(rate, 6) AS rate, CAST(row_number() OVER (ORDER BY rate, clip) AS INTEGER) AS place FROM t")
def worst_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clips(spark, sf_dir).select("clip", F.coalesce(F.try_divide(F.length("text"), F.col("dur")), F.lit(0.0)).alias("rate"))
    return selection.top(rows, 6, "rate", "clip").withColumn("rate", rounded("rate", 6))


@query("longest_prompt", f"WITH {CLIPS_SQL} SELECT clip, length(text) AS n FROM clips ORDER BY n DESC, audio LIMIT 1")
def longest_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.first_rows(clips(spark, sf_dir).withColumn("n", F.length("text").cast("bigint")).withColumn("_o", -F.col("n")), 1, "_o", "audio").select("clip", "n")


@query("longest_clips", f"WITH {CLIPS_SQL}, t AS (SELECT clip, dur FROM clips ORDER BY dur DESC, clip LIMIT 18) SELECT *, CAST(row_number() OVER (ORDER BY dur DESC, clip) AS INTEGER) AS place FROM t")
def longest_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.top(clips(spark, sf_dir).select("clip", "dur"), 18, F.desc("dur"), "clip")


@query("lowest_align", f"WITH {_LAB}, t AS (SELECT clip, align_min, is_cut FROM lab ORDER BY align_min, clip LIMIT 12) SELECT *, CAST(row_number() OVER (ORDER BY align_min, clip) AS INTEGER) AS place FROM t")
def lowest_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.top(_labelled(spark, sf_dir).select("clip", "align_min", "is_cut"), 12, "align_min", "clip")


@query("positional_ids", f"WITH {CLIPS_SQL} SELECT c.clip, CAST(regexp_extract(c.audio, '(\\d+)\\.wav$', 1) AS BIGINT) AS derived, l.toxic FROM clips c JOIN labels l ON l.doc_id = CAST(regexp_extract(c.audio, '(\\d+)\\.wav$', 1) AS BIGINT)")
def positional_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a manifest meet a report by the number in the file name, not by line order."""
    rows = clips(spark, sf_dir).select("clip", F.regexp_extract("audio", r"(\d+)\.wav$", 1).cast("bigint").alias("derived"))
    return rows.join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("derived"), "toxic"), "derived").select("clip", "derived", "toxic")


@query("paired_by_name", f"WITH {CLIPS_SQL}, a AS (SELECT regexp_extract(audio, '([^/]+)$', 1) AS name, cer_core FROM clips WHERE clip % 2 = 0), b AS (SELECT regexp_extract(audio, '([^/]+)$', 1) AS name, load FROM clips WHERE clip % 3 = 0) SELECT name, round(load - cer_core, 6) AS delta FROM a JOIN b USING (name)")
def paired_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clips(spark, sf_dir).withColumn("name", T.basename(F.col("audio")))
    return rows.where("clip % 2 = 0").select("name", "cer_core").join(rows.where("clip % 3 = 0").select("name", "load"), "name").select("name", rounded(F.col("load") - F.col("cer_core"), 6).alias("delta"))


@query("sentence_registry", f"WITH {CLIPS_SQL} SELECT c.clip, coalesce(l.quality = 1, FALSE) AS seen, l.toxic AS real FROM clips c LEFT JOIN labels l ON l.doc_id = c.clip")
def sentence_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("clip"), (F.col("quality") == 1).alias("seen"), F.col("toxic").alias("real"))
    return selection.registered(clips(spark, sf_dir).select("clip"), registry, "clip", {"seen": False, "real": None})


@query("missing_report", f"WITH {CLIPS_SQL} SELECT clip FROM clips WHERE clip NOT IN (SELECT doc_id FROM labels) ORDER BY clip LIMIT 5")
def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first few clips without a counterpart, for the message."""
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("clip"))
    return selection.missing(clips(spark, sf_dir), done, "clip")[1]


@query("numbered_clips", f"WITH {CLIPS_SQL} SELECT clip, lecture || '_' || printf('%04d', row_number() OVER (PARTITION BY lecture ORDER BY clip)) AS id FROM clips")
def numbered_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.numbered(clips(spark, sf_dir), "clip", prefix=F.concat("lecture", F.lit("_")), keys=("lecture",)).select("clip", "id")


_RANK = f"{CLIPS_SQL}, rk AS (SELECT *, row_number() OVER (PARTITION BY lecture ORDER BY audio) - 1 AS i, count(*) OVER (PARTITION BY lecture) AS n FROM clips)"


@query("rank_slices", f"WITH {_RANK} SELECT clip, CASE WHEN i < 20 THEN 'reference' ELSE 'held_out' END AS part FROM rk WHERE i < 30")
def rank_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clips(spark, sf_dir)
    side = lambda low, high, name: selection.sliced(rows, low, high, "audio", keys=("lecture",)).select("clip", F.lit(name).alias("part"))
    return selection.union_all(side(0, 20, "reference"), side(20, 30, "held_out"))


@query("mid_controls", f"WITH {_GATED}, p AS (SELECT *, row_number() OVER (PARTITION BY lecture ORDER BY clip) - 1 AS i, count(*) OVER (PARTITION BY lecture) AS n FROM report WHERE status = 'PASS') SELECT lecture, clip FROM p WHERE i >= n // 2 AND i < n // 2 + 3")
def mid_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.middle(report(spark, sf_dir).where("status = 'PASS'"), 3, "clip", keys=("lecture",)).select("lecture", "clip")


@query("lecture_union", f"WITH {CLIPS_SQL} SELECT clip, dur, NULL AS align_min FROM clips WHERE lecture = 'src1' UNION ALL SELECT clip, dur, align_min FROM clips WHERE lecture <> 'src1' AND clip % 2 = 0")
def lecture_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of several lectures in one table; keys that a manifest lacks are null."""
    rows = clips(spark, sf_dir)
    return selection.union_all(rows.where("lecture <> 'src1' and clip % 2 = 0").select("clip", "dur", "align_min"), rows.where("lecture = 'src1'").select("clip", "dur"))


@query("keys_union", "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def keys_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    return selection.keys_of(a, table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("k")), key="k")


@query("unknown_keys", "SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that orders name and the list of those without debts lacks."""
    known = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("k"))
    return selection.unknown(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), known, "k")


@query("ordered_distinct", "SELECT user_id, event_type, CAST(row_number() OVER (PARTITION BY user_id ORDER BY min(event_id)) AS INTEGER) AS place FROM events GROUP BY user_id, event_type")
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.ordered_distinct(table(spark, sf_dir, "events"), "event_type", "event_id", keys=("user_id",)).select("user_id", "event_type", "place")


@query("explicit_split", f"WITH {CLIPS_SQL} SELECT clip, CASE WHEN lecture IN ('src1', 'src3', 'absent') THEN 'val' ELSE 'train' END AS split FROM clips")
def explicit_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = spark.range(1).select(F.explode(F.array(F.lit("src1"), F.lit("src3"), F.lit("absent"))).alias("lecture"))
    return sampling.explicit_split(clips(spark, sf_dir), "lecture", held).select("clip", "split")


@query("side_flips", "SELECT conv_id, turn, CAST(('0x' || substr(md5('s6:' || conv_id || ':' || turn), 1, 8)) AS BIGINT) / 4294967296.0 < 0.5 AS a_first FROM conversations")
def side_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", sampling.flipped("s6", F.col("conv_id"), F.col("turn")).alias("a_first"))


@query("opaque_names", "SELECT conv_id, turn, 'c' || printf('%02d', row_number() OVER (PARTITION BY conv_id ORDER BY md5('s7:' || conv_id || ':' || turn), turn)) || '.wav' AS name FROM conversations")
def opaque_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies under names that say nothing."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return sampling.opaque(rows, "turn", "s7", keys=("conv_id",)).select("conv_id", "turn", F.concat("opaque", F.lit(".wav")).alias("name"))


@query("capped_sample", "SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5('s8:' || event_type || ':' || event_id), event_id) AS k FROM events) WHERE k <= 450")
def capped_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.capped(table(spark, sf_dir, "events").select("event_type", "event_id"), "event_id", 450, "s8", keys=("event_type",))


_PAIRED = """p AS (SELECT conv_id, turn, 'o' || turn AS a, 'd' || turn AS b FROM conversations),
pk AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY md5('s9:' || conv_id || ':' || turn), turn) AS k FROM p)"""


@query("attention_rows", f"WITH {_PAIRED} SELECT conv_id, turn, a, b, FALSE AS attention FROM pk UNION ALL SELECT conv_id, turn, a, a, TRUE FROM pk WHERE k = 1")
def attention_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit("o"), "turn").alias("a"), F.concat(F.lit("d"), "turn").alias("b"))
    return sampling.with_attention(pairs, "turn", "a", "b", "s9", keys=("conv_id",))


_PREF = """f AS (SELECT user_id % 10 AS listener, CASE event_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'same' END AS picked, CASE WHEN value > 30 THEN 'orig' ELSE 'dn' END AS a,
 CASE WHEN value > 30 THEN 'dn' ELSE 'orig' END AS b, CASE WHEN event_type = 'error' THEN 'tie' WHEN value > 50 THEN 'orig' ELSE 'dn' END AS fav, event_id % 17 = 0 AS att FROM events),
e AS (SELECT *, CASE picked WHEN 'A' THEN a WHEN 'B' THEN b ELSE 'same' END AS ear, coalesce(picked <> 'same', FALSE) AND NOT att AS chosen FROM f)"""


@query(
    "preference_agreement",
    f"""WITH {_PREF} SELECT listener, count(*) FILTER (WHERE NOT att AND ear = 'orig') AS ear_orig, count(*) FILTER (WHERE NOT att AND ear = 'dn') AS ear_dn, count(*) FILTER (WHERE NOT att AND ear = 'same') AS same,
 count(*) FILTER (WHERE NOT att AND fav = 'orig') AS metric_orig, count(*) FILTER (WHERE chosen) AS scored, count(*) FILTER (WHERE chosen AND ear = fav) AS agreed, bool_or(coalesce(picked = 'same', FALSE)) FILTER (WHERE att) AS attentive FROM e GROUP BY listener""",
)
def preference_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    loud, k = F.col("value") > 30, F.col("event_id") % 4
    rows = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("listener"),
        F.when(k == 0, "A").when(k == 1, "B").when(k == 2, "same").alias("picked"),
        F.when(loud, "orig").otherwise("dn").alias("a"),
        F.when(loud, "dn").otherwise("orig").alias("b"),
        F.when(F.col("event_type") == "error", "tie").when(F.col("value") > 50, "orig").otherwise("dn").alias("favoured"),
        (F.col("event_id") % 17 == 0).alias("attention"),
    )
    return review.preferences(rows, "listener")


@query("rating_tags", "SELECT user_id % 10 AS identity, unnest([event_type, CASE WHEN value > 30 THEN 'loud' ELSE 'quiet' END]) AS tag, count(*) AS n FROM events GROUP BY 1, 2")
def rating_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("identity"), F.array("event_type", F.when(F.col("value") > 30, "loud").otherwise("quiet")).alias("tags"))
    return review.tag_counts(rows, "tags", "identity")


_VAR = "v AS (SELECT o_orderpriority AS ckpt, o_orderstatus AS cond, o_totalprice AS x, o_orderkey % 3 AS k FROM orders)"
_SIDES = ", ".join(f"round(avg(x) FILTER (WHERE {p}), 4) AS {n}_mean, round(stddev_pop(x) FILTER (WHERE {p}), 4) AS {n}_std, count(x) FILTER (WHERE {p}) AS {n}_n" for n, p in (("orig", "k = 0"), ("dn", "k = 1"), ("own", "k = 2 AND cond <> 'P'")))


@query("score_variants", f"WITH {_VAR} SELECT ckpt, cond, {_SIDES} FROM v GROUP BY 1, 2")
def score_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three variants of a score side by side by checkpoint and condition."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("ckpt"), F.col("o_orderstatus").alias("cond"), "o_totalprice", (F.col("o_orderkey") % 3).alias("k"))
    wide = experiments.side_by_side({"orig": o.where("k = 0"), "dn": o.where("k = 1"), "own": o.where("k = 2 and cond <> 'P'")}, "o_totalprice", "ckpt", "cond")
    return wide.withColumns({c: rounded(c, 4) for c in wide.columns if c.endswith(("_mean", "_std"))})


@query("paired_means", "SELECT l_returnflag AS grp, round(avg(l_discount), 6) AS mean_a, round(avg(l_tax), 6) AS mean_b, round(avg(l_tax - l_discount), 6) AS mean_delta, count(*) AS n FROM lineitem GROUP BY 1")
def paired_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = experiments.paired_means(table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "grp"), "l_discount", "l_tax", "grp")
    return found.withColumns({c: rounded(c, 6) for c in ("mean_a", "mean_b", "mean_delta")})


@query("most_negative", "WITH t AS (SELECT l_orderkey, l_linenumber, l_tax - l_discount AS delta FROM lineitem ORDER BY delta, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20) SELECT l_orderkey, l_linenumber, round(delta, 6) AS delta FROM t")
def most_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("delta", F.col("l_tax") - F.col("l_discount"))
    return selection.first_rows(rows, 20, "delta", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").select("l_orderkey", "l_linenumber", rounded("delta", 6).alias("delta"))


_MEANS = "m AS (SELECT o_custkey % 40 AS k, avg(CASE WHEN o_custkey % 40 <> 7 THEN o_totalprice END) AS mean, CASE WHEN o_custkey % 40 % 5 = 0 THEN 'dn' ELSE CAST(o_custkey % 40 AS VARCHAR) END AS ckpt FROM orders GROUP BY 1, 3)"


@query("ranked_means", f"WITH {_MEANS} SELECT k, round(mean, 4) AS mean, CAST(row_number() OVER (ORDER BY mean DESC NULLS LAST, k) AS INTEGER) AS place FROM m")
def ranked_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups by mean, best first and unmeasured ones last: a table of one row a group."""
    m = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 40).alias("k")).agg(F.avg(F.when(F.col("o_custkey") % 40 != 7, F.col("o_totalprice"))).alias("mean"))
    return selection.placed(m, F.desc_nulls_last("mean"), "k").withColumn("mean", rounded("mean", 4))


@query("numeric_order", f"WITH {_MEANS} SELECT k, ckpt, CAST(row_number() OVER (ORDER BY coalesce(TRY_CAST(ckpt AS INTEGER), 999), k) AS INTEGER) AS place FROM m")
def numeric_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoint names in the order of their numbers, others last."""
    k = F.col("o_custkey") % 40
    m = table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 5 == 0, "dn").otherwise(k.cast("string")).alias("ckpt")).distinct()
    return selection.placed(m, experiments.rank_text(F.col("ckpt")), "k")


@query("score_order", "SELECT l_returnflag, l_linenumber, l_orderkey, CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_linenumber, l_orderkey, l_partkey, l_suppkey) AS INTEGER) AS place FROM lineitem WHERE l_orderkey % 50 = 0")
def score_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where("l_orderkey % 50 = 0")
    return selection.placed(rows, "l_linenumber", "l_orderkey", "l_partkey", "l_suppkey", keys=("l_returnflag",)).select("l_returnflag", "l_linenumber", "l_orderkey", "place")


@query("event_crosstab", """SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS "view", count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'signup') AS signup, count(*) FILTER (WHERE event_type = 'error') AS error FROM events GROUP BY user_id""")
def event_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiments.crosstab(table(spark, sf_dir, "events"), "user_id", "event_type", ["view", "click", "signup", "error"])


@query("most_confused", "SELECT p_size % 4 AS actual, p_partkey % 4 AS predicted, count(*) AS n FROM part WHERE p_size % 4 <> p_partkey % 4 GROUP BY 1, 2 HAVING count(*) >= 5")
def most_confused(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select((F.col("p_size") % 4).alias("actual"), (F.col("p_partkey") % 4).alias("predicted"))
    return experiments.confused(rows, "actual", "predicted")


_SWEEP = [round(0.05 + 0.9 * i / 28, 6) for i in range(29)]


@query("multilabel_sweep", f"SELECT t AS threshold, round(avg(CAST((l_discount * 10 > t) = (l_returnflag = 'R') AS INTEGER)), 8) AS accuracy FROM lineitem, (SELECT unnest(CAST({_SWEEP} AS DOUBLE[])) AS t) GROUP BY t")
def multilabel_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy at 29 thresholds in one pass."""
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_discount") * 10).alias("score"), (F.col("l_returnflag") == "R").alias("truth"))
    return experiments.accuracy_sweep(rows, "score", "truth", _SWEEP).withColumn("accuracy", rounded("accuracy", 8))


@query("normalised_values", "SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - avg(l_quantity) OVER w) / stddev_pop(l_quantity) OVER w, 6) AS z FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)")
def normalised_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
    return experiments.normalised(rows, "l_quantity", "l_returnflag").select("l_orderkey", "l_linenumber", "l_partkey", rounded("z", 6).alias("z"))


@query(
    "softmax_nll",
    """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, [l_discount * 10, l_tax * 10, l_quantity / 50.0] AS x, l_linenumber % 3 AS y FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round(ln(list_sum(list_transform(x, lambda v: exp(v - list_max(x))))) + list_max(x) - x[y + 1], 6) AS nll, round(exp(x[1] - list_max(x)) / list_sum(list_transform(x, lambda v: exp(v - list_max(x)))), 6) AS p0 FROM s""",
)
def softmax_nll(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_discount") * 10).alias("a"), (F.col("l_tax") * 10).alias("b"), (F.col("l_quantity") / 50.0).alias("c"), (F.col("l_linenumber") % 3).alias("y")
    )
    scored = experiments.class_scores(rows, ["a", "b", "c"], "y")
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", rounded("nll", 6).alias("nll"), rounded(F.get("probabilities", F.lit(0)), 6).alias("p0"))
