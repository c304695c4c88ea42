"""Queries over embeddings, labels and the experiment facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwise.functions import text as T
from clipwise.functions import vectors as V
from clipwise.functions.numbers import rounded
from clipwise.operators import experiments, gates, review, sampling

from .base import hinted, query, table

_VEC = "v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"
_CENTROID = f"""{_VEC},
m AS (SELECT label, i, avg(x[i]) AS a FROM (SELECT label, x, unnest(range(1, len(x) + 1)) AS i FROM v) GROUP BY label, i),
c AS (SELECT label, list(a ORDER BY i) AS c FROM m GROUP BY label),
k AS (SELECT v.vec_id, v.label, c.label AS speaker, list_inner_product(v.x, c.c) / (sqrt(list_inner_product(v.x, v.x)) * sqrt(list_inner_product(c.c, c.c))) AS cos FROM v, c)"""


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", V.doubles(F.col("embedding")).alias("x"))


@query("centroid_cosine", f"WITH {_CENTROID} SELECT vec_id, label, round(cos, 6) AS cos FROM k WHERE label = speaker")
def centroid_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    own = V.centroid(vectors, "x", "label")
    return vectors.join(hinted(own), "label").select("vec_id", "label", rounded(V.cosine(F.col("x"), F.col("centroid")), 6).alias("cos"))


@query(
    "cluster_vote",
    f"""WITH {_CENTROID}, s AS (SELECT label, speaker, avg(cos) AS cos FROM k GROUP BY label, speaker),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY cos DESC, speaker) AS n FROM s),
w AS (SELECT label, max(CASE WHEN n = 1 THEN speaker END) AS winner, max(CASE WHEN n = 1 THEN cos END) AS c1, max(CASE WHEN n = 2 THEN cos END) AS c2 FROM r GROUP BY label)
SELECT label, winner, round(c1, 6) AS cos, round(c1 - coalesce(c2, 0), 6) AS margin, array_to_string(list_filter([CASE WHEN c1 < 0.4 THEN 'low_cosine' END, CASE WHEN c1 - coalesce(c2, 0) < 0.1 THEN 'low_margin' END, CASE WHEN winner <> label THEN 'cosine!=label' END], lambda x: x IS NOT NULL), ';') AS flags FROM w""",
)
def cluster_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each cluster the best matching centroid by mean cosine, the margin to the next one, and flags.

    The mean cosine of a cluster's vectors with a centroid is that of the mean of their unit vectors, so
    the vectors are aggregated once, and only clusters meet centroids: a table of labels by labels.
    """
    vectors = _vectors(spark, sf_dir)
    centroids = V.centroid(vectors, "x", "label").select(F.col("label").alias("speaker"), "centroid")
    own = V.mean(vectors.withColumn("u", V.unit(F.col("x"))), "u", "label")
    means = experiments.job_matrix(own, centroids).select("label", "speaker", V.dot(F.col("mean"), F.col("centroid")).alias("cos"))
    ranked = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("cos", (-F.col("speaker")).alias("neg"))), False).alias("r"))
    c1, c2 = F.col("r")[0]["cos"], F.coalesce(F.get("r", F.lit(1))["cos"], F.lit(0.0))
    winner = -F.col("r")[0]["neg"]
    flags = T.reasons((c1 < 0.4, F.lit("low_cosine")), (c1 - c2 < 0.1, F.lit("low_margin")), (winner != F.col("label"), F.lit("cosine!=label")))
    return ranked.select("label", winner.alias("winner"), rounded(c1, 6).alias("cos"), rounded(c1 - c2, 6).alias("margin"), F.array_join(flags, ";").alias("flags"))


@query(
    "nearest_neighbour",
    f"""WITH {_VEC}, q AS (SELECT * FROM v WHERE vec_id % 20 = 0),
s AS (SELECT q.vec_id, v.vec_id AS neighbour, list_inner_product(q.x, v.x) / (sqrt(list_inner_product(q.x, q.x)) * sqrt(list_inner_product(v.x, v.x))) AS cos FROM q, v WHERE q.vec_id <> v.vec_id)
SELECT vec_id, arg_max(neighbour, row(round(cos, 9), -neighbour)) AS neighbour, round(max(cos), 6) AS cos FROM s GROUP BY vec_id""",
)
def nearest_neighbour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest other vector of every vector whose id is divisible by 20, over all rows."""
    v = _vectors(spark, sf_dir).select("vec_id", "x")
    found = V.nearest(v, v.where("vec_id % 20 = 0"), "vec_id", "x")
    return found.select(F.col("query").alias("vec_id"), "neighbour", rounded("cos", 6).alias("cos"))


_LABELLED = """l AS (SELECT d.doc_id, d.source, d.lang, CAST(d.n_chars AS DOUBLE) AS chars, CAST(length(d.text) AS DOUBLE) AS n, CAST(len(regexp_extract_all(d.text, '[.?!]')) AS DOUBLE) AS stops,
       round(length(regexp_replace(d.text, '[^ ]', '', 'g')) / CAST(greatest(length(d.text), 1) AS DOUBLE), 6) AS blanks, lb.quality = 0 AS is_cut
       FROM documents d JOIN labels lb USING (doc_id))"""


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n = F.length("text")
    measured = docs.select(
        "doc_id",
        "source",
        "lang",
        F.col("n_chars").cast("double").alias("chars"),
        n.cast("double").alias("n"),
        F.size(F.regexp_extract_all("text", F.lit("[.?!]"), F.lit(0))).cast("double").alias("stops"),
        rounded(F.length(F.regexp_replace("text", "[^ ]", "")) / F.greatest(n, F.lit(1)).cast("double"), 6).alias("blanks"),
    )
    return measured.join(table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 0).alias("is_cut")), "doc_id")


@query(
    "metric_percentiles",
    f"""WITH {_LABELLED}, r AS (SELECT *, row_number() OVER (PARTITION BY is_cut ORDER BY n) - 1 AS i, count(*) OVER (PARTITION BY is_cut) AS c FROM l)
SELECT is_cut, round(quantile_cont(n, 0.1), 6) AS lin10, round(median(n), 6) AS mid, round(quantile_cont(n, 0.9), 6) AS lin90,
 max(CASE WHEN i = least(c - 1, CAST(floor(0.1 * c) AS BIGINT)) THEN n END) AS p10, max(CASE WHEN i = least(c - 1, CAST(floor(0.5 * c) AS BIGINT)) THEN n END) AS p50 FROM r GROUP BY is_cut""",
)
def metric_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = _labelled(spark, sf_dir)
    linear = gates.linear_percentile(l, "n", {"lin10": 0.1, "mid": 0.5, "lin90": 0.9}, "is_cut")
    linear = linear.withColumns({c: rounded(c, 6) for c in ("lin10", "mid", "lin90")})
    return linear.join(gates.floor_percentile(l, "n", (0.1, 0.5), "is_cut"), "is_cut")


_SWEEP = f"""{_LABELLED},
u AS (SELECT 'blanks' AS metric, blanks AS x, is_cut FROM l UNION ALL SELECT 'stops', stops, is_cut FROM l),
g AS (SELECT metric, x, count(*) FILTER (WHERE is_cut) AS cuts, count(*) FILTER (WHERE NOT is_cut) AS keeps FROM u GROUP BY metric, x),
sw AS (SELECT metric, '>=' AS direction, x AS threshold, CAST(sum(cuts) OVER d AS BIGINT) AS caught, CAST(sum(keeps) OVER d AS BIGINT) AS flagged FROM g WINDOW d AS (PARTITION BY metric ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  UNION ALL SELECT metric, '<=', x, CAST(sum(cuts) OVER a AS BIGINT), CAST(sum(keeps) OVER a AS BIGINT) FROM g WINDOW a AS (PARTITION BY metric ORDER BY x ROWS UNBOUNDED PRECEDING))"""


def _sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.threshold_sweep(_labelled(spark, sf_dir).select("blanks", "stops", "is_cut"), ["blanks", "stops"])


@query("threshold_sweep", f"WITH {_SWEEP} SELECT * FROM sw")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sweep(spark, sf_dir)


@query("best_gate", f"WITH {_SWEEP} SELECT metric, direction, threshold, caught, flagged, caught - flagged AS net FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY caught - flagged DESC, caught DESC, direction, threshold) AS k FROM sw) WHERE k = 1")
def best_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.best_gates(_sweep(spark, sf_dir))


@query("gate_frontier", f"WITH {_SWEEP} SELECT metric, c AS at_least, min(flagged) AS flagged FROM sw, (SELECT unnest([5, 10, 20]) AS c) WHERE caught >= c GROUP BY metric, c")
def gate_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fewest keeps flagged by a gate that catches at least so many cuts."""
    steps = _sweep(spark, sf_dir).withColumn("at_least", F.explode(F.array(F.lit(5), F.lit(10), F.lit(20))))
    return steps.where("caught >= at_least").groupBy("metric", "at_least").agg(F.min("flagged").alias("flagged"))


_ATOMS = {"few_blanks": "blanks < 0.12", "many_stops": "stops > 60", "not_english": "lang <> 'en'", "short": "n < 300"}
_PAIR = " UNION ALL ".join(
    f"SELECT '{a}' AS atom_a, '{b}' AS atom_b, count(*) FILTER (WHERE is_cut AND (({_ATOMS[a]}) OR ({_ATOMS[b]}))) AS caught, count(*) FILTER (WHERE NOT is_cut AND (({_ATOMS[a]}) OR ({_ATOMS[b]}))) AS flagged FROM l"
    for i, a in enumerate(sorted(_ATOMS))
    for b in sorted(_ATOMS)[i + 1 :]
)


@query("or_gate_pairs", f"WITH {_LABELLED} {_PAIR}")
def or_gate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.or_pairs(_labelled(spark, sf_dir), _ATOMS)


_GATES = {"dense": "blanks >= 0.12", "english": "lang = 'en'", "sized": "n BETWEEN 300 AND 20000", "strict": "blanks >= 0.12 AND lang = 'en' AND n BETWEEN 300 AND 20000"}
_CONF = " UNION ALL ".join(
    f"""SELECT '{g}' AS gate, count(*) FILTER (WHERE {p}) AS kept, count(*) FILTER (WHERE ({p}) AND is_cut) AS leak, count(*) FILTER (WHERE NOT ({p}) AND is_cut) AS caught,
 count(*) FILTER (WHERE NOT ({p}) AND NOT is_cut) AS suspects, round(count(*) FILTER (WHERE {p}) / CAST(count(*) AS DOUBLE), 6) AS yield FROM l"""
    for g, p in _GATES.items()
)


@query("gate_confusion", f"WITH {_LABELLED} {_CONF}")
def gate_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.confusion(_labelled(spark, sf_dir), _GATES).withColumn("yield", rounded("yield", 6))


@query("class_gap", f"WITH {_LABELLED} SELECT max(CASE WHEN NOT is_cut THEN blanks END) AS max_keep, min(CASE WHEN is_cut THEN blanks END) AS min_cut FROM l")
def class_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.class_gap(_labelled(spark, sf_dir), "blanks")


@query("yield_projection", f"WITH {_LABELLED}, c AS (SELECT count(*) FILTER (WHERE blanks >= 0.12) AS k, count(*) AS n FROM l) SELECT round(k / CAST(n AS DOUBLE), 6) AS share, CAST(ceil(10000 / (k / CAST(n AS DOUBLE))) AS BIGINT) AS needed FROM c")
def yield_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _labelled(spark, sf_dir).agg(F.count_if(F.col("blanks") >= 0.12).alias("k"), F.count("*").alias("n"))
    return one.select(gates.projection(F.col("k"), F.col("n"), 10000).alias("p")).select(rounded("p.share", 6).alias("share"), "p.needed")


@query("ckpt_summary", "SELECT o_orderpriority AS ckpt, o_orderstatus AS cond, round(avg(o_totalprice), 4) AS mean, round(stddev_pop(o_totalprice), 4) AS std, count(o_totalprice) AS n FROM orders GROUP BY 1, 2")
def ckpt_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("ckpt"), F.col("o_orderstatus").alias("cond"), "o_totalprice")
    return experiments.summary(facts, "o_totalprice", "ckpt", "cond").withColumns({"mean": rounded("mean", 4), "std": rounded("std", 4)})


@query("ckpt_pivot", """SELECT o_orderpriority AS ckpt, round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 4) AS "F", round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 4) AS "O", round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 4) AS "P" FROM orders GROUP BY 1""")
def ckpt_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = experiments.pivoted(table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "ckpt"), "o_totalprice", "ckpt", "o_orderstatus", ["F", "O", "P"])
    return wide.select("ckpt", *[rounded(c, 4).alias(c) for c in ("F", "O", "P")])


_CELL = "c AS (SELECT l_returnflag AS grp, l_linenumber AS step, avg(l_extendedprice) AS mean FROM lineitem GROUP BY 1, 2)"


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("grp"), F.col("l_linenumber").alias("step")).agg(F.avg("l_extendedprice").alias("mean"))


@query("best_per_group", f"WITH {_CELL} SELECT grp, step, round(mean, 4) AS mean FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY mean DESC, step) AS k FROM c) WHERE k = 1")
def best_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiments.best_per_group(_cells(spark, sf_dir), "grp", "mean", "step").withColumn("mean", rounded("mean", 4))


@query("curve_slope", f"WITH {_CELL}, d AS (SELECT *, mean - lag(mean) OVER (PARTITION BY grp ORDER BY step) AS delta FROM c) SELECT grp, step, round(mean, 4) AS mean, round(delta, 4) AS delta, coalesce(delta > 0.01, FALSE) AS rising FROM d")
def curve_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = experiments.slopes(_cells(spark, sf_dir), "mean", "step", keys=("grp",))
    return found.withColumns({"mean": rounded("mean", 4), "delta": rounded("delta", 4)})


_PAIRED = "p AS (SELECT a.l_returnflag AS grp, b.l_discount - a.l_discount AS d FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)"


def _paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("k"), F.col("l_returnflag").alias("grp"), F.col("l_discount").alias("x"))
    b = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("k"), F.col("l_discount").alias("y"))
    return a.join(b, ["l_orderkey", "k"]).select("grp", (F.col("y") - F.col("x")).alias("d"))


@query("paired_delta_buckets", f"WITH {_PAIRED} SELECT grp, count(*) FILTER (WHERE d < -0.05) AS worse, count(*) FILTER (WHERE d >= -0.05 AND d < -0.02) AS slightly_worse, count(*) FILTER (WHERE d >= -0.02) AS kept, count(*) FILTER (WHERE d >= 0) AS better, round(avg(d), 8) AS mean_delta FROM p GROUP BY grp")
def paired_delta_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiments.delta_buckets(_paired(spark, sf_dir), "d", "grp").withColumn("mean_delta", rounded("mean_delta", 8))


@query("favoured_side", f"WITH {_PAIRED} SELECT CASE WHEN d > 0.01 THEN 'a' WHEN d < -0.01 THEN 'b' ELSE 'tie' END AS side, count(*) AS n FROM p GROUP BY 1")
def favoured_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paired(spark, sf_dir).groupBy(experiments.favoured(F.col("d")).alias("side")).agg(F.count("*").alias("n"))


@query("job_matrix", "SELECT r_name AS ckpt, n_name AS sent, s AS seed FROM region, nation, (SELECT unnest([1, 2, 3]) AS s)")
def job_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = spark.range(1, 4).select(F.col("id").cast("int").alias("seed"))
    return experiments.job_matrix(table(spark, sf_dir, "region").select(F.col("r_name").alias("ckpt")), table(spark, sf_dir, "nation").select(F.col("n_name").alias("sent")), seeds)


@query("resume_antijoin", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return experiments.pending(table(spark, sf_dir, "orders").select("o_orderkey"), done, "o_orderkey")


_SPLIT = """g AS (SELECT source, row_number() OVER (ORDER BY md5('s1:' || source), source) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM documents)),
sp AS (SELECT d.doc_id, d.source, CASE WHEN g.k <= greatest(least(3, g.n - 1), 1) THEN 'val' ELSE 'train' END AS split FROM documents d JOIN g USING (source))"""


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.group_split(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", 3, "s1")


@query("group_split", f"WITH {_SPLIT} SELECT * FROM sp")
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("doc_id", "source", "split")


@query("leakage_check", f"WITH {_SPLIT} SELECT (SELECT count(*) FROM (SELECT source FROM sp GROUP BY source HAVING count(DISTINCT split) > 1)) AS leaked, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val FROM sp")
def leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _split(spark, sf_dir)
    counts = s.agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val").alias("val"))
    return sampling.leaked(s, "source").agg(F.count("*").alias("leaked")).crossJoin(counts)


@query("set_equality", "SELECT (SELECT count(*) FROM (SELECT doc_id FROM labels WHERE quality = 0 EXCEPT SELECT doc_id FROM labels WHERE toxic = 1)) AS only_cut, (SELECT count(*) FROM (SELECT doc_id FROM labels WHERE toxic = 1 EXCEPT SELECT doc_id FROM labels WHERE quality = 0)) AS only_toxic, (SELECT count(*) FROM (SELECT doc_id FROM labels WHERE toxic = 1 INTERSECT SELECT doc_id FROM labels WHERE quality = 0)) AS both")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences and intersection of two id sets in one aggregation instead of three set operations."""
    sides = table(spark, sf_dir, "labels").where("quality = 0 OR toxic = 1").groupBy("doc_id").agg(F.max((F.col("quality") == 0).cast("int")).alias("a"), F.max((F.col("toxic") == 1).cast("int")).alias("b"))
    a, b = F.col("a") == 1, F.col("b") == 1
    return sides.agg(F.count_if(a & ~b).alias("only_cut"), F.count_if(~a & b).alias("only_toxic"), F.count_if(a & b).alias("both"))


@query(
    "ref_injection",
    """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('s2:' || doc_id), doc_id) AS a, count(*) OVER (PARTITION BY source) AS n,
 coalesce(lead(doc_id) OVER (PARTITION BY source ORDER BY md5('s2/ref:' || doc_id), doc_id), first_value(doc_id) OVER (PARTITION BY source ORDER BY md5('s2/ref:' || doc_id), doc_id)) AS nx FROM documents)
SELECT doc_id, source, CASE WHEN n > 1 AND a <= round(n * 0.4) THEN nx END AS ref FROM r""",
)
def ref_injection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.inject_references(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", "source", 0.4, "s2")


@query("bernoulli_refs", "SELECT doc_id FROM documents WHERE CAST(('0x' || substr(md5('s3:' || doc_id), 1, 8)) AS BIGINT) / 4294967296.0 < 0.4")
def bernoulli_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(sampling.fraction("s3", F.col("doc_id")) < 0.4).select("doc_id")


@query("nested_subsets", "SELECT doc_id, lang, CAST(k AS INTEGER) AS place, CASE WHEN k <= 35 THEN 35 WHEN k <= 70 THEN 70 WHEN k <= 105 THEN 105 END AS subset FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('s4:' || doc_id), doc_id) AS k FROM documents)")
def nested_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.nested(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "lang", [35, 70, 105], "s4")


@query("blind_slots", "SELECT conv_id AS test, turn AS item, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY md5('s5:' || conv_id || ':' || turn), turn) AS INTEGER) AS slot FROM conversations")
def blind_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.slots(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("test"), F.col("turn").alias("item")), "test", "item", "s5")


_REVIEW = """r AS (SELECT d.doc_id, d.source, CASE WHEN d.n_chars >= 300 THEN 'keep' ELSE 'cut' END AS gate, CASE WHEN lb.quality = 1 THEN 'keep' WHEN lb.quality = 0 THEN 'cut' END AS saved FROM documents d LEFT JOIN labels lb USING (doc_id))"""


@query("review_progress", f"WITH {_REVIEW} SELECT source, count(*) AS n, count(saved) AS reviewed, count(*) FILTER (WHERE coalesce(saved, gate) = 'keep') AS kept, count(*) FILTER (WHERE saved <> gate) AS overridden FROM r GROUP BY source")
def review_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("n_chars") >= 300, "PASS").otherwise("FAIL").alias("status"))
    saved = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "keep").when(F.col("quality") == 0, "cut").alias("decision"))
    return review.progress(review.decisions(report, saved, "doc_id"), "source")


@query("blind_ratings", "SELECT event_type AS identity, round(avg(CASE WHEN k > 0 THEN k END), 6) AS mean_rating, count(CASE WHEN k > 0 THEN 1 END) AS n_rated FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 6 AS k FROM events) GROUP BY 1")
def blind_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = table(spark, sf_dir, "events").select(F.col("event_type").alias("identity"), (F.get_json_object("props", "$.k").cast("bigint") % 6).alias("rating"))
    return review.ratings(rated, "identity").withColumn("mean_rating", rounded("mean_rating", 6))


@query("abx_accuracy", "SELECT user_id % 10 AS listener, round(avg(CASE WHEN event_type <> 'error' THEN CAST(value > 30 AS INTEGER) END), 6) AS accuracy, count(CASE WHEN event_type <> 'error' THEN 1 END) AS n_answered, coalesce(avg(CASE WHEN event_type <> 'error' THEN CAST(value > 30 AS INTEGER) END) < 0.65, TRUE) AS at_chance FROM events GROUP BY 1")
def abx_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("listener"), F.when(F.col("event_type") != "error", F.col("value") > 30).alias("correct"))
    return review.abx(answered, "listener").withColumn("accuracy", rounded("accuracy", 6))


@query("recommended_identity", "WITH m AS (SELECT o_orderpriority AS identity, avg(o_totalprice) AS r FROM orders GROUP BY 1), b AS (SELECT arg_max(identity, row(r, identity)) AS identity, max(r) AS r FROM m WHERE identity <> '1-URGENT') SELECT b.identity, round(b.r, 4) AS mean_rating, coalesce((SELECT r FROM m WHERE identity = '1-URGENT') >= b.r - 0.25, FALSE) AS warn FROM b")
def recommended_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("identity")).agg(F.avg("o_totalprice").alias("mean_rating"))
    return review.recommended(means, "1-URGENT").withColumn("mean_rating", rounded("mean_rating", 4))


@query("answer_key", "SELECT r_regionkey AS test, slot, r_name || '-' || slot AS identity FROM region, (SELECT unnest(['a', 'b', 'c']) AS slot)")
def answer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = F.to_json(F.map_from_arrays(F.array(*map(F.lit, "abc")), F.array(*[F.concat("r_name", F.lit(f"-{s}")) for s in "abc"])))
    sealed = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("test"), F.base64(keys.cast("binary")).alias("key"))
    return review.decoded_key(sealed, "key")


@query("top_customers", "SELECT o_custkey, n, total FROM (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS k FROM orders GROUP BY 1) WHERE k <= 1000")
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), rounded(F.sum("o_totalprice"), 2).alias("total"))
    return counts.orderBy(F.desc("n"), "o_custkey").limit(1000)


@query("crosstab", """SELECT n_name, count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS automobile, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building, round(avg(c_acctbal), 4) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "customer").join(hinted(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count_if(F.col("c_mktsegment") == "AUTOMOBILE").alias("automobile"), F.count_if(F.col("c_mktsegment") == "BUILDING").alias("building"), rounded(F.avg("c_acctbal"), 4).alias("balance"))


@query("confusion_matrix", "SELECT quality AS actual, CAST(n_chars >= 1000 AS INTEGER) AS predicted, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    return joined.groupBy(F.col("quality").alias("actual"), (F.col("n_chars") >= 1000).cast("int").alias("predicted")).agg(F.count("*").alias("n"))


@query("seed_collections", "SELECT r_name, string_agg(n_name, ';' ORDER BY n_name) AS nations, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def seed_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "nation").join(hinted(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ";").alias("nations"), F.count("*").alias("n"))
