"""Rounding, order and growth: small inputs on which queries differed from their SQL or grew out of proportion."""

import __spark_entry__ as entry
import duckdb
import numpy as np
import pyarrow as pa
from clipwise.functions.numbers import rounded, rounded_column, written
from clipwise.llm import jaccard
from clipwise.llm.common import arrow_rows
from clipwise.operators import experiments, gates, timeline
from pyspark.sql import functions as F


def same_as_sql(spark, folder, name, **tables):
    """The query over tables (name to DataFrame) gives what its SQL does, read by one thread."""
    db = duckdb.connect()
    db.execute("SET threads = 1")
    for table, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    out = entry.queries()[name](spark, str(folder))
    found = db.execute(f"SELECT {', '.join(out.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, out.collect()), key=str) == sorted(found, key=str)


def test_numbers_go_by_their_binary_value(spark):
    xs = [0.125, 0.075, 1.625, -2.675, 0.375, 2.56125, 0.005, -51.0, 9.995, None]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", written("%s", "x").alias("w"), rounded("x", 4).alias("r")).collect()
    assert [r.w for r in rows][:-1] == ["%.2f" % x for x in xs[:-1]]
    assert {r.x: r.r for r in rows}[2.56125] == 2.5612 and rows[-1].r is None


def test_doc_gate_report_of_ties(spark, tmp_path):
    texts = [" ".join(["ab"] * 6 + ["é" * 2]), " ".join(["a" * 7] * 12 + ["b" * 24]), "x" * 37 + " é é é"]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)] + [(9, " ".join(["abcd"] * 682) + " " + "e" * 590, "en", "src0", 4000)], "doc_id long, text string, lang string, source string, n_chars long")
    same_as_sql(spark, tmp_path, "doc_gate_report", documents=docs)


def events(spark, n, lectures):
    ts = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)")
    kind = F.element_at(F.array(*map(F.lit, ["view", "click", "purchase", "error", "signup"])), (F.pmod(F.xxhash64("id"), F.lit(5)) + 1).cast("int"))
    rows = spark.range(n, numPartitions=1).select(F.col("id").alias("event_id"), ts.alias("ts"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(lectures)).alias("user_id"), kind.alias("event_type"))
    return rows.withColumn("value", F.pmod(F.xxhash64("event_id", F.lit(2)), F.lit(49000)).cast("double") / 100)


def test_lecture_flags_add_up_in_order(spark, tmp_path):
    rows = events(spark, 100_000, 3000)
    same_as_sql(spark, tmp_path / "one", "lecture_flags", events=rows)
    rows.repartition(7).write.parquet(f"{tmp_path}/many/events.parquet")
    flags = [sorted(map(tuple, entry.queries()["lecture_flags"](spark, f"{tmp_path}/{d}").collect())) for d in ("one", "many")]
    assert flags[0] == flags[1]


def test_gate_reasons_of_ties(spark):
    row = spark.range(1).select(F.lit(True).alias("has_wav"), F.lit(-60.125).alias("align_min"), F.lit(0.875).alias("lead"), F.lit(1.125).alias("trail"), F.lit(0.90625).alias("cer_core"))
    reasons = row.select(gates.production_reasons({**gates.PRODUCTION, "min_align": -50.0})).first()[0]
    assert reasons == ["low_align(-60.12)", "lead_sil(0.88)", "trail_sil(1.12)", "high_cer_core(0.91)"]


def test_interpolated_grid_reads_each_row_once(spark, tmp_path):
    rows = events(spark, 3000, 2).where("event_id % 7 <> 0")
    same_as_sql(spark, tmp_path, "interpolated_grid", events=rows)
    plan = entry.queries()["interpolated_grid"](spark, str(tmp_path))._jdf.queryExecution().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan


def test_interpolated_grid_is_not_dealt(spark, tmp_path):
    rows = events(spark, 300, 4).withColumn("event_id", F.col("event_id") * 1900 + F.col("event_id") % 3 * 50).withColumn("user_id", F.when(F.col("user_id") < 3, F.col("user_id")))
    same_as_sql(spark, tmp_path, "interpolated_grid", events=rows)
    out = entry.queries()["interpolated_grid"](spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")
    assert out.count() > 5 * rows.where("user_id IS NOT NULL").count() / 2


def test_interpolated_every_is_interpolated(spark):
    xs = {"a": [(-12.0, 1.5), (-10.0, None), (3.0, -4.0), (20.0, 7.0), (21.0, None), (25.0, 2.0), (57.0, None)], "b": [(-31.0, None), (4.0, None), (5.0, 8.0)], "c": [(7.0, None), (40.0, None)], "d": [(30.0, 3.25)], "e": [(None, 1.0)]}
    points = spark.createDataFrame([(k, x, y) for k, ps in xs.items() for x, y in ps], "lecture string, x double, y double")
    grid = spark.createDataFrame([(k, float(g)) for k, lo, hi in (("a", -20, 60), ("b", -40, 10), ("c", 0, 40), ("d", 30, 30)) for g in range(lo, hi + 1, 10)], "lecture string, x double")
    expected, found = (sorted(map(tuple, df.collect())) for df in (timeline.interpolated(grid, points.where("x IS NOT NULL"), "x", "y"), timeline.interpolated_every(points, 10, "x", "y")))
    assert found == expected and len(found) == 21


def test_rounded_columns_are_rounded(spark, tmp_path):
    rng = np.random.default_rng(3)
    whole = rng.integers(-(10**9), 10**9, 20_000) / 2e6
    xs = [0.0, -0.0, 5e-7, -5e-7, 4.9999999999999993e-7, 0.4999999999999999e-6, 1.0000005, 2251799813.6852475, 4503599627.370496, 4503599627.3704965, 9007199254.740993, 1e15, -1e22, 1e283, 1e290, -1e300, float("inf"), float("-inf"), float("nan"), None]
    xs += [*map(float, whole), *map(float, np.nextafter(whole, 1e9)), *map(float, np.nextafter(whole, -1e9)), *map(float, rng.normal(size=20_000) * 10.0 ** rng.integers(-12, 20, 20_000))]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select(rounded("x", 6).alias("r"), rounded_column("x", 6).alias("c"))
    assert all(repr(r) == repr(c) for r, c in df.collect())
    same_as_sql(spark, tmp_path, "interpolated_grid", events=events(spark, 3000, 2).withColumn("value", -F.col("value") / 7))
    assert "transform(" not in entry.queries()["interpolated_grid"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


def test_normalised_values_stay_where_they_are(spark, tmp_path):
    rows = spark.range(4000).select((F.col("id") / 4).cast("long").alias("l_orderkey"), (F.col("id") % 4).cast("int").alias("l_linenumber"), (F.col("id") % 97).alias("l_partkey"), F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"), (F.col("id") % 50 + 1).cast("double").alias("l_quantity"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        same_as_sql(spark, tmp_path, "normalised_values", lineitem=rows)
        plan = entry.queries()["normalised_values"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(l_returnflag" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    many = experiments.normalised(rows, "l_quantity", "l_returnflag", few=1)
    assert many.count() == 4000


def test_chance_overlaps_make_no_cluster(spark):
    """Each text shares one passage with the next one, and only the last two link; all were one cluster before."""
    word = lambda i, j: f"w{i}x{j}"
    shared = lambda i: [f"s{i}y{j}" for j in range(5)]
    texts = [" ".join(shared(i) + [word(i, j) for j in range(40)] + shared(i + 1)) for i in range(60)]
    texts += [" ".join(f"z{j}" for j in range(60)), " ".join(f"z{j}" for j in range(58))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with arrow_rows(spark, 2_000):
        sets, _ = jaccard.clustered_sets(docs, 5, 80)
        assert sorted(r.node for r in sets.collect()) == [60, 61]
    found = {r.doc_id: r.component_id for r in jaccard.components(docs, width=5, percent=80).collect()}
    assert found == {i: min(i, 60) for i in range(62)}


def test_pairs_of_signatures(spark):
    rng = np.random.default_rng(3)
    for most in (1, 2, 5):
        for n in (1, 7, 60, 200):
            sig, node, heavy = np.sort(rng.integers(0, 20, n)), rng.integers(0, 50, n), rng.random(n) < 0.05
            whole = pa.record_batch([pa.array(sig), pa.array(node), pa.nulls(n, pa.int64()), pa.array(heavy)], ["sig", "node", "lead", "heavy"])
            found = {(r["a"], r["b"], r["sure"]) for b in jaccard._stars(iter([whole.slice(k, 9) for k in range(0, n, 9)]), most) for r in b.to_pylist()}
            want = set()
            for s in set(sig.tolist()):
                own, sure = node[sig == s].tolist(), bool((sig == s).sum() > most or heavy[sig == s].any())
                want |= {(min(x, y), max(x, y), sure) for x in (own[:1] if sure else own) for y in own if x != y}
            assert found == want


def test_bitmaps_lose_no_link():
    rng = np.random.default_rng(5)
    kept = linked = 0
    for size in (1, 5, 63, 64, 65, 500, 1100):
        for lost in (0, 1, size // 12, size // 8, size // 5, size // 2):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            b = np.unique(np.concatenate([a[: len(a) - lost], rng.integers(0, 2**63, lost // 3 + 1).astype(np.uint64)]))
            for x, y in ((a, b), (b, a)):
                fits = jaccard.linked(len(x), len(y), len(np.intersect1d(x, y)), 80)
                may = jaccard.may_link(np.array([len(x)]), [jaccard.bitmap(x)], np.array([len(y)]), [jaccard.bitmap(y)], 80)[0]
                assert may or not fits
                kept, linked = kept + may, linked + fits
    assert linked <= kept < 70


def test_sentences_are_judged_in_their_rows(spark, tmp_path):
    texts = ["The cat sat. It's on the [Gita 2] mat? Zzz yyy xxx www vvv uuu ttt sss!", "The cat sat on the mat. [verse] qqq aaa bbb ccc the the the the the", None, "", "the cat 12. é-é ’x"]
    rows = [(i, texts[i % 5], "fr" if i == 4 else "en", "src0", 0) for i in range(35)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    same_as_sql(spark, tmp_path / "unique", "sentence_kinds", documents=spark.createDataFrame(rows, schema))
    plan = entry.queries()["sentence_kinds"](spark, f"{tmp_path}/unique")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    same_as_sql(spark, tmp_path / "repeated", "sentence_kinds", documents=spark.createDataFrame([*rows, (1, "the cat zzz. dog the", "en", "src0", 0)], schema))


def test_blocks_of_spans_are_numbers(spark):
    rng = np.random.default_rng(7)
    spans = [[(1, i, float(a), float(a + d)) for i, (a, d) in enumerate(zip(rng.integers(-300, 300, 80), rng.integers(0, 90, 80), strict=True))] for _ in range(2)]
    l, r = (spark.createDataFrame(s, f"lecture long, {n} long, {n}0 double, {n}1 double") for s, n in zip(spans, "lr", strict=True))
    met = timeline.range_join(l, r, ("l0", "l1"), ("r0", "r1"), (F.col("l0") <= F.col("r1")) & (F.col("r0") <= F.col("l1")), 8.0)
    assert "shiftleft" in met._jdf.queryExecution().optimizedPlan().toString().lower()
    want = sorted((i, j) for _, i, a, b in spans[0] for _, j, c, d in spans[1] if a <= d and c <= b)
    assert sorted((x.l, x.r) for x in met.collect()) == want


def test_zeros_keep_their_sign_as_in_sql(spark):
    xs = [-0.001, -1e-15, -0.0, 0.0, 0.004, -0.005, 0.005, -0.25, -1e300, None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select("i", rounded("x", 2).alias("r")).collect()
    db = duckdb.connect()
    want = [db.execute("SELECT round(?::DOUBLE, 2)", [x]).fetchone()[0] for x in xs]
    assert [str(r.r) for r in sorted(rows)] == [str(x) for x in want]
