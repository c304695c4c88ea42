"""Selections, gates, tracks, stages, sources and signal helpers on small inputs worked out by hand or by brute force."""

import http.server
import itertools
import random
import sys
import threading

import numpy as np
import pytest
from clipwise.functions import edits, signal
from clipwise.functions import text as T
from clipwise.functions import vectors as V
from clipwise.operators import experiments, gates, review, sampling, selection, stages, timeline
from clipwise.sources import files, io, web
from clipwise.streaming.windows import sessions
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_entities_and_blanks(spark):
    r = one(spark, T.unescape(F.lit("&#233;&#x1F600;&eacute;&amp;lt;&#0;&#xD800; &nbsp;")).alias("a"), T.strip(F.lit("  a  b\xa0 ")).alias("b"), T.unescape(F.lit("a & b")).alias("c"))
    assert (r.a, r.b, r.c) == ("é😀é&lt;\ufffd\ufffd \xa0", "a  b", "a & b")
    blanks = spark.createDataFrame([("x" + " " * 200_000 + "y",)], "t string")
    assert blanks.select(F.length(T.strip(F.col("t")))).first()[0] == 200_002


def test_words_and_ratios(spark):
    r = one(spark, T.diacritic_ratio(F.lit("Kṛṣṇa isn't here māyā")).alias("a"), T.without_words(F.lit(" The cat the  Dog "), ["the"]).alias("b"), T.is_ascii(F.lit("aé")).alias("c"), selection.parsed_ids(F.lit("1,5 9, x")).alias("d"))
    assert (r.a, r.b, r.c, r.d) == (0.75, "cat Dog", False, [1, 5, 9])


def test_selection(spark):
    rows = spark.createDataFrame([(1, "FAIL", True, True), (2, "PASS", True, False), (3, "PASS", True, False)], "clip long, status string, reviewed boolean, override boolean")
    ids = lambda df: sorted(r.clip for r in df.collect())
    assert ids(selection.view(rows, "fail")) == [1] and ids(selection.view(rows, "unrev")) == [1, 2, 3]
    assert ids(selection.only(rows, "clip", "2, 3")) == [2, 3] and ids(selection.only(rows, "clip", "")) == [1, 2, 3]
    assert ids(selection.first_rows(rows, 0, "clip")) == [1, 2, 3] and ids(selection.first_rows(rows, 2, "clip")) == [1, 2]
    left, shown = selection.missing(rows, rows.where("clip = 2"), "clip", 1)
    assert ids(left) == [1, 3] and ids(shown) == [1]
    clips = spark.createDataFrame([("a/x.wav", 6.0, "the of and"), ("a/y.wav", 6.0, "Hmm the of"), ("a/z.wav", 5.5, "the of"), ("a/w.wav", 8.0, "the [x] of"), ("a/v.wav", 8.0, "foo bar")], "audio string, dur double, text string")
    name = lambda df: sorted(r.audio[2] for r in df.collect())
    lexicon = ["the", "of", "and", "x"]
    assert name(selection.prompts(clips, lexicon)) == ["x"]
    assert name(selection.references(clips, lexicon, spark.createDataFrame([("z",)], "stem string"))) == ["w", "x"]
    wide = selection.union_all(rows.select("clip"), rows.select("clip", "status"))
    assert wide.where("status is null").count() == 3
    with pytest.raises(AnalysisException):
        selection.first_present(lambda: spark.read.json("/nowhere/a"), lambda: spark.read.json("/nowhere/b"))
    assert selection.first_present(lambda: spark.read.json("/nowhere/a"), lambda: rows).count() == 3


def test_production_gate(spark):
    rows = spark.createDataFrame([(1, False, -99.0, None, 2.0, 0.9), (2, True, -1.0, 0.1, 0.1, 0.2), (3, True, -60.0, None, None, None), (4, None, 0.0, 0.1, 0.1, 0.1)], "clip int, has_wav boolean, align_min double, lead double, trail double, cer_core double")
    got = {r.clip: r.r for r in rows.select("clip", gates.production_reasons({**gates.PRODUCTION, "min_align": -50.0}).alias("r")).collect()}
    assert got == {1: ["missing_wav"], 2: [], 3: ["low_align(-60.00)", "all_silence"], 4: ["missing_wav"]}


def test_or_combinations(spark):
    rnd = random.Random(3)
    data = [(rnd.random() < 0.3, round(rnd.random(), 2), round(rnd.random(), 2)) for _ in range(120)]
    df = spark.createDataFrame(data, "is_cut boolean, a double, b double")
    found = gates.atoms(df, ["a", "b"], least=2, most=60).collect()
    hit = lambda r, row: (row[1 if r["metric"] == "a" else 2] >= r["threshold"]) if r["direction"] == ">=" else (row[1 if r["metric"] == "a" else 2] <= r["threshold"])
    for r in found:
        assert (r["caught"], r["flagged"]) == (sum(hit(r, x) for x in data if x[0]), sum(hit(r, x) for x in data if not x[0]))
    best = {r["size"]: (r["caught"], r["flagged"]) for r in gates.best_or(df, spark.createDataFrame(found), pool=8).collect()}
    pool = sorted(found, key=lambda r: (-(r["caught"] - r["flagged"]), r["metric"], r["direction"], r["threshold"]))[:8]
    for k in (2, 3):
        combos = [c for c in itertools.combinations(pool, k) if k == 3 or (c[0]["metric"], c[0]["direction"]) != (c[1]["metric"], c[1]["direction"])]
        score = lambda c: (sum(any(hit(r, x) for r in c) for x in data if x[0]), sum(any(hit(r, x) for r in c) for x in data if not x[0]))
        assert best[k] == min((score(c) for c in combos), key=lambda s: (-s[0], s[1]))


def test_percentiles_by_ranges(spark):
    rnd = random.Random(5)
    data = [(k, float(rnd.randrange(50))) for k in ("x", "y") for _ in range(101 if k == "x" else 7)] + [("z", None)]
    df = spark.createDataFrame(data, "k string, v double")
    floor = {r.k: (r.p10, r.p50) for r in gates.floor_percentile(df, "v", (0.1, 0.5), "k").collect()}
    line = {r.k: r.q for r in gates.linear_percentile(df, "v", {"q": 0.3}, "k").collect()}
    for k in ("x", "y"):
        v = sorted(x for g, x in data if g == k)
        assert floor[k] == (v[min(len(v) - 1, int(0.1 * len(v)))], v[min(len(v) - 1, int(0.5 * len(v)))])
        assert abs(line[k] - np.percentile(v, 30)) < 1e-9
    assert set(floor) == {"x", "y"}


def test_hash_places_and_references(spark, monkeypatch):
    df = spark.createDataFrame([(i, "a" if i % 3 else None) for i in range(300)], "id long, g string")
    few = sorted(map(tuple, sampling.hash_placed(df, "id", "g", "s").collect()), key=repr)
    monkeypatch.setattr(sampling, "_buckets", lambda d, rows=0: 2)
    assert sorted(map(tuple, sampling.hash_placed(df, "id", "g", "s").collect()), key=repr) == few
    refs = sampling.inject_references(df, "id", "g", 0.4, "s").collect()
    assert len(refs) == 300 and sum(r.ref is not None for r in refs) == 120
    assert all(r.ref != r.id and (r.ref % 3 == 0) == (r.id % 3 == 0) for r in refs if r.ref is not None)


def test_nearest_vectors(spark):
    rnd = np.random.default_rng(1)
    x = np.round(rnd.standard_normal((60, 5)), 2)
    x[7] = x[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "id long, v array<double>")
    got = {r["query"]: r.neighbour for r in V.nearest(df, df.where("id % 5 = 3"), "id", "v", block=4, shard=9).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(3, 60, 5):
        cos = np.round(u @ u[q], 9)
        cos[q] = -9
        assert got[q] == int(cos.argmax())


def test_principal_axes(spark):
    rnd = np.random.default_rng(2)
    x = rnd.standard_normal((80, 4)) * [5, 2, 1, 0.1] + 3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    mean, axes = V.principal(df, "v", 2)
    _, _, vt = np.linalg.svd(x - x.mean(axis=0))
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(np.abs(axes @ vt[:2].T), np.eye(2), atol=1e-6)
    p = np.array([r.projection for r in V.projected(df, "v", mean, axes).orderBy("id").collect()])
    assert np.allclose(p, (x - mean) @ axes.T)


def test_target_lines(spark):
    lines = [(0, "hi"), (1, "Guest: q"), (2, "more"), (3, "Target: ans"), (4, "tail"), (5, "Other: x")]
    df = spark.createDataFrame([("l", *r) for r in lines], "lecture string, n int, line string")
    assert [r.line for r in timeline.target_lines(df, "^Target:", "n").orderBy("n").collect()] == ["hi", "ans", "tail"]


def test_pads_within_runs(spark):
    words = spark.createDataFrame([("l", 1, 1, 2.0, 3.0, -1.0), ("l", 1, 2, 3.05, 4.0, -5.0), ("l", 1, 3, 4.1, 5.0, -2.0)], "lecture string, run int, id long, start double, end double, score double")
    clips = spark.createDataFrame([("l", 1, 0, 1), ("l", 1, 2, 2)], "lecture string, run int, first int, last int")
    iv = spark.createDataFrame([("l", 0.0, 5.02)], "lecture string, start double, end double")
    a, b = timeline.pad_runs(words, clips, iv).orderBy("first").collect()
    assert np.allclose([a.cut_start, a.cut_end, a.align_min, a.n], [1.85, 4.1, -5.0, 2]) and np.allclose([b.cut_start, b.cut_end], [4.0, 5.02])


def test_interpolation_and_trim(spark):
    points = spark.createDataFrame([("l", 1.0, 10.0), ("l", 3.0, 20.0)], "lecture string, x double, y double")
    grid = spark.createDataFrame([("l", float(i)) for i in range(5)], "lecture string, x double")
    assert [r.y for r in timeline.interpolated(grid, points, "x", "y").orderBy("x").collect()] == [10.0, 10.0, 15.0, 20.0, 20.0]
    s = spark.createDataFrame([("l", i, v) for i, v in enumerate([0.0, 1.0, 0.5, 0.0, 0.0, 0.0])], "lecture string, i int, v double")
    assert timeline.trailing_trim(s, "v", 1, "i").count() == 4


def test_preferences(spark):
    rows = [("A", "orig", "dn", "orig", False), ("B", "orig", "dn", "orig", False), ("same", "dn", "orig", "dn", False), (None, "dn", "orig", "tie", False), ("same", "orig", "orig", "tie", True)]
    r = review.preferences(spark.createDataFrame(rows, "picked string, a string, b string, favoured string, attention boolean")).first()
    assert tuple(r) == (1, 1, 2, 2, 2, 1, True)


def test_experiment_helpers(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0)], "a double, b double, y int")
    r = experiments.class_scores(df, ["a", "b"], "y").first()
    assert abs(sum(r.probabilities) - 1) < 1e-12 and abs(r.nll - np.log(1 + np.e)) < 1e-12
    z = experiments.normalised(spark.createDataFrame([("g", 1.0), ("g", 3.0), ("h", 2.0)], "k string, v double"), "v", "k").orderBy("k", "v").collect()
    assert [x.z for x in z] == [-1.0, 1.0, None]


def test_stages(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "clip long, text string")

    def make():
        return lambda b: b.assign(hypothesis=b["text"].str.upper(), extra=1)

    out = stages.run_stage(rows, "texts", make)
    assert sorted(map(tuple, out.collect())) == [(1, "A"), (2, "B")]
    done = spark.createDataFrame([(1, "kept")], "clip long, hypothesis string")
    assert sorted(map(tuple, stages.resumed(rows, done, "clip", "texts", make).collect())) == [(1, "kept"), (2, "B")]


def test_web(spark, tmp_path):
    class Page(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200 if self.path == "/a" else 404)
            self.end_headers()
            self.wfile.write(b"caf\xc3\xa9 \xff" + b"x" * 100_000)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Page)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        asked = spark.createDataFrame([(f"{url}/a",), (f"{url}/a",), (f"{url}/b",), ("no address",), (None,)], "url string")
        parts = web.answers(asked, part_bytes=30_000, hosts=2).cache()
        assert sorted((r.part, len(r.body)) for r in parts.where(F.col("url").endswith("/a")).collect()) == [(0, 30_000), (1, 30_000), (2, 30_000), (3, 10_007)]
        assert sorted((r.url[-2:], r.status, r.body is None) for r in parts.where("error is not null").collect()) == [("/b", 404, True), ("ss", None, True)]
        html = {r.url[-2:]: r.html for r in web.pages(parts).collect()}
        assert html["/a"].startswith("café \ufffdx") and html["/b"] is None and html["ss"] is None
        files.write_files(web.files(parts), str(tmp_path / "landed"))
        assert [f.stat().st_size for f in (tmp_path / "landed").iterdir()] == [100_007]
    finally:
        server.shutdown()


def test_caches_and_listings(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    path = str(tmp_path / "cache")
    assert [io.cached(spark, path, make).count() for _ in range(2)] == [3, 3] and len(made) == 1
    assert io.cached(spark, path, make, refresh=True).count() == 3 and len(made) == 2
    rows = spark.createDataFrame([("a",), ("b",)], "slug string")
    out = str(tmp_path / "conv")
    assert io.converted(spark, rows.where("slug = 'a'"), out, "slug", lambda d: d.withColumn("n", F.lit(1))).count() == 1
    assert sorted(r.n for r in io.converted(spark, rows, out, "slug", lambda d: d.withColumn("n", F.lit(2))).collect()) == [1, 2]
    folder = tmp_path / "wavs"
    folder.mkdir()
    (folder / "s1__x.wav").write_bytes(b"")
    (folder / "s2__y.wav").write_bytes(b"abc")
    (folder / "other.txt").write_bytes(b"abc")
    assert sorted((r.seed, r.sent) for r in io.list_files(spark, str(folder), r"^s(\d+)__(\w+)\.wav$", {"seed": "int", "sent": "string"}).collect()) == [(1, "x"), (2, "y")]
    assert io.read_words(spark, str(tmp_path / "absent")).count() == 0
    with pytest.raises(AnalysisException):
        io.manifests(spark, str(tmp_path / "absent"))
    io.write_lines(spark.createDataFrame([("a\nb",), ("c",)], "value string"), str(tmp_path / "lines"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect()) == ["a b", "c"]
    assert io.subset_yaml("n: {n}\n", [35, 70]) == {35: "n: 35\n", 70: "n: 70\n"}


def test_clip_files(spark, tmp_path):
    y = np.sin(np.arange(16000) / 10).astype(np.float32)
    data = signal.encode(y)
    assert abs(len(signal.decode_range(data, 0.25, 0.5)) - 4000) <= 1 and np.allclose(signal.decode_range(data, 0.25, 0.5), signal.decode(data)[4000:8000])
    for names in (["a", "b"], ["c"]):
        files.write_clips(spark.createDataFrame([(n, y[:100].tolist()) for n in names], "name string, samples array<float>"), str(tmp_path / "clips"))
        assert sorted(f.name for f in (tmp_path / "clips").iterdir()) == [f"{n}.wav" for n in names]
    assert len(signal.decode((tmp_path / "clips" / "c.wav").read_bytes())) == 100


def test_signal_helpers():
    y = np.concatenate([np.zeros(8000), np.sin(np.arange(8000) / 5), np.zeros(8000)]).astype(np.float32)
    assert 8000 + 2 * 1600 - 50 <= len(signal.trim_ends(y)) <= 8000 + 2 * 1600 + 1
    assert len(signal.cut(y, 0.5, 1.0)) == 8000 and signal.wideband(y).shape[0] == 26 and signal.narrowband(y).shape[0] == 513
    pooled = signal.pooled_spectrum([y, y[8000:16000]], np.linspace(100, 4000, 40))
    assert pooled.max() == 0 and abs(np.linspace(100, 4000, 40)[pooled.argmax()] - 16000 / (10 * np.pi)) < 120
    rnd = np.random.default_rng(4)
    for _ in range(10):
        a, b = rnd.standard_normal((rnd.integers(1, 9), 2)), rnd.standard_normal((rnd.integers(1, 9), 2))
        cost = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
        best = {(0, 0): cost[0, 0]}
        for i, j in itertools.product(range(len(a)), range(len(b))):
            if i or j:
                best[i, j] = cost[i, j] + min(best[p] for p in ((i - 1, j), (i, j - 1), (i - 1, j - 1)) if p in best)
        path = edits.dtw(a, b)
        assert path[0] == (0, 0) and path[-1] == (len(a) - 1, len(b) - 1) and np.isclose(sum(cost[p] for p in path), best[path[-1]])


def test_sessions_resume_as_a_stream(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:30:00"), (1, "2024-01-01 02:00:00"), (2, "2024-01-01 00:00:00"), (2, "2024-01-09 00:00:00")]
    df = spark.createDataFrame(rows, "user_id long, t string").select("user_id", F.col("t").cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value"))
    batch = sorted((r.user_id, str(r.start), r.n) for r in sessions(df).collect())
    assert [(u, n) for u, _, n in batch] == [(1, 2), (1, 1), (2, 1), (2, 1)]
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = sessions(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.user_id, str(r.start), r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == batch[:3]


def test_entry_without_the_optional_parts(monkeypatch):
    import __spark_entry__ as e

    from clipwise import catalog

    monkeypatch.setitem(sys.modules, "clipwise.llm", None)
    monkeypatch.setitem(sys.modules, "clipwise.llm.registry", None)
    assert set(e.queries()) == set(catalog.QUERIES) and set(e.oracle_sql()) == set(catalog.ORACLE_SQL)


def test_ranks_of_a_hot_group(spark):
    """The same places by ranges as by a window, with most rows in one group, nulls, and several ranges a group."""
    rnd = random.Random(6)
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice([None, "a", "b"]), rnd.random() < 0.5, i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, f boolean, id long").repartition(5)
    for order in (("id",), (F.desc("f"), F.col("id").desc())):
        places = [{r.id: r.place for r in selection.placed(df, *order, keys=("k",), window_rows=n).collect()} for n in (1000, 0)]
        assert places[0] == places[1]
    whole = [{r.id: r.place for r in selection.placed(df, "id", window_rows=n).collect()} for n in (1000, 0)]
    assert whole[0] == whole[1]
    assert sorted(r.id for r in selection.middle(df.where("k = 'hot'"), 2, "id", keys=("k",)).collect()) == sorted(r[2] for r in rows if r[0] == "hot")[(n := sum(r[0] == "hot" for r in rows)) // 2 :][:2] and n > 2


def test_english_by_table_and_by_list(spark):
    clips = spark.createDataFrame([(1, "the cat of"), (2, ""), (3, None), (4, "dog")], "clip int, text string")
    lexicon = ["the", "of"]
    table = spark.createDataFrame([(w,) for w in [*lexicon, "the"]], "word string")
    want = {1: 2 / 3, 2: 0.0, 3: 0.0, 4: 0.0}
    for other in (lexicon, table):
        assert {r.clip: r.english for r in selection.english(clips, other).collect()} == pytest.approx(want)
    assert {r.clip: r.english for r in selection.english(clips, table, broadcast_rows=0).collect()} == pytest.approx(want)


def test_no_backbone_is_a_reason_if_asked_for(spark):
    row = spark.createDataFrame([(True, 0.0, 0.1, 0.1, None)], "has_wav boolean, align_min double, lead double, trail double, cer_core double")
    assert row.select(gates.production_reasons().alias("r")).first().r == []
    assert row.select(gates.production_reasons(backbone=True).alias("r")).first().r == ["no_backbone"]
