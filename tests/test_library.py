"""Micro-fixtures for folds, timeline operators, gates, sampling and signals, worked out by hand or by a plain model."""

import math
import random

import numpy as np
import pytest
from clipwise.functions import edits, signal
from clipwise.functions import text as T
from clipwise.functions import vectors as V
from clipwise.operators import experiments, gates, review, sampling, timeline
from clipwise.sources import io
from pyspark.sql import functions as F

SPANS = "lecture int, id long, start double, end double"


def spans(spark, rows, lecture=1):
    return spark.createDataFrame([(lecture, i, float(a), float(b)) for i, (a, b) in enumerate(rows)], SPANS)


def text(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


def test_transliterate(spark):
    assert text(spark, T.transliterate, "Kṛṣṇa [note] māyā–moha…") == "Krishna maya-moha..."
    assert text(spark, T.transliterate, "a\nb  c  d ’x") == "a\nb c d x"
    assert text(spark, T.clean_text, "ok [Hmm] , go") == "ok, go"
    assert text(spark, T.transliterate, None) is None


def test_word_count(spark):
    for value, n in ((None, 0), ("", 0), ("  ", 0), (" a  b ", 2), ("a b", 2)):
        assert text(spark, T.word_count, value) == n


def test_web_functions(spark):
    html = '<p dir="ltr" style="text-align: justify">Host: a&amp;b<br/>c</p><p>other</p><P dir="ltr" style="text-align:justify;">&nbsp;</P>'
    assert text(spark, lambda c: T.paragraphs(c, r'dir="ltr"[^>]*text-align:\s*justify', "Host:"), html) == ["a&b\nc"]
    assert text(spark, T.slug, "http://x.org/i.php?850000---The%20Name+x&a_id=3") == "the-name-x"
    assert text(spark, T.slug, "http://x.org/") == "lecture"
    media = lambda base: lambda c: T.media_url(c, F.lit(base))
    assert text(spark, media("http://h.org/a/b?q"), '<source type="x" src="m/1.mp3">') == "http://h.org/a/m/1.mp3"
    assert text(spark, media("http://h.org/a/b"), '<source src="/m&amp;1.mp3">') == "http://h.org/m&1.mp3"
    assert text(spark, media("http://h.org"), "<p>none</p>") is None


def test_error_rates(spark):
    rate = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(T.cer(F.col("a"), F.col("b"))).first()[0]
    assert rate("", "x") == 0.0 and rate("abc", " ") == 1.0 and rate("Abc!", "abd") == pytest.approx(1 / 3) and rate("a", "abcd") == 3.0
    both = lambda a, b, strict: spark.createDataFrame([(a, b)], "a string, b string").select(T.error_rates(F.col("a"), F.col("b"), ["the"], strict).alias("e")).first().e
    assert both("krishna", "govinda", True).cer_core is None and both("krishna", "govinda", False).cer_core == 0.0
    assert both("the x", "", True).cer_raw == both("the x", "", True).cer_core == 1.0


def test_word_distance():
    rnd = random.Random(1)

    def plain(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            d, before = [i], d
            for j, y in enumerate(b, 1):
                d.append(min(before[j] + 1, d[j - 1] + 1, before[j - 1] + (x != y)))
        return d[-1]

    for _ in range(300):
        a, b = ([rnd.choice("abc") for _ in range(rnd.randrange(8))] for _ in range(2))
        assert edits.distance(a, b) == plain(a, b)


def merge_model(turns, gap, veto):
    own = sorted((t[2], t[3]) for t in turns if t[1] == "t")
    other = [(t[2], t[3]) for t in turns if t[1] != "t"]
    out = []
    for s, e in own:
        near = out and s - out[-1][1] <= gap and not (veto and any(a < s and b > out[-1][1] for a, b in other))
        out = [*out[:-1], (out[-1][0], e)] if near else [*out, (s, e)]
    return out


def test_gap_merge(spark):
    make = lambda rows: spark.createDataFrame([(1, s, float(a), float(b), i) for i, (s, a, b) in enumerate(rows)], "lecture int, speaker string, start double, end double, id long")
    merged = lambda rows: [(r.start, r.end) for r in timeline.merge_gaps(make(rows), "t", 0.25).orderBy("start", "iv").collect()]
    assert merged([("t", 0, 1), ("t", 1.2, 2)]) == [(0, 2)]
    assert merged([("t", 0, 1), ("t", 1.2, 2), ("o", 1.05, 1.1)]) == [(0, 1), (1.2, 2)]
    assert merged([("t", 0, 5), ("t", 1, 2)]) == [(0, 2)]
    rnd = random.Random(2)
    for _ in range(3):
        rows = [(rnd.choice("ttto"), x := rnd.randrange(200) / 4, x + rnd.randrange(1, 12) / 4) for _ in range(60)]
        assert merged(rows) == merge_model([(1, *r) for r in rows], 0.25, True)


def test_overlap_and_asof(spark):
    iv = spans(spark, [(0, 0.5), (0.6, 1.0)])
    for end, hit in ((1.0, None), (0.9889, False), (1.0 + 1e-9, None)):
        r = timeline.covered(spans(spark, [(0, end)]), iv).first()
        assert r.overlap == pytest.approx(0.9 if end >= 1 else 0.8889)
        assert hit is None or r.is_target is hit
    points = spark.createDataFrame([(1, 1, 1.0005), (1, 2, 3.0)], "lecture int, id long, t double")
    assert [r.iv_end for r in timeline.end_asof(points, spans(spark, [(0, 1.0)])).orderBy("id").collect()] == [1.0, 3.0]


def clip_model(words, least, most, low, high):
    out, cur = [], []
    for i, (s, e, stop) in enumerate(words):
        cur.append(i)
        d = e - words[cur[0]][0]
        if d >= most or (stop and d >= least) or i == len(words) - 1:
            if low <= d <= high:
                out.append((cur[0], i))
            cur = []
    return out


def test_greedy_clips(spark):
    def clips(rows):
        df = spark.createDataFrame([(1, i, float(a), float(b), s) for i, (a, b, s) in enumerate(rows)], SPANS + ", stops boolean")
        return [(r.first, r["last"]) for r in timeline.greedy_clips(df).orderBy("first").collect()]

    assert clips([(0, 5, False), (5, 10, True), (11, 31, False)]) == [(0, 1), (2, 2)]
    assert clips([(0, 3, True)]) == []
    rnd = random.Random(3)
    for _ in range(3):
        t, rows = 0.0, []
        for _ in range(80):
            d = rnd.randrange(1, 30) / 4
            rows.append((t, t + d, rnd.random() < 0.3))
            t += d + rnd.randrange(3) / 4
        assert clips(rows) == clip_model(rows, 9, 20, 4, 30)


def test_pack_pad_and_picks(spark):
    packed = timeline.pack_segments(spans(spark, [(0, 6), (6, 14), (14, 20)])).orderBy("start").collect()
    assert [(r.start, r.end, r.parts) for r in packed] == [(0, 14, 2), (14, 20, 1)]
    padded = timeline.pad(spans(spark, [(0.1, 1), (1.1, 2), (5, 6)])).orderBy("start").collect()
    assert [(r.cut_start, pytest.approx(r.cut_end)) for r in padded] == [(0.0, 1.1), (1.0, 2.15), (4.85, 6.15)]
    rows = spark.createDataFrame([(1, i, float(n), tc) for i, (n, tc) in enumerate([(5, 1.0), (4, 1.2), (3, 2.0), (3, 1.9)])], "lecture int, id long, length double, tc double")
    assert [r.id for r in timeline.spaced_topk(rows, 0.3, 6).orderBy("id").collect()] == [0, 3]


def test_median3_and_octaves(spark):
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate([None, 5.0, 9.0, 1.0, None, 2.0])], "lecture int, i int, x double")
    assert [r.m for r in rows.select("i", timeline.median3(rows, "x", "i").alias("m")).orderBy("i").collect()] == [None, 7.0, 5.0, 5.0, 1.5, 2.0]
    for f in (90.0, 160.0, 161.0, 330.0, 700.0, 149.0):
        want = f
        while want > 1.6 * 100 and want / 2 >= 75:
            want /= 2
        got = spark.range(1).select(timeline.octave_fix(F.lit(f), F.lit(100.0))).first()[0]
        assert got == pytest.approx(want)


def test_gates(spark):
    rows = spark.createDataFrame([(x, x >= 3) for x in (1.0, 2.0, 3.0, 4.0)], "x double, is_cut boolean")
    assert gates.floor_percentile(rows, "x", (0.5,)).first().p50 == 3
    best = gates.best_gates(gates.threshold_sweep(rows, ["x"])).first()
    assert (best.direction, best.threshold, best.caught, best.flagged) == (">=", 3.0, 2, 0)
    c = gates.confusion(rows, {"g": "x < 4"}).first()
    assert (c.kept, c.leak, c.caught, c.suspects) == (3, 1, 1, 0)
    report = spark.createDataFrame([("a(1.0);b(2)",), ("a(3)",), ("",), (None,)], "reasons string")
    assert {r.reason: r.n for r in gates.reason_histogram(report).collect()} == {"a": 2, "b": 1}
    gap = gates.class_gap(rows, "x").first()
    assert (gap.max_keep, gap.min_cut) == (2, 3)
    clip = spark.createDataFrame([(10.0, -20.0, -5.0, 0.5, 0.1, 0.1, 0.1)], "dur double, align_min double, align_mean double, cer_core double, load double, lead double, trail double")
    assert all(clip.where(g).count() for g in gates.BATTERY.values())


def test_sampling(spark):
    rows = spark.createDataFrame([(i, f"g{i % 5}") for i in range(50)], "id long, g string")
    split = sampling.group_split(rows, "g", 2, "s")
    assert {r.n for r in split.groupBy("g").agg(F.count_distinct("split").alias("n")).collect()} == {1}
    assert split.where("split = 'val'").select("g").distinct().count() == 2 and sampling.leaked(split, "g").count() == 0
    assert {r.split for r in sampling.group_split(rows.where("g = 'g1'"), "g", 2, "s").collect()} == {"val"}
    refs = sampling.inject_references(rows, "id", "g", 0.4, "s").collect()
    assert sum(r.ref is not None for r in refs) == 20 and all(r.ref != r.id for r in refs)
    inner = {r.id for r in sampling.nested(rows, "id", "g", [2, 4], "s").where("subset <= 2").collect()}
    outer = {r.id for r in sampling.nested(rows, "id", "g", [2, 4], "s").where("subset <= 4").collect()}
    assert inner < outer and len(outer) == 20
    assert [r.id for r in sampling.evenly(rows, 3, "id").orderBy("id").collect()] == [0, 24, 49]


def test_experiments_and_review(spark):
    deltas = spark.createDataFrame([(x,) for x in (-0.06, -0.05, -0.02, 0.0, 0.3)], "d double")
    r = experiments.delta_buckets(deltas, "d").first()
    assert (r.worse, r.slightly_worse, r.kept, r.better) == (1, 1, 3, 2)
    bins = experiments.histogram(spark.createDataFrame([(x,) for x in (69.9, 70.0, 79.9, 260.0, 260.1)], "x double"), "x", 70, 10, 19).orderBy("bin").collect()
    assert [(b.bin, b.n) for b in bins] == [(0, 2), (18, 1)]
    answered = spark.createDataFrame([("l", True), ("l", None), ("l", False)], "who string, correct boolean")
    a = review.abx(answered, "who").first()
    assert (a.accuracy, a.n_answered, a.at_chance) == (0.5, 2, True)


def test_vectors(spark):
    rows = spark.createDataFrame([(1, [3.0, 0.0]), (1, [3.0, 8.0])], "k int, v array<float>")
    assert V.centroid(rows, "v", "k").first().centroid == [0.6, 0.8]
    assert spark.range(1).select(V.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0)))).first()[0] == 0.0


def test_sources_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("clips/a_0001.wav", 'say "x"\ty', 2.0, None, None, None)], io.MANIFEST)
    io.write_jsonl(rows, str(tmp_path / "m"))
    assert io.read_jsonl(spark, str(tmp_path / "m")).collect() == rows.collect()
    report = spark.createDataFrame([(1, 2.0, 3, 1.5, None, "PASS", 'a "b\tc')], io.LOCAL_REPORT)
    io.write_tsv(report.coalesce(1), str(tmp_path / "r"))
    assert "-1.0" in next((tmp_path / "r").glob("part-*")).read_text()
    back = io.read_tsv(spark, str(tmp_path / "r"), io.LOCAL_REPORT).first()
    assert back.lead_sil is None and back.reasons == 'a "b c' and back.wps == 1.5
    (tmp_path / "lines.txt").write_text("a\n\n # no\n#no\n b\n")
    assert [r.value for r in io.read_lines(spark, str(tmp_path / "lines.txt")).collect()] == ["a", " b"]
    (tmp_path / "seg.json").write_text('[{"id": 1, "start": 0.5, "end": 2.0, "dur": 1.5}]')
    assert io.read_json_array(spark, str(tmp_path / "seg.json"), io.SEGMENTS).first().dur == 1.5
    assert io.read_words(spark, str(tmp_path / "absent")).count() == 0
    for name in ("c150__s1__s2.wav", "other.wav"):
        (tmp_path / name).write_bytes(b"RIFF")
    found = io.list_files(spark, str(tmp_path / "*.wav"), r"^c(\d+)__(\w+?)__s(\d+)\.wav$", {"ckpt": "int", "sent": "string", "seed": "int"}).collect()
    assert [(r.ckpt, r.sent, r.seed) for r in found] == [(150, "s1", 2)]
    (tmp_path / "root" / "lec").mkdir(parents=True)
    (tmp_path / "root" / "lec" / "train.jsonl").write_text('{"audio": "a", "text": "t", "duration": 1.0}\n')
    assert io.manifests(spark, str(tmp_path / "root")).first().lecture == "lec"


def test_signals():
    y = np.concatenate([np.zeros(8000), 0.5 * np.sin(np.arange(16000) / 5), np.zeros(4000)]).astype(np.float32)
    lead, trail = signal.edges(y)
    assert lead == pytest.approx(0.5, abs=0.05) and trail == pytest.approx(0.25, abs=0.05) and signal.edges(np.zeros(100)) is None
    assert np.allclose(signal.decode(signal.encode(y)), y, atol=1e-3)
    assert len(signal.trim_tail(y)) == pytest.approx(24000 + 8000, abs=10) or len(signal.trim_tail(y)) == len(y)
    assert np.abs(signal.normalise(y)).max() == pytest.approx(0.95)
    assert len(signal.join([y, y], 0.5)) == 2 * len(y) + 16000
    short = y[8000:12000]
    assert signal.mcd(short, short) == 0.0 and signal.mcd(short, short[::-1] * 0.1 + 0.01) > 0
    assert signal.f0_rmse(np.full(6, 200.0), np.full(8, 100.0)) == pytest.approx(12) and signal.f0_rmse(np.full(4, 1.0), np.full(9, 1.0)) is None
    assert signal.mel_db(short).shape[0] == 64 and signal.mfcc(short).shape[1] == 24 and math.isfinite(signal.spectrum_distance(np.arange(5.0), np.arange(5.0)[::-1]))


def test_stream(spark, tmp_path):
    from clipwise.streaming.windows import EVENTS, stream_to_table

    rows = [(i, f"2024-01-0{1 + i // 4} {i % 4 + 1:02d}:00:00", 1, "x", 1.0, "") for i in range(12)]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    args = (spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert {(str(r.start)[:10], r.n) for r in stream_to_table(*args).collect()} == {("2024-01-01", 4), ("2024-01-02", 4)}
    assert stream_to_table(*args).count() == 2 and EVENTS
