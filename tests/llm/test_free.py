"""Top-k, toxicity, personal data, language model and WARC on small tables with odd rows."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from clipwise.llm import lm, pii, topk, toxicity, warc
from pyspark.sql import functions as F


def test_topk(spark):
    rnd = random.Random(2)
    vec = lambda: [rnd.choice([-1, 1]) * rnd.random() * rnd.choice([0.1, 1]) for _ in range(8)]
    rows = [(i, vec()) for i in range(200)]
    rows += [(200 + i, list(rows[0][1])) for i in range(40)] + [(300, None), (301, [float("nan")] * 8), (302, [None] * 8), (None, vec()), (350, [0.5] * 3), (351, [0.25] * 3), (400, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", topk.quantised(F.col("embedding")))
    asked = df.where("vec_id % 50 = 0")
    got = sorted(tuple(r) for r in topk.search(df, asked.union(asked), rows_per_shard=64, queries_per_block=2).collect())
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, a in good:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good if i != q and len(a) == len(b))[:5]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    assert got == sorted(want)
    assert topk.search(df.where("false"), asked).collect() == []
    assert topk.search(df, asked.where("false")).collect() == []


def test_maxscore_large_numbers():
    rows = np.array([[2**40, 1], [2**40, 2], [-(2**40), 3]])
    q, i, s = topk.maxscore(np.array([1, 2, 3]), rows, np.array([9]), np.array([[2**20, 1]]), 2)
    assert list(zip(q, i, s, strict=True)) == [(9, 2, 2**60 + 2), (9, 1, 2**60 + 1)]


def test_toxicity(spark):
    texts = [("you are a blarg and a blarg", 1), ("what a blarg, blarg!", 1), ("a fine day in the park", 0), ("walking by the river today", 0)]
    rows = [(i, texts[i % 4][0] + f" number {i % 11}", texts[i % 4][1]) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (None, 1), (1, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert any("blarg".startswith(k) for k in model.insults)
    odd = spark.createDataFrame([(1, None, "s"), (1, "", "s"), (2, "BLARG blarg you blarg", "s"), (3, "w " * 50000, "s"), (4, "a fine day", "s")], "doc_id long, text string, score string")
    out = {(r.doc_id, r.text and r.text[:5]): r.score for r in toxicity.score(odd, model).collect()}
    assert len(out) == 5 and all(0 <= v <= 1 for v in out.values())
    assert out[(1, None)] == out[(1, "")] < 0.5 and out[(2, "BLARG")] > 0.7 and out[(4, "a fin")] < 0.5
    assert toxicity.score(odd.where("false"), model).collect() == []
    bare = toxicity.fit(docs, labels.where("false"))
    assert 0 <= toxicity.Scorer(bare).probability(np.array([toxicity.Scorer(bare).features("you idiot")]))[0] <= 1


def test_toxicity_grammar():
    s = toxicity.Scorer(toxicity.Model({"idiot": 4.0}))
    score = lambda t: s.features(t)[0]
    assert score("you idiot") > score("idiot") > score("not an idiot") > 0
    assert score("she said idiot") < score("idiot") and score("kill you") > 0 and score("kill time") == 0
    assert score("not. idiot") == score("idiot")


def brute(x):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    )
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, x) if ok(m[0]))


def test_pii_base_spans():
    rnd = random.Random(1)
    parts = ["a", "@", ".", "1", "9", "12", " ", "-", "+", "(", ")", "é", "x.y", "%", "4111111111111111", "1.2.3.4", "+1 (212) 555-0147", "a@b.c", "0"]
    for _ in range(5000):
        x = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert pii.base_spans(x) == brute(x)
        (base, spans), = pii.all_spans([x], pii.trained())
        assert set(base) <= set(spans)
    for x in ("1" * 100_000, "a" * 100_000, "a@" * 50_000, "+1" * 50_000, "1.1." * 50_000):
        pii.all_spans([x], pii.trained())


def test_pii_model():
    data = pii.examples()
    tags = pii.trained().decode([w for w, _ in data])
    assert all(list(p) == t for (_, t), p in zip(data, tags, strict=True))
    text = "cards 4111111111111111 5555555555554444 and a plain text"
    (base, spans), = pii.all_spans([text], pii.trained())
    assert base == [] and [text[a:b] for a, _, b in spans] == ["4111111111111111", "5555555555554444"]
    (_, none), = pii.all_spans(["version 2.0 of 2019, page 12, 10 to 20 at 5:30"], pii.trained())
    assert none == []


def test_pii_frames(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "", 5), (2, "é a.b@c.de x", 5), (2, "é a.b@c.de x", 5)], "doc_id long, text string, spans int")
    rows = pii.find(df).orderBy("doc_id", "text").collect()
    assert [[tuple(s) for s in r.spans] for r in rows] == [[], [], [("email", 2, 10)], [("email", 2, 10)]]
    assert [r.text for r in pii.redact(df).orderBy("doc_id", "text").collect()] == [None, "", "é [EMAIL] x", "é [EMAIL] x"]
    assert pii.find(df.where("false")).count() == 0


def test_lm(spark):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(60)] + ["É", "é", "x" * 50]
    rows = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(30)))) for i in range(80)] + [(5, "A a\x0bA"), (None, "w1"), (6, None), (6, ""), (5, "A a\x0bA"), (9, "zzz unseen")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    small = lm.Settings(head=20, rest=8, block_bytes=500)
    got = lm.score_texts(df, F.col("doc_id") % 7 == 2, small).collect()
    words = lambda t: ("".join(c.lower() if c.isascii() else c for c in t or "")).replace("\x0b", " ").split(" ")
    tokens = [(i, [w for w in words(t) if w]) for i, t in rows]
    train = Counter(w for i, ws in tokens if i is None or i % 7 != 2 for w in ws)
    ends = sum(i is None or i % 7 != 2 for i, _ in tokens)
    n, v = sum(train.values()) + ends, len(train) + 1
    want = sorted(((i, len(ws) + 1, sum(train[w] > 0 for w in ws) + 1, n, round(sum(math.log10((c + 1) / (n + v + 1)) for c in [*(train[w] for w in ws), ends]), 6)) for i, ws in tokens), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.score_texts(df.where("false"), F.lit(False), small).collect() == []
    none = lm.score_texts(df, F.lit(True), small).collect()
    assert {r.n_known for r in none} == {0} and {r.base_score for r in none} == {0.0}


def test_lm_probabilities_add_up():
    pairs = np.random.default_rng(1).integers(0, 50, (12, 12)).astype(float)
    table = lm.fit_nce(pairs, steps=60).log10_table()
    assert np.allclose((10.0**table).sum(axis=1), 1, atol=1e-4)
    p = pairs / pairs.sum(axis=1, keepdims=True)
    unigram = pairs.sum(axis=0) / pairs.sum()
    assert (pairs * table).sum() > (pairs * np.log10(unigram)).sum()
    assert np.abs(10.0**table - p).mean() < np.abs(unigram - p).mean()


def test_warc(spark, tmp_path):
    nasty = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nx"
    rows = [(5, "http://a/", "same"), (3, "http://b/", "same"), (4, None, "same"), (1, "http://c/\r\nX: y", nasty), (2, "u", None), (7, "u", ""), (None, "n", "same"), (8, "v", "é" * 200_000), (9, "d", "dup"), (9, "d", "dup")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")
    for least in (0, 4):
        out = warc.deduplicate(pages, str(tmp_path / f"w{least}"), least).collect()
        assert len(out) == len(rows)
        first = {}
        for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
            first.setdefault(h or "", i)
        for r in out:
            if r.record_type == "response":
                assert base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode() == r.payload_digest and len(r.payload) == r.payload_bytes
        by = Counter((r.page_id, r.record_type, r.refers_to) for r in out)
        want = Counter()
        seen = set()
        for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
            again = len((h or "").encode()) >= least and (h or "") in seen
            want[(i, "revisit", first[h or ""]) if again else (i, "response", None)] += 1
            seen.add(h or "")
        assert by == want
    assert warc.deduplicate(pages.where("false"), str(tmp_path / "none")).collect() == []


def test_held_out_remainders(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    for f, mod, rest in ((toxicity.held_out, 3, 1), (lm.held_out, 7, 2)):
        for r in df.withColumn("h", f()).collect():
            assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % mod == rest)


def test_lm_tokens_come_from_arrow_as_numbers(monkeypatch):
    texts = [None, "", " \t", "  aé B\tb\x0bc\xa0d ", "x", "\x1c y\x1f", "É a B É"]
    want = [w for t in texts for w in [*(t or "").encode().lower().split(), None]]
    monkeypatch.setattr(lm, "CHUNK", 12)
    for cuts in ([0, 7], [0, 2, 2, 5, 7]):
        batches = [pa.record_batch([pa.array(texts[a:b], pa.string())], ["text"]) for a, b in zip(cuts, cuts[1:], strict=False)]
        got = [found[i] if i >= 0 else None for found, ids in lm.chunks(iter(batches)) for i in ids]
        assert got == want
