"""Mixing, URL rules, licenses and decontamination on small tables with odd rows."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from clipwise.llm import decontaminate, licenses, mixing, url_rules
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mix_targets(spark):
    df = spark.createDataFrame([("a", 100), ("b", 10), (None, 5), ("c", 0)], "source string, source_size long")
    rows = {r.source: r for r in mixing.targets(df).collect()}
    assert abs(sum(r.target for r in rows.values()) - 115) < 1e-9
    assert all(r.target <= 3 * r.source_size + 1e-9 for r in rows.values())
    assert rows["b"].target == 30 and rows[None].target == 15 and rows["c"].target == 0


def test_mix_edge_cases(spark):
    rows = [(i % 7 or None, None if i % 5 == 0 else "w " * (i % 40), [None, "a", "b"][i % 3], "clash") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    once = sorted(map(str, mixing.mix(df).collect()))
    again = sorted(map(str, mixing.mix(df.repartition(7), rows_per_chunk=10).collect()))
    assert once == again and len(once) == 300
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies"]
    taken = defaultdict(int)
    for r in out.collect():
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for r in out.select("source", "target").distinct().collect():
        assert abs(taken[r.source] - r.target) <= 0.1 * r.target + 80
    assert mixing.emit(out).count() == sum(r.copies for r in out.collect())
    assert mixing.mix(df.where("false")).collect() == []
    assert "Python" not in plan(out)


def judged(spark, urls, labels=()):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    marks = spark.createDataFrame(list(labels), "page_id long, label string")
    return url_rules.judge(pages, marks).orderBy("page_id")


def test_url_rules(spark):
    urls = [
        "http://a.com/x", "http://A.COM/x", "http://a.com", "http://example.com/en/1", "http://www.example.com/en/1", "http://b.net/es/2?x=/fr/", "http://b.net/fr", None,
        "no scheme", "x://y://z/q", "http://notcom/x", "http://shop.example.com/en/", "//a.com/", "http://h.org/p#f?q", "",
    ]
    rows = judged(spark, urls).collect()
    assert [r.rule for r in rows] == ["com/", "com/", None, "example.com/en/", "www.example.com/en/", "net/es/", None, None, None, None, None, "example.com/en/", None, None, None]
    assert [(r.host, r.path) for r in rows][9:11] == [("y:", "//z/q"), ("notcom", "/x")]
    assert rows[7].host == rows[7].path == rows[8].host == "" and rows[13].path == "/p"
    assert {r.verdict for r in rows if r.rule is None} == {"allow"}


def test_url_mining(spark):
    urls = [f"http://bad{i % 2}.org/pills/{i}" for i in range(60)] + [f"http://good.org/news/{i}" for i in range(60)]
    out = judged(spark, urls, [(i, "block" if i < 60 else "allow") for i in range(0, 120, 2)]).collect()
    assert [r.verdict for r in out] == ["block"] * 60 + ["allow"] * 60
    assert "Python" not in plan(judged(spark, urls, [(i, "block") for i in range(60)]))


def test_url_empty(spark):
    assert judged(spark, []).collect() == []


def test_licenses(spark):
    gpl = licenses.TEMPLATES["GPL-3.0"]
    texts = [
        None, "", "mit", "a b. Released under the MIT License.", "x " * 5003 + "RELEASED UNDER\nTHE MIT LICENSE! " + "y " * 5000, gpl, gpl.replace("version 3", "version 2"), gpl.replace("This", "That"),
        "released under the mit", "Licensed under CC BY-NC 4.0; Released under the MIT License", "Licensed under CC BY-SA 4.0",
    ]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    out = {r.doc_id: {x.license: x.start for x in r.licenses} for r in licenses.scan(df).collect()}
    assert out == {0: {}, 1: {}, 2: {}, 3: {"MIT": 2}, 4: {"MIT": 5003}, 5: {"GPL-3.0": 0}, 6: {"GPL-3.0": 0}, 7: {"GPL-3.0": 1}, 8: {}, 9: {"CC-BY-NC-4.0": 0, "MIT": 7}, 10: {"CC-BY-SA-4.0": 0}}
    assert licenses.scan(df.where("false")).count() == 0
    assert "Exchange" not in plan(licenses.scan(df)) and "Python" not in plan(licenses.scan(df))


def test_license_recall(spark):
    """Windows at any offset retrieve every template."""
    names = list(licenses.TEMPLATES)
    rows = [(i, " ".join(f"q{j}" for j in range(i % 9)) + " " + licenses.TEMPLATES[names[i % len(names)]] + " tail" * (i % 5)) for i in range(135)]
    found = {r.doc_id: {x.license for x in r.licenses} for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(names[i % len(names)] in found[i] for i in range(135))


def hits(docs, items, n=10):
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if w]
    wins = defaultdict(set)
    for i, t in items:
        ws = split(t)
        if i is not None and ws:
            for k in range(max(1, len(ws) - n + 1)):
                wins[tuple(ws[k : k + n])].add(str(i))
    out = []
    for i, t in docs:
        ws, hit, found = split(t), set(), set()
        for m in {len(w) for w in wins}:
            for k in range(len(ws) - m + 1):
                if (w := tuple(ws[k : k + m])) in wins:
                    hit.update(range(k, k + m))
                    found |= wins[w]
        out.append((i, len(ws), len(hit), sorted(found)))
    return sorted(out, key=repr)


def test_decontamination(spark):
    item = " ".join(f"t{i}" for i in range(14))
    docs = [
        (1, None), (2, ""), (3, "?!"), (4, f"a b {item} c"), (4, f"a b {item} c"), (4, "other"), (None, f"x {item.upper()}"), (5, item[: item.rindex(" ")] + " zz"), (6, "short one"), (7, "short, ONE! short one"),
        (8, "solo"), (9, "w " * 20000 + item), (10, "the the the the"), (11, item + " " + item), (12, "É t1"),
    ]
    items = [(1, item), (2, "Short one."), (3, None), (4, ""), (5, "solo"), (None, "a b"), (6, item), (7, "the the"), (8, "é t1")]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_hit int")
    b = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.find(d, b)
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "items", "near_items", "contaminated"]
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in out.collect()), key=repr) == hits(docs, items)
    assert "Python" not in plan(out)
    assert decontaminate.find(d.where("false"), b).count() == 0
    assert decontaminate.find(d, b.where("false")).where("contaminated").count() == 0
    shuffled = decontaminate.find(d, b, broadcast_rows=0)
    assert sorted(map(str, shuffled.collect())) == sorted(map(str, out.collect()))


def nearly(docs, items, n=10, slop=2, spare=10):
    """Items of which a window stands with every word but one in ``spare`` within ``slop`` of its place, by trial of all places."""
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if w]
    out = []
    for i, t in docs:
        ws, found = split(t), set()
        for k, b in items:
            bs = split(b)
            if k is None or not bs:
                continue
            for j in range(max(1, len(bs) - n + 1)):
                w = bs[j : j + n]
                for s in range(-len(w) - slop, len(ws) + slop):
                    if sum(w[x] in ws[max(0, s + x - slop) : max(0, s + x + slop + 1)] for x in range(len(w))) >= len(w) - len(w) // spare:
                        found.add(str(k))
        out.append((i, t, sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [100_000, 0])
def test_proximity(spark, limit):
    """Replaced, dropped, added and swapped words, also rare ones and words that no document has; random texts of few words."""
    rnd = random.Random(9)
    item = [f"t{i}" for i in range(13)]
    docs = [(1, " ".join(item)), (2, None), (3, "")]
    for i in range(4, 30):
        ws = list(item)
        for _ in range(rnd.randint(1, 3)):
            k = rnd.randrange(len(ws))
            match rnd.randrange(4):
                case 0:
                    ws[k] = "other"
                case 1:
                    del ws[k]
                case 2:
                    ws.insert(k, "more")
                case _:
                    ws[k], ws[-1] = ws[-1], ws[k]
        docs.append((i, " ".join(["the"] * rnd.randint(0, 3) + ws + ["end"] * rnd.randint(0, 2))))
    docs += [(30 + i, " ".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 40)))) for i in range(25)]
    docs += [(60, "solo"), (61, "beta alpha"), (62, "alpha x x beta"), (63, "alpha x x x x x beta"), (64, docs[5][1]), (None, docs[6][1]), (5, docs[5][1])]
    items = [(1, " ".join(item)), (2, " ".join([*item[:5], "nowhere", *item[6:]])), (3, " ".join(rnd.choice("abcde") for _ in range(14))), (4, "solo"), (5, "alpha beta"), (6, None), (7, ""), (None, "a b"), (8, " ".join(item)), (9, "a a a b")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.find(d, b, slop=2, broadcast_rows=limit)
    assert "Python" not in plan(out)
    rows = out.collect()
    assert sorted(((r.doc_id, r.text, r.near_items) for r in rows), key=repr) == nearly(docs, items)
    assert all(set(r["items"]) <= set(r.near_items) for r in rows)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows), key=repr) == hits(docs, items)
    assert any(r.near_items and not r["items"] for r in rows) and any("2" in r.near_items for r in rows)


def test_digest_of_no_items(spark):
    one = spark.range(1).select(F.sha2(F.array_join(F.array().cast("array<string>"), ","), 256).alias("h")).first()
    assert one.h == hashlib.sha256(b"").hexdigest()
