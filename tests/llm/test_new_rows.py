"""Periodic runs, fill-in-middle and exact deduplication against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from clipwise.llm import exact_dedup, fill_middle, periodic
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

BLANK = re.compile(r"[\x20\x09-\x0D]")


def brute_runs(words, least=12):
    """Every stretch, its smallest period by trial, and whether a neighbour extends it."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j - i + p >= least:
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def collapsed(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def named(words):
    return np.unique(np.array(words, dtype=str), return_inverse=True)[1] if words else np.array([], int)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60) | st.lists(st.sampled_from("abcd"), max_size=40).map(lambda x: x * 3), st.sampled_from([3, 6, 12]))
def test_runs_equal_brute_force(words, least):
    assert periodic.runs(named(words), len(words), least, held=7).tolist() == [list(r) for r in brute_runs(words, least)]


def test_runs_of_strings_rich_in_runs():
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    for words in (list(fib[-1]), ["x"] * 500, list("ab" * 200 + "c" + "ab" * 100), list("abcabcabd" * 30)):
        assert periodic.runs(named(words), len(words)).tolist() == [list(r) for r in brute_runs(words)]


def test_names_are_equal_for_equal_blocks_only():
    rnd = random.Random(5)
    words = [rnd.choice("ab") for _ in range(90)] * 2
    for k, level in enumerate(periodic.names(named(words))):
        blocks = [tuple(words[i : i + (1 << k)]) for i in range(len(words) - (1 << k) + 1)]
        for i, a in enumerate(blocks):
            for j, b in enumerate(blocks):
                assert (level[i] == level[j]) == (i == j or a == b)


def test_extension_counts_equal_words_both_ways():
    words = list("xabcabcabcyabc")
    levels = periodic.names(named(words))
    a, b = np.array([1, 4, 1]), np.array([4, 7, 11])
    assert periodic.ahead(levels, a, b).tolist() == [6, 3, 3]
    assert periodic.behind(levels, a, b).tolist() == [0, 3, 0]


ODD = [
    (1, "a b " * 30),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, "the end"),
    (None, "x y z " * 5),
    (1, "a b " * 30),
    (6, "ü ß\x1c 漢 " * 6 + "tail"),
    (7, " ".join(str(i % 977) for i in range(30_000))),
    (8, "one word " * 12),
    (9, " ".join(f"w{i}" for i in range(500))),
]


def test_find_on_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "r", "c", 7) for i, t in ODD], "doc_id long, text string, runs string, found string, row int")
    out = periodic.find(docs, chunk_bytes=50)
    assert out.columns == ["doc_id", "text", "found", "row", "runs", "collapsed"]
    rows = out.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        words = BLANK.sub(" ", r.text or "").split(" ")
        words = [w for w in words if w]
        assert (r.found, r.row) == ("c", 7)
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == brute_runs(words)
        else:
            assert [tuple(x) for x in r.runs] == [(0, 30_000, 977)]
        assert r.collapsed == collapsed(words, [tuple(x) for x in r.runs])
    assert periodic.find(docs.limit(0)).count() == 0
    with pytest.raises(Exception, match="three words"):
        periodic.find(docs, least=2).collect()


def test_planted_ends(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(5 + i % 40)) if i % 7 else None) for i in range(300)] + [(None, "a b c")]
    got = {r.doc_id: r.text for r in periodic.planted(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        ws = (t or "").split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and ws:
            n, g = len(ws), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            t = " ".join(ws[a + (k - a) % p] if k >= a else ws[k] for k in range(n))
        assert (got[i] or "") == (t or "")


def by_list(text, first, second, pattern=fill_middle.UNIT):
    units = re.findall(pattern, text)
    low, high = sorted((first % (len(units) + 1), second % (len(units) + 1)))
    return len(units), len("".join(units[:low])), len("".join(units[low:high]))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab Z<P>.\n漢😀"), st.integers(0, 2**32), st.integers(0, 2**32))
def test_ranks_equal_a_list_of_units(text, first, second):
    pattern = re.compile(fill_middle.UNIT)
    n = fill_middle.counted(pattern, text)
    p, q = fill_middle.ends(pattern, text, *sorted((first % (n + 1), second % (n + 1))))
    assert (n, p, q - p) == by_list(text, first, second)


def test_second_pass_stops_at_the_higher_rank():
    class Counting:
        seen = 0

        def finditer(self, text):
            for m in re.finditer(fill_middle.UNIT, text):
                self.seen += 1
                yield m

    pattern = Counting()
    assert fill_middle.ends(pattern, "a b c d e", 1, 3) == (1, 3)
    assert pattern.seen == 3


def test_fill_in_middle_on_odd_rows(spark):
    texts = [None, "", "plain <P> marked", "<S><M>", "a", "<", "<<S", "M>S>P>", "naïve 漢字 😀 text\n\twith\x0b blanks", "word " * 30_000]
    rows = [(i, texts[i % len(texts)], "x", 3) for i in range(400)] + [(None, "no id at all", "x", 3)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, _t int")
    out = fill_middle.transform(docs).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    assert out.columns == ["doc_id", "text", "_t", "n", "form", "output", "prefix_chars", "middle_chars", "back"]
    forms = set()
    for r in out.collect():
        text = r.text or ""
        assert r.back == text and r._t == 3
        h = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
        n, p, m = by_list(text, h1, h2)
        assert r.n == n
        if not text or any(x in text for x in fill_middle.MARKS) or h3 % 100 >= 90:
            want = "plain", text, None, None
        else:
            a, b, c = text[:p], text[p : p + m], text[p + m :]
            want = ("spm", f"<S>{c}<P>{a}<M>{b}", p, m) if h4 % 100 < 20 else ("psm", f"<P>{a}<S>{c}<M>{b}", p, m)
        assert (r.form, r.output, r.prefix_chars, r.middle_chars) == want
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}
    assert fill_middle.transform(docs.limit(0)).count() == 0


def brute_groups(rows):
    groups = {}
    for at, (i, t) in enumerate(rows):
        groups.setdefault(BLANK.sub("", t or ""), []).append((-len(t or ""), i is None, i or 0, at))
    return {k: (min(v), len(v)) for k, v in groups.items()}


def dedup_rows():
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        words = ["hot"] * 3 if i % 3 == 0 else [rnd.choice("abc") for _ in range(rnd.randint(0, 6))]
        rows.append((i, rnd.choice([" ", "\t", "\n\n", "\x0b"]).join(words) + " " * rnd.randint(0, 2)))
    return [*rows, (7, rows[7][1]), (7, rows[7][1]), (None, "hot hot hot        "), (None, None), (700, ""), (701, None), (702, "漢  字"), (703, "漢 字"), (704, "long " * 50_000), (-5, "long" * 50_000)]


@pytest.mark.parametrize("digits", [64, 1])
@pytest.mark.parametrize("limit", [200_000, 0])
def test_exact_dedup_equals_brute_force(spark, digits, limit):
    """Also with digests of one digit, which many texts share, and with every join shuffled."""
    rows = dedup_rows()
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, kept string, row int").repartition(5)
    out = exact_dedup.deduplicate(docs, digest=lambda c: F.substring(F.sha2(c, 256), 1, digits), salts=3, hot_share=20, broadcast_rows=limit)
    assert out.columns == ["doc_id", "text", "row", "keep_id", "group_size", "kept", "digest"]
    got, want = out.collect(), brute_groups(rows)
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        (chars, null, best, _), size = want[BLANK.sub("", r.text or "")]
        assert (r.keep_id, r.group_size, r.row) == (None if null else best, size, 1)
        if r.kept:
            kept.setdefault(BLANK.sub("", r.text or ""), []).append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    assert {k: [v[0][:3]] for k, v in want.items()} == kept
    assert exact_dedup.deduplicate(docs.limit(0)).count() == 0


def test_packed_numbers_hold_every_id(spark):
    ids = [0, 1, -1, 2**63 - 1, -(2**63), None]
    df = spark.createDataFrame([(c, i) for c in (0, 5, 2**31 - 1) for i in ids], "chars int, doc_id long")
    rows = df.withColumn("p", exact_dedup.packed(F.col("chars"), F.col("doc_id"))).withColumn("i", exact_dedup.packed_id(F.col("p"))).collect()
    assert all(r.i == r.doc_id for r in rows)
    order = [(r.chars, r.doc_id) for r in sorted(rows, key=lambda r: r.p, reverse=True)]
    assert order == sorted(order, key=lambda x: (-x[0], x[1] is None, x[1] or 0))


def test_contents_are_combined_before_any_shuffle(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text")).repartition(4)
    content = exact_dedup.normalised(F.col("text"))
    rows = docs.select(exact_dedup.digest_of(content).alias("digest"), content.alias("content"), exact_dedup.packed(F.length("text"), F.col("doc_id")).alias("best"))
    found = exact_dedup.combined(rows, rows.select("digest").distinct(), 2)
    assert [(r["size"],) for r in found.collect()] == [(1000,)]
    winners = found.inputFiles()
    assert 1 <= spark.read.parquet(*winners).count() <= 2


def test_repeated_and_very_long_rows_of_the_earlier_operators(spark):
    """Repeated rows come out alike and as often as they went in, very long ones whole."""
    from clipwise.llm import licenses, lm, mixing, pii, url_rules

    notice = licenses.TEMPLATES["GPL-3.0"]
    long = "word " * 60_000 + notice + " a@b.de"
    docs = spark.createDataFrame([(1, notice), (1, notice), (1, notice), (2, long), (3, None)], "doc_id long, text string")
    found = licenses.scan(docs).collect()
    assert [r.doc_id for r in found].count(1) == 3 and len({str(r) for r in found if r.doc_id == 1}) == 1
    assert [x.license for r in found if r.doc_id == 2 for x in r.licenses] == [x.license for r in found if r.doc_id == 1 for x in r.licenses][:1]

    spans = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert [tuple(s) for s in spans[2]][-1] == ("email", len(long) - 6, len(long)) and spans[3] == []

    scored = lm.score_texts(docs, F.lit(False)).collect()
    by_id = {i: {(r.n_tokens, r.n_known, r.base_score, r.score) for r in scored if r.doc_id == i} for i in (1, 2, 3)}
    assert len(scored) == 5 and len(by_id[1]) == 1 and next(iter(by_id[2]))[:2] == (len(long.split()) + 1,) * 2 and next(iter(by_id[3]))[0] == 1

    mixed = mixing.mix(docs.withColumn("source", F.lit("s"))).collect()
    assert sorted(r["size"] for r in mixed) == sorted([len(notice.split())] * 3 + [len(long.split()), 0])

    far = "http://a.Example.com/en/" + "x/" * 50_000
    pages = spark.createDataFrame([(1, far), (1, far), (2, "http://b.net/fr/" + "y" * 100_000)], "page_id long, url string")
    judged = url_rules.judge(pages, spark.createDataFrame([], "page_id long, label string")).collect()
    assert sorted((r.page_id, r.host, r.rule, r.verdict) for r in judged) == [(1, "a.example.com", "example.com/en/", "block")] * 2 + [(2, "b.net", "net/fr/", "block")]
