"""What the operators must do beyond their contracts' columns."""

import gzip
import itertools
import os
import random
import re
import time
from collections import Counter
from statistics import NormalDist

import corpus_pipeline
import numpy as np
import pytest
from clipwise.llm import decontaminate, lm, pii, topk, toxicity, url_rules, warc
from pyspark.sql import functions as F
from test_jaccard import brute as grouped


def test_words_outside_the_head_have_factors(spark):
    # raxyz and zuxyz share their class (last three letters) and count; only their neighbours differ.
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["one raxyz two", "three zuxyz four"]) for _ in range(4))) for i in range(150)]
    asked = ["one raxyz two", "one zuxyz two", "three zuxyz four", "three raxyz four"]
    docs = spark.createDataFrame(rows + [(-1 - k, t) for k, t in enumerate(asked)], "doc_id long, text string")
    out = lm.score_texts(docs, F.col("doc_id") < 0, lm.Settings(head=4, rest=8, block_bytes=2000))
    score = {-1 - r.doc_id: r.score for r in out.where("doc_id < 0").collect()}
    assert score[0] > score[1] + 1 and score[2] > score[3] + 1


def test_lm_factors_grow_with_the_input(spark, monkeypatch):
    made = []
    real = lm.word_factors
    monkeypatch.setattr(lm, "word_factors", lambda *a: made.append(real(*a)) or made[-1])
    for words in (100, 400):
        docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k) % words}q" for k in range(words))) for i in range(20)], "doc_id long, text string")
        lm.score_texts(docs, F.lit(False), lm.Settings(head=10, rest=8)).count()
    assert [f.where("name is not null").count() for f in made] == [90, 390]


def test_url_rules_stay_as_the_table_grows(spark):
    for others in (100, 12_000):
        urls = [f"http://rare.org/pills/{i}" for i in range(20)] + [f"http://good.org/news/{i}" for i in range(others)]
        pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        labels = pages.select("page_id", F.when(F.col("page_id") < 20, "block").otherwise("allow").alias("label"))
        assert url_rules.judge(pages, labels).where("verdict = 'block'").count() == 20


def test_url_rules_against_brute_force(spark):
    """All subsets of tokens, their counts and z, against FP-growth over merged tokens."""
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        host, path = rnd.choice("abc"), rnd.choice(["x", "y", "x/z"])
        keys = [k for k in "pqr" if rnd.random() < 0.5]
        bad = rnd.random() < (0.85 if host == "a" and "p" in keys else 0.6 if path == "y" else 0.15)
        rows.append((i, f"http://{host}.org/{path}/?" + "&".join(f"{k}=1&{k}2=1" for k in keys), "block" if bad else "allow"))
    pages = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3], "page_id long, label string")
    got = {r.page_id: r.verdict for r in url_rules.judge(pages, labels, min_rows=15).collect()}
    h, p, q = url_rules.parts(F.col("url"))
    tokens = {r.page_id: frozenset(r.t) for r in pages.select("page_id", url_rules.url_tokens(h, p, q).alias("t")).collect()}
    train = [(tokens[i], y) for i, _, y in rows if i % 3]
    base = Counter(y for _, y in train)
    n = len(train)
    often = [t for t in set().union(*(s for s, _ in train)) if sum(t in s for s, _ in train) >= 15]
    where = {t: frozenset(k for k, (s, _) in enumerate(train) if t in s) for t in often}
    merged: dict = {}
    for t in sorted(often):
        merged.setdefault(where[t], t)
    rules = []
    names = sorted(merged.values())
    for size in range(1, len(names) + 1):
        for c in itertools.combinations(names, size):
            at = frozenset.intersection(*(where[t] for t in c))
            for y in base:
                k = sum(train[i][1] == y for i in at)
                if k >= 15:
                    share = base[y] / n
                    rules.append((frozenset(c), y, k / len(at), k, (k / len(at) - share) / (share * (1 - share) / len(at)) ** 0.5))
    least = NormalDist().inv_cdf(1 - 0.05 / len(rules))
    of = {t: merged[where[t]] for t in often}
    blocked = 0
    for i, _, _ in rows:
        own = {of[t] for t in tokens[i] if t in of}
        fits = [(round(z, 9), conf, k, y) for c, y, conf, k, z in rules if z >= least and c <= own]
        best = max(fits)[3] if fits else "allow"
        assert got[i] == best
        blocked += best == "block"
    assert 50 < blocked < 350


def test_url_rules_with_many_shared_keys(spark):
    urls = [f"http://h{i % 4}.org/a?" + "&".join(f"k{j}=1" for j in range(25)) for i in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = pages.select("page_id", F.when(F.col("page_id") % 4 == 0, "block").otherwise("allow").alias("label"))
    began = time.time()
    out = url_rules.judge(pages.union(pages), labels)
    assert out.groupBy("verdict").count().where("verdict = 'block' and count = 100").count() == 1 and time.time() - began < 60
    assert url_rules.judge(pages.where("false"), labels).count() == 0
    long = spark.createDataFrame([(1, "http://a.org/" + "x/" * 20_000)], "page_id long, url string")
    assert url_rules.judge(long, labels).first().verdict == "allow"


def test_url_labels_without_meaning_give_no_rules(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 5}.org/{i % 7}x/?k{i % 3}=1") for i in range(700)], "page_id long, url string")
    labels = pages.select("page_id", F.when(F.pmod(F.xxhash64("page_id"), F.lit(4)) == 0, "block").otherwise("allow").alias("label"))
    assert url_rules.judge(pages, labels).where("mined is not null").count() == 0


def spelled_out(words, insults):
    """The grammar by its rules, a clause at a time, without transducers."""
    fixed = {w: c for c, ws in toxicity.SEEDS.items() for w in ws.split() if c != toxicity.INSULT}
    cls = lambda w: fixed.get(w, toxicity.INSULT if w in insults else toxicity.OTHER)
    near = lambda i, kind, reach: any(cls(w) == kind for w in words[max(0, i - reach) : i])
    score = 0.0
    for i, w in enumerate(words):
        said = 0.5 if any(cls(x) == toxicity.REPORT for x in words[:i]) else 1.0
        if cls(w) == toxicity.INSULT:
            score += insults[w] * said * (1.25 if near(i, toxicity.TARGET, 4) else 1.0) * (0.3 if near(i, toxicity.NEGATION, 3) else 1.0)
        if cls(w) == toxicity.TARGET and near(i, toxicity.THREAT, 4):
            score += 2.0
    return score


def test_toxicity_clauses_against_spelled_out_rules():
    rnd = random.Random(6)
    insults = {"blarg": 3.0, "florp": 1.5}
    pool = ["blarg", "florp", "you", "kill", "not", "said", "tree", "river"]
    scorer = toxicity.Scorer(toxicity.Model(dict(insults)))
    for _ in range(3000):
        clauses = [[rnd.choice(pool) for _ in range(rnd.randrange(0, 9))] for _ in range(rnd.randrange(1, 4))]
        found, count = scorer.clauses(". ".join(" ".join(c) for c in clauses))
        want = [s for c in clauses if (s := spelled_out(c, insults)) > 0]
        assert np.allclose(found, want) and (not want or count == sum(map(bool, clauses)))


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are absent")
def test_toxicity_is_decided_by_clauses(spark):
    """On held-out labels the grammar's features alone find what they did, and negation and report lower a learned insult's score."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.where(~toxicity.held_out()), labels)
    out = toxicity.score(docs.where(toxicity.held_out()).join(labels, "doc_id").select("doc_id", "text", "toxic"), model).select("toxic", "score").collect()
    caught = sum(r.score >= 0.7 for r in out if r.toxic)
    assert caught >= 0.9 * sum(r.toxic for r in out) and sum(r.score >= 0.7 for r in out if not r.toxic) <= 1
    scorer = toxicity.Scorer(model)
    score = lambda t: scorer.probability(np.array([scorer.features(t)]))[0]
    for insult in ("idiot", "moron", "trash"):
        assert score(f"you {insult}") >= score(f"a {insult}") > score(f"not a {insult}") > score("not a tree")
        assert score(f"he said a {insult}") < score(f"a {insult}")


HELD_OUT = """
drop a line to {email:mary (at) example (dot) org} tonight
her mail , {email:p.ross (at) mail4.example.com} , is full
use {email:zed [at] example [dot] com} instead
or {email:kim at example dot net} if you can
schreib an {email:ida (at) post (punkt) de} bald
mail {email:josé (arroba) correo (punto) es} mañana
try {email:n.ng@mail1.example.com} first
old card {card:4539.1488.0343.6467} is void
she used {card:4716/1085/9990/7720} there
my {card:6011_0009_9013_9424} was lost
billed to {card:5105105105105100} yesterday
phone {phone:646-555-0199} at night
the clinic {phone:(617) 555-0123} is closed
ruf {phone:0172 9876543} an
book at {phone:020 7123 4567} soon
call {phone:555-0188} first
tel {phone:0041 44 668 18 00} bern
mobil {phone:650.555.0110} only
host {ip:10.1.2.3} is up
dial {phone:+1 (303) 555-0101} again
we sat at the bar and talked
there is a dot on page 7
meet at nine , or at 10:30 sharp
version 3.11.2 came on 2023-04-05
order 7777888899990000 is open
code 5678.1234.9012.0000 failed
from 1990 to 1995 and 2001-2005
see 12/31 and 01/02 of 2019
the ratio 3/2 of 40 people
won 21-15 21-18 in 45 minutes
lot 4021_7788 was sold for 300
paragraph 4.2.1 of act 12
the end (at last) came in 1999
a key d41d8cd98f00b204e9800998ecf8427e here
licensed under cc by-nc 4.0 there
pages 120 and 7946 were cut
"""


def test_pii_on_held_out_lines():
    """The model against the patterns alone, on lines that it wasn't trained on."""
    hits, base_hits, found, base_found, wanted = 0, 0, 0, 0, 0
    for line in filter(None, HELD_OUT.splitlines()):
        text, gold, at = "", set(), 0
        for m in re.finditer(r"\{(\w+):([^}]*)\}", line):
            text += line[at : m.start()]
            gold.add((len(text), pii.KINDS.index(m[1]), len(text) + len(m[2])))
            text += m[2]
            at = m.end()
        ((base, spans),) = pii.all_spans([text + line[at:]], pii.trained())
        wanted += len(gold)
        hits, base_hits = hits + len(gold & set(spans)), base_hits + len(gold & set(base))
        found, base_found = found + len(spans), base_found + len(base)
    assert hits / wanted >= 0.9 and hits / found >= 0.9 and base_hits / wanted <= 0.3


def test_viterbi_against_all_paths():
    model = pii.trained()
    k = len(pii.TAGS)
    for words in (["card", "4111.1111.1111.1111", "x"], ["jane", "(at)", "example.com"], ["+1", "(212)", "555-0147"], ["call", "555-0188", "7"]):
        feats = pii.features(words)
        emit = [model.emit[[model.index[f] for f in fs if f in model.index]].sum(axis=0) for fs in feats]

        def score(path, emit=emit):
            return model.move[k, path[0]] + sum(model.move[a, b] for a, b in itertools.pairwise(path)) + sum(e[t] for e, t in zip(emit, path, strict=True))

        best = max(itertools.product(range(k), repeat=len(words)), key=score)
        assert np.isclose(score(best), score(tuple(model.decode([words])[0])))


def test_archives_are_a_member_a_record(spark, tmp_path):
    rows = [(1, "http://a/", "x" * 5000), (2, "http://b/", "x" * 5000), (2, "http://b/", "x" * 5000), (None, None, "y"), (4, "http://c/", "")] + [(10 + i, "http://d/", f"page {i} " * 300) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    resolved = warc.resolve(pages)
    warc.write_archives(resolved, str(tmp_path / "w"), file_bytes=8000, chunk_bytes=4000)
    files = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    ids, members = [], 0
    for f in files:
        data, at = f.read_bytes(), 0
        assert len(data) <= 8000 + 4000
        while at < len(data):
            end = data.find(b"\x1f\x8b\x08", at + 1)
            while True:  # a member ends where the next one begins
                try:
                    record = gzip.decompress(data[at : end if end >= 0 else len(data)])
                    break
                except (EOFError, OSError):
                    end = data.find(b"\x1f\x8b\x08", end + 1)
            if record:
                members += 1
                assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
                ids.append(re.search(rb"WARC-Record-ID: (.*?)\r\n", record)[1])
                if b"WARC-Type: revisit" in record:
                    assert b"WARC-Refers-To-Target-URI: http://a/" in record and b"WARC-Refers-To-Date: " in record
            at = end if end >= 0 else len(data)
    assert members == len(rows) == len(set(ids)) and len(files) > 2
    out = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in out if r.page_id in (1, 2)) == Counter([(1, "response", None), (2, "revisit", 1), (2, "revisit", 1)])


def test_archive_payloads_stay_where_they_are(spark):
    """Only headers are shuffled: no exchange carries a payload."""
    pages = spark.createDataFrame([(i, "u", "same" if i % 2 else f"p{i}") for i in range(50)], "page_id long, url string, html string")
    plan = warc.resolve(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not any("Exchange hashpartitioning" in line and "payload_digest" in line for line in plan.splitlines())
    both = [sorted(map(str, warc.resolve(pages, broadcast_rows=n).drop("copy").collect())) for n in (0, 1000)]
    assert both[0] == both[1]


def test_repeated_first_pages_have_one_response(spark):
    rows = [(1, "u", "same")] * 5 + [(2, "v", "same"), (3, "w", "other")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.resolve(pages).collect())
    assert got == Counter({(1, "response", None): 1, (1, "revisit", 1): 4, (2, "revisit", 1): 1, (3, "response", None): 1})


def test_equal_rows_are_searched_once(spark):
    """k rows with one id and text give one posting a term, not k, so their lists don't meet in k * k pairs."""
    item = " ".join(f"t{i}" for i in range(12))
    docs = spark.createDataFrame([(7, f"a {item} b")] * 4000 + [(8, "plain")], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    began = time.time()
    out = decontaminate.find(docs, items, keep=("doc_id",)).groupBy("doc_id", "n_hit").count().collect()
    assert sorted(map(tuple, out)) == [(7, 12, 4000), (8, 0, 1)] and time.time() - began < 60
    keyed = docs.select(F.md5("text").alias("_key"), decontaminate.words(F.col("text")).alias("ws"))
    wins = decontaminate.windows(items, 10)
    terms = wins.select(F.explode(F.split("w", " ")).alias("term"))
    posted = decontaminate.postings(keyed, terms, 1000)
    assert posted.count() == 12
    anchored = decontaminate.rarest(wins, decontaminate.list_lengths(keyed, terms, 1000))
    assert decontaminate.candidates(posted, anchored).count() == 3


def test_topk_takes_extra_columns_and_repeated_ids(spark):
    rows = [(1, [1, 0]), (1, [0, 1]), (1, [5, 5]), (2, [2, 2]), (3, [1, 1])]
    df = spark.createDataFrame([(*r, "c", 9) for r in rows], "vec_id long, vector array<long>, shard string, dim int")
    got = sorted(map(tuple, topk.search(df, df.where("vec_id = 2"), k=4).collect()))
    assert got == [(2, 1, 1, 20), (2, 2, 3, 4), (2, 3, 1, 2), (2, 4, 1, 2)]


def test_lm_beats_the_unigram_on_held_out_texts(spark):
    rnd = random.Random(2)
    after = {f"w{i}": [f"w{(i * 3 + k) % 40}" for k in range(3)] for i in range(40)}

    def text():
        w, out = "w0", []
        for _ in range(40):
            out.append(w)
            w = rnd.choice(after[w])
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(300)] + [(900, "long " * 60_000)], "doc_id long, text string")
    out = lm.score_texts(docs, F.col("doc_id") >= 250, lm.Settings(head=20, rest=8)).where("held_out and doc_id < 900").collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.3 * sum(r.n_tokens for r in out)


EXTRA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words string, items string, size string, target string, copies string, `a.b` int"


def test_stages_keep_columns_and_texts(spark, tmp_path):
    """Columns named like an operator's come out as they went in, and different texts under one id all stay."""
    clean = [" ".join(f"c{i}x{j % 37}y{j % 11}" for j in range(60)) for i in range(12)]
    texts = [(i, t) for i, t in enumerate(clean)] + [(3, clean[0][::-1]), (3, clean[0][::-1]), (4, None), (None, clean[5]), (5, "mail a.b@c.de now"), (50, clean[2] + " tail"), (2, "another text under the same id as before")]
    texts += [(100 + i, f"you blarg {i} what a blarg you utter blarg") for i in range(20)]
    rows = [(i, t, "en", "s", len(t or ""), 0.125, "w", "it", "sz", "tg", "cp", 7) for i, t in texts]
    docs = spark.createDataFrame(rows, EXTRA)
    spark.createDataFrame([(i, 1, int(i >= 100)) for i in [*range(0, 12), *range(100, 120)]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    before = [(r.doc_id, r.text) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns[: len(docs.columns)] == docs.columns and (k == 4 or len(out.columns) == len(docs.columns))
        out.write.parquet(path := str(tmp_path / f"out-{name}"))
        docs = spark.read.parquet(path)
        got = docs.collect()
        assert all((r.score, r.n_words, r["items"], r.size, r.target, r.copies, r["a.b"]) == (0.125, "w", "it", "sz", "tg", "cp", 7) for r in got)
        after = [(r.doc_id, r.text) for r in got]
        if name == "near_duplicates":
            # Each text under an id is a document; the null id is in no group.
            nodes = list(dict.fromkeys((i, t) for i, t in before if i is not None))
            comps = grouped([(n, t) for n, (_, t) in enumerate(nodes)], 5, 80)
            best = {}
            for n, _, c in comps:
                best[c] = min(best.get(c, nodes[n]), nodes[n], key=lambda x: x[0])
            want = sorted([best[c] for c in best] + [x for x in before if x[0] is None], key=repr)
            assert sorted(after, key=repr) == want and {i for i, _ in after} >= {3, 2} and 50 not in {i for i, _ in after}
            assert sum(i == 3 for i, _ in after) == 2
        if name == "source_mix":
            assert {"mix_size", "mix_target", "mix_copies", "source_size", "copy"} <= set(docs.columns)
        before = after


def test_clauses_decide_where_labels_bear_on_them(spark):
    """Both classes have the same words, in toxic texts the insult is aimed, in others denied: sums over words can't tell them apart, clauses can."""
    rnd = random.Random(4)
    filler = [f"word{i}" for i in range(60)]

    def text(toxic):
        out = []
        for _ in range(8):
            insult = rnd.choice(["idiot", "moron", "scum"])
            aimed, denied = (insult, rnd.choice(filler)) if toxic else (rnd.choice(filler), insult)
            out += [f"you are {aimed}", f"{rnd.choice(filler)} is not {denied}"]
        return ". ".join(out)

    rows = [(i, text(i % 2), i % 2) for i in range(240)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs.where("doc_id < 160"), labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.7) == (y == 1) for i, _, y in rows if i >= 160)

    scorer = toxicity.Scorer(model)
    sums = []
    for _, t, _ in rows:
        found = [scorer.weights[w] for w in toxicity.TOKEN.findall(t.lower()) if (scorer.classes.get(w) or scorer._class(w)) == toxicity.INSULT]
        sums.append([np.log1p(sum(found)), max(found), len(found) / 100])
    x, y = np.array(sums), np.array([y for *_, y in rows], float)
    coef, center, scale = toxicity._fit(x[:160], y[:160])
    by_words = 1 / (1 + np.exp(-(coef[0] + ((x[160:] - center) / scale) @ coef[1:])))
    assert ((by_words >= 0.5) == (y[160:] == 1)).mean() < 0.75
