"""The pipeline on a small fixture with planted cases, stage by stage against brute force."""

import corpus_pipeline
import pytest
from test_free import brute as personal
from test_jaccard import brute as grouped
from test_native import hits

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    clean = [" ".join(f"c{i}x{j % 37}y{j % 11}" for j in range(60)) for i in range(40)]
    item = " ".join(f"item{j}" for j in range(16))
    docs = [(i, t) for i, t in enumerate(clean)]
    docs += [(100 + i, f"you blarg {i} what a blarg you utter blarg") for i in range(40)]
    docs += [(200, clean[3]), (201, clean[4] + " tail"), (3, clean[3]), (202, "pre " + item + " post"), (203, "mail a.b@c.de or +1 (212) 555-0147 now " + clean[9][::-1])]
    docs += [(300, None), (301, ""), (None, "no id here"), (302, "w " * 30000)]
    rows = [(i, t, "en", None if k % 9 == 0 else f"s{k % 4}", len(t or "")) for k, (i, t) in enumerate(docs)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = [(i, 1, int(i >= 100)) for i in [*range(0, 40, 2), *range(100, 140, 2)]] + [(None, 1, 1), (5, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = [(r.doc_id, r.text) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        assert out.columns[:5] == COLUMNS and (k == 4 or out.columns == COLUMNS)
        out.write.parquet(path := str(tmp_path / name))
        docs = spark.read.parquet(path)
        after = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "toxicity":
            assert sorted(after, key=repr) == sorted(((i, t) for i, t in before if i is None or not 100 <= i < 140), key=repr)
        if name == "near_duplicates":
            stay = {i for i, _, c in grouped(list(dict.fromkeys(before)), 5, 80) if i == c}
            assert sorted(after, key=repr) == sorted(dict.fromkeys((i, t) for i, t in before if i in stay or i is None), key=repr)
            assert {200, 201}.isdisjoint(i for i, _ in after)
        if name == "decontamination":
            bad = {i for i, _, n, _ in hits(before, [(1, " ".join(f"item{j}" for j in range(16)))]) if n}
            assert bad == {202} and sorted(after, key=repr) == sorted(((i, t) for i, t in before if i not in bad), key=repr)
        if name == "personal_data":
            assert len(after) == len(before) and not any(personal(t or "") for _, t in after)
            assert dict(after)[203].startswith("mail [EMAIL] or [PHONE] now ") and sum(x != y for x, y in zip(sorted(before, key=repr), sorted(after, key=repr), strict=True)) == 1
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in docs.collect())
        if name == "source_mix":
            assert {i for i, _ in after} <= {i for i, _ in before}
            assert all(1 <= r["copy"] <= r.copies <= 3 for r in docs.collect())
        before = after


def test_run(spark, folder):
    first, second = (sorted(map(str, corpus_pipeline.run(spark, folder).collect())) for _ in range(2))
    assert first == second and first


def test_empty(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
