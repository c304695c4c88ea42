import random

import numpy as np
import pyarrow as pa
from clipwise.llm import jaccard as J

SCHEMA = "doc_id long, text string, component_id string"


def brute(rows, width, percent):
    sets = []
    for i, text in rows:
        ws = (text or "").encode().lower().split()
        n = min(width, len(ws))
        sets.append((i, {tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)} if ws else set()))
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def got(spark, rows, width, percent):
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    out = J.components(df, width=width, percent=percent)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 5000}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two"), (None, "one two"), (8, long), (9, long + " x"), (10, "É a b"), (11, "é a b"), (6, "one two")]
    assert got(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_empty_table(spark):
    assert got(spark, [], 3, 90) == []


def test_repeated_id_with_another_text(spark):
    rows = [(3, "a b c d"), (9, "a b c d"), (9, "p q r s t"), (12, "p q r s t"), (20, "z z z")]
    assert got(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_chains_of_near_copies(spark):
    rnd = random.Random(3)
    rows, n = [], 0
    for _ in range(12):
        ws = [f"v{rnd.randrange(400)}" for _ in range(rnd.choice([12, 40, 90, 200]))]
        for _ in range(rnd.randrange(1, 12)):
            rows.append((n, " ".join(ws)))
            n += 1
            for _ in range(rnd.randrange(0, 3)):
                ws[rnd.randrange(len(ws))] = f"v{rnd.randrange(400)}"
    rnd.shuffle(rows)
    for width, percent in ((3, 90), (5, 80)):
        assert got(spark, rows, width, percent) == brute(rows, width, percent)


def test_small_tiles_find_the_same(spark):
    base = [f"u{i}" for i in range(120)]
    rows = []
    for i in range(60):
        ws = list(base)
        for k in range(i % 4):
            ws[(i * 7 + k * 31) % 120] = f"x{i}{k}"
        rows.append((i, " ".join(ws)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links = J.representative_links(df, 3, 80, every=True, tile_docs=8).distinct().collect()
    sets = {i: set(zip(*[t.split()[k:] for k in range(3)], strict=False)) for i, t in rows}
    want = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in links} == want


def test_bands_lose_no_pair():
    rnd = np.random.default_rng(5)
    for percent in (80, 90):
        bands = J.Bands(percent)
        for n in (10, 11, 17, 30, 56, 57, 85, 86, 300, 1000):
            for _ in range(20):
                a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
                drop = rnd.integers(0, max(1, int(n * (1 - percent / 100))) + 1)
                keep = np.delete(a, rnd.choice(len(a), drop, replace=False))
                b = np.unique(np.concatenate([keep, rnd.integers(0, 2**63, rnd.integers(0, drop + 1), dtype=np.uint64)]))
                common = len(np.intersect1d(a, b))
                if len(b) and len(b) != common and J.linked(len(a), len(b), common, percent):
                    assert np.intersect1d(bands.signatures(a), bands.signatures(b)).size


def test_large_clusters_in_rounds(spark, monkeypatch):
    """With tiles of a few sets every cluster is a large one; components must be those of brute force."""
    real = J.representative_links
    monkeypatch.setattr(J, "representative_links", lambda d, w, p, **k: real(d, w, p, tile_docs=4, tile_shingles=1500))
    rnd = random.Random(11)
    rows, n = [], 0
    for _ in range(5):
        base = [f"v{rnd.randrange(3000)}" for _ in range(rnd.choice([30, 80, 120]))]
        ws = list(base)
        for _ in range(26):
            rows.append((n, " ".join(ws)))
            n += 1
            ws = list(ws if rnd.random() < 0.7 else base)
            for _ in range(rnd.choice([1, 1, 2, 6])):
                ws[rnd.randrange(len(ws))] = f"x{rnd.randrange(3000)}"
    want = {(w, p): brute(rows, w, p) for w, p in ((3, 90), (5, 80))}
    for (width, percent), w in want.items():
        assert got(spark, rows, width, percent) == w
    monkeypatch.setattr(J, "representative_links", lambda d, w, p, **k: real(d, w, p, tile_docs=24, tile_shingles=3000))
    for (width, percent), w in want.items():
        assert got(spark, rows, width, percent) == w


def test_hot_keys_are_split(spark):
    """The joins of a star round and of sets with their plan are of plain shuffles, which AQE splits."""
    from clipwise.llm.common import connected_components

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.shuffle.partitions": "16",
        "spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    plans = []
    from clipwise.llm import common

    real = common.materialize

    def noted(df, name):
        out = real(df, name)
        if name == "large-star":
            df.foreachPartition(lambda rows: None)
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        edges = spark.range(1, 40_000).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE 0 END AS a", "id + 1 AS b")
        common.materialize = noted
        found = {r.component for r in connected_components(edges, split_edges=0).select("component").distinct().collect()}
    finally:
        common.materialize = real
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert 0 in found and any("skew=true" in p for p in plans)


def _brute_counts(rows: list[tuple[int | None, str | None]], width: int, percent: int) -> list[int]:
    def of(text: str | None) -> frozenset:
        ws = (text or "").lower().split()
        n = min(width, len(ws))
        return frozenset(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) if ws else frozenset()

    sets = [of(t) if i is not None else frozenset() for i, t in rows]
    return [sum(1 for j, b in enumerate(sets) if j != i and a and b and 100 * len(a & b) >= percent * len(a | b)) for i, a in enumerate(sets)]


def test_link_counts_are_those_of_brute_force(spark):
    rng = random.Random(5)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(90)) for _ in range(60)] for _ in range(4)]
    texts: list[str | None] = [None, "", " ", "one two"]
    for _ in range(120):
        ws = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            ws[rng.randrange(60)] = "x" + str(rng.randrange(5))
        texts.append(" ".join(ws))
    texts += ["one two", texts[10], texts[10]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[10])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.components(docs, width=3, percent=80, count_links=True).collect()
    expected = dict(zip([i for i, _ in rows], _brute_counts(rows, 3, 80), strict=True))
    assert {r["doc_id"]: r["n_links"] for r in got} == expected
    assert max(expected.values()) > 3 and expected[None] == 0
    assert J.components(docs.where("false"), width=3, percent=80, count_links=True).count() == 0


def test_link_counts_compare_each_pair_of_slices_once(spark):
    rng = random.Random(6)
    sets = []
    for i in range(90):
        s = set(range(40 + i % 7)) - {rng.randrange(40) for _ in range(rng.randrange(4))}
        sets.append(np.unique(J.mix(np.array(sorted(s), np.uint64))))
    copies = [1 + i % 3 for i in range(90)]
    rows = [(7, i, len(s), c, bytearray(s.tobytes())) for i, (s, c) in enumerate(zip(sets, copies, strict=True))]
    df = spark.createDataFrame(rows, "cluster long, node long, n long, copies long, set binary")
    expected = {}
    for i, a in enumerate(sets):
        common = [len(np.intersect1d(a, b)) for b in sets]
        expected[i] = sum(c for j, c in enumerate(copies) if j != i and J.linked(len(a), len(sets[j]), common[j], 90))
    for docs in (8, 1024):
        got = {r["node"]: r["links"] for r in J.link_counts(df, 90, tile_docs=docs).collect()}
        assert {i: got.get(i, 0) for i in expected} == expected


def test_tile_counts_are_those_of_all_pairs():
    """Near copies, which share most shingles, beside unrelated sets, empty forms and both ways of intersecting."""
    rnd = np.random.default_rng(3)
    for trial in range(12):
        base = rnd.choice(1 << 40, 60, replace=False).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[rnd.random(60) > 0.05], rnd.choice(1 << 40, rnd.integers(0, 5)).astype(np.uint64)])) for _ in range(40)]
        sets += [base.copy(), base.copy()] + [np.unique(rnd.choice(1 << 40, rnd.integers(1, 80)).astype(np.uint64)) for _ in range(rnd.choice([0, 30, 200]))]
        rnd.shuffle(sets)
        copies, side = rnd.integers(1, 4, len(sets)), rnd.integers(0, 2, len(sets))
        for whole in (True, False):
            want = np.zeros(len(sets), int)
            for i, x in enumerate(sets):
                for j, y in enumerate(sets):
                    n = len(np.intersect1d(x, y))
                    if i != j and (whole or side[i] != side[j]) and 100 * n >= 90 * (len(x) + len(y) - n):
                        want[i] += copies[j]
            assert J.tile_counts(sets, copies, side, whole, 90).tolist() == want.tolist()


def test_stars_join_the_sets_of_a_signature():
    """Sets of one signature are connected, few of them meet across batches, and nothing else is connected."""
    rnd = random.Random(8)
    rows = [(7, i) for i in range(300)] + [(8, 5), (8, 900), (9, 901), (901, 902), (901, 903)]
    rnd.shuffle(rows)
    parts = [rows[a : a + 100] for a in range(0, len(rows), 100)]
    batches = [J._combined(np.array([s for s, _ in p]), np.array([n for _, n in p])) for p in parts]
    whole = pa.Table.from_batches(batches).sort_by("sig")
    assert sum(1 for r in whole.to_pylist() if r["sig"] == 7 and r["lead"] is None) <= len(parts)
    edges = [(r["a"], r["b"]) for b in J._stars(iter(whole.to_batches(max_chunksize=37))) for r in b.to_pylist()]
    root = {n: n for _, n in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        root[find(a)] = find(b)
    groups = {}
    for n in root:
        groups.setdefault(find(n), set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted([sorted({*range(300), 900}), [901], [902, 903]])
