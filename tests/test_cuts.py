"""Interval joins by dyadic blocks, and greedy cuts by doubling against the fold."""

import random

import pytest
from clipwise.operators import greedy, timeline
from pyspark.sql import functions as F

WORDS = "lecture int, id long, start double, end double, stops boolean"


def random_words(seed):
    """Overlaps, ties, nested turns and durations that hit the limits."""
    rnd, rows = random.Random(seed), []
    for lecture in range(16):
        t = 0.0
        for i in range(rnd.choice([1, 2, 30, 80])):
            t = rnd.choice([t, t + 0.1 * rnd.randint(0, 30), t + rnd.random() * 3, round(t + rnd.choice([9.0, 20.0, 15.0, 0.3]), 1)])
            rows.append((lecture, i, t, t + rnd.choice([0.1, 0.3, 1.0, 9.0, 20.0, 15.0, 25.0, rnd.random() * 5, 31.0]), rnd.random() < 0.3))
    return rows


def by_loop(rows, least=9.0, most=20.0):
    out, open_ = [], None
    for i, (_, _, start, end, stops) in enumerate(rows):
        open_ = open_ or (i, start)
        if end - open_[1] >= most or (stops and end - open_[1] >= least) or i == len(rows) - 1:
            if 4.0 <= end - open_[1] <= 30.0:
                out.append((open_[0], i, open_[1], end))
            open_ = None
    return out


def test_doubling_equals_the_fold(spark):
    rows = random_words(1)
    words = spark.createDataFrame(rows, WORDS).repartition(3).cache()
    want = []
    for lecture in range(16):
        own = sorted((r for r in rows if r[0] == lecture), key=lambda r: (r[2], r[3], r[1]))
        want += [(lecture, *c) for c in by_loop(own)]
    for limit in (20_000, 40):
        assert sorted(map(tuple, timeline.greedy_clips(words, fold_rows=limit).collect())) == want
    packs = [sorted(map(tuple, timeline.pack_segments(words, fold_rows=limit).collect())) for limit in (20_000, 40)]
    assert packs[0] == packs[1] and packs[0]


def test_a_long_recording_isnt_gathered(spark):
    n = 20_000
    words = spark.range(n).select(F.lit(1).alias("lecture"), "id", (F.col("id") * 0.4).alias("start"), (F.col("id") * 0.4 + 0.3).alias("end"), (F.col("id") % 9 == 0).alias("stops"))
    rows = [(1, i, i * 0.4, i * 0.4 + 0.3, i % 9 == 0) for i in range(n)]
    out = timeline._chained_clips(words, 9.0, 20.0, (4.0, 30.0), ("lecture",))
    assert "collect_list" not in out._jdf.queryExecution().toString()
    assert [tuple(r) for r in out.orderBy("first").select("first", "last", "start", "end").collect()] == by_loop(rows)


@pytest.mark.parametrize("start", [0.0, 1e-9, 0.1, 3.0, 91.0, 1e5 / 3, 2.0**20, 1e9 + 0.7])
@pytest.mark.parametrize("strict", [True, False])
def test_thresholds_are_the_least_double(spark, start, strict):
    import math

    for limit in (9.0, 15.0, 20.0, 0.1):
        rule = greedy.Rule(limit, strict)
        x = spark.range(1).select(rule.threshold(F.lit(start))).first()[0]
        reached = lambda e: e - start > limit if strict else e - start >= limit  # noqa: E731, B023
        assert reached(x) and not reached(math.nextafter(x, 0))


def test_a_span_of_a_million_bins(spark):
    """Few rows a span, and the pairs of a nested loop."""
    long = spark.createDataFrame([(1, 0, 0.0, 1e6), (1, 1, 5.0, 5.0), (2, 2, -3.0, 4.0), (1, 3, None, 2.0), (None, 4, 0.0, 1.0)], "lecture int, i long, a double, b double")
    points = spark.range(2000).select(F.lit(1).alias("lecture"), F.col("id").alias("j"), (F.col("id") * 600.0).alias("c"), (F.col("id") * 600.0 + 1).alias("d"))
    pairs = timeline.range_join(long, points, ("a", "b"), ("c", "d"), (F.col("a") <= F.col("d")) & (F.col("c") <= F.col("b")), 1.0)
    assert sorted((r.i, r.j) for r in pairs.collect()) == [(0, j) for j in range(1667)]
    cover = F.expr(timeline._COVER.format(low="a", high="b", side=0))
    for a, b in ((0, 10**6), (3, 10**6), (-7, 999_983), (5, 6), (-1, 1)):
        blocks = [(x.level, x["at"]) for x in spark.createDataFrame([(a, b)], "a long, b long").select(cover).first()[0]]
        assert len(blocks) <= 2 * 20
        assert sorted((at << k, (at + 1) << k) for k, at in blocks)[0][0] == a and sum(1 << k for k, _ in blocks) == b - a


@pytest.mark.parametrize("width", [0.3, 8.0])
def test_range_join_equals_a_nested_loop(spark, width):
    rnd = random.Random(5)
    make = lambda n, far: [(rnd.randint(1, 2), i, (a := round(rnd.uniform(-50, 50), 1)), a + rnd.choice([0, 0.5, 3, 20, far, -4])) for i in range(n)]
    left, right = make(60, 90), make(60, 300)
    l, r = spark.createDataFrame(left, "lecture int, i long, a double, b double"), spark.createDataFrame(right, "lecture int, j long, c double, d double")
    touch = (F.least("a", "b") <= F.greatest("c", "d")) & (F.least("c", "d") <= F.greatest("a", "b"))
    got = sorted((x.i, x.j) for x in timeline.range_join(l, r, ("a", "b"), ("c", "d"), touch, width).collect())
    assert got == sorted((x[1], y[1]) for x in left for y in right if x[0] == y[0] and min(x[2:]) <= max(y[2:]) and min(y[2:]) <= max(x[2:]))
    assert timeline.range_join(l.limit(0), r, ("a", "b"), ("c", "d"), touch, width).count() == 0
