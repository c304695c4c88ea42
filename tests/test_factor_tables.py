"""The tables that the fit of factors writes on its way."""

from collections import defaultdict

import pytest

from clipwise.operators import factors


def test_users_biases_are_read_from_the_residuals(spark, monkeypatch):
    plans, write = {}, factors.materialize
    monkeypatch.setattr(factors, "materialize", lambda df, to: (plans.update({to: df._jdf.queryExecution().optimizedPlan().toString()}), write(df, to))[1])
    rows = [(u, i, float((u * 7 + i * 3) % 5)) for u in range(12) for i in range(9) if (u + i) % 4]
    model = factors.fit(spark.createDataFrame(rows, "user int, item int, rating double"), rank=2, rounds=1)
    assert "Join" not in plans["user-biases"]
    mean = sum(r for *_, r in rows) / len(rows)
    by_item, by_user = defaultdict(list), defaultdict(list)
    for _, i, r in rows:
        by_item[i].append(r - mean)
    bi = {i: sum(x) / (len(x) + 5.0) for i, x in by_item.items()}
    for u, i, r in rows:
        by_user[u].append(r - mean - bi[i])
    assert {r.item: r.bi for r in model.items.collect()} == pytest.approx(bi)
    assert {r.user: r.bu for r in model.users.collect()} == pytest.approx({u: sum(x) / (len(x) + 5.0) for u, x in by_user.items()})
