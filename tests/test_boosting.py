"""Second-order boosting against a plain version in numpy, and at its edges."""

from __future__ import annotations

import numpy as np
import pytest

from zoneflow.ml.boosting import LEAST_GAIN, Boosted, fit_boosted_l2, quantile_edges

EDGES = [np.array([-0.5, 0.0, 0.5, 1.0]), np.arange(0.0, 9.0), np.array([3.0])]


def table(spark, n, seed=1):
    drawn = np.random.default_rng(seed)
    x = np.stack([drawn.normal(size=n), drawn.integers(0, 10, n), drawn.integers(0, 7, n)], axis=1).astype(float)
    y = 3 * (x[:, 0] > 0.5) + x[:, 1] * (x[:, 2] > 3) + 0.1 * drawn.normal(size=n)
    return x, y, spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")


def plain(x, y, rounds, depth, step, l2, least_rows):
    """Predictions of every row, by trees grown one node after the other over all bounds."""
    prediction = np.full(len(y), y.mean())
    for _ in range(rounds):
        g = prediction - y

        def grow(own, left_depth):
            def score(part):
                return g[part].sum() ** 2 / (part.sum() + l2)

            best = (LEAST_GAIN, None)
            for f, bounds in enumerate(EDGES if left_depth else []):
                for bound in bounds:
                    left, right = own & (x[:, f] <= bound), own & (x[:, f] > bound)
                    if min(left.sum(), right.sum()) < max(least_rows, 1):
                        continue
                    gain = (score(left) + score(right) - score(own)) / 2
                    if gain > best[0] + 1e-9:
                        best = (gain, (left, right))
            if best[1] is None:
                return np.where(own, -step * g[own].sum() / (own.sum() + l2), 0.0)
            return sum(grow(part, left_depth - 1) for part in best[1])

        prediction = prediction + grow(np.ones(len(y), bool), depth)
    return prediction


@pytest.mark.parametrize("l2, least_rows", [(1.0, 1.0), (25.0, 1.0), (0.0, 30.0)])
def test_equals_plain_version(spark, l2, least_rows):
    x, y, df = table(spark, 400)
    model = fit_boosted_l2(df, ["a", "b", "c"], "y", rounds=5, depth=3, step=0.3, l2=l2, least_rows=least_rows,
                           row_share=1.0, column_share=1.0, edges=EDGES, store_every=2)
    got = {(r.a, r.b, r.c): r.p for r in model.transform(df, "p").collect()}
    want = plain(x, y, 5, 3, 0.3, l2, least_rows)
    assert max(abs(got[tuple(r)] - w) for r, w in zip(x, want)) < 1e-6


def test_samples_rows_and_columns(spark):
    x, y, df = table(spark, 600, seed=2)
    model = fit_boosted_l2(df, ["a", "b", "c"], "y", rounds=12, depth=4, step=0.3, row_share=0.7, column_share=0.67)
    assert all(len(set(t.feature[t.feature >= 0])) <= 2 for t in model.trees)
    assert set().union(*(t.feature[t.feature >= 0].tolist() for t in model.trees)) == {0, 1, 2}
    assert sum(model.importance().values()) == pytest.approx(1) and min(model.importance().values()) > 0
    scored = model.transform(df, "p").toPandas()
    assert ((scored.p - scored.y) ** 2).mean() < 0.1 * y.var()


def test_edges_hold_every_value_of_a_small_domain(spark):
    _x, _y, df = table(spark, 500)
    assert quantile_edges(df, ["b"])[0].tolist() == list(range(10))


def test_nulls_ties_and_empty_tables(spark):
    schema = "a double, `b.c` double, y double, row string, target int"
    rows = [(1.0, None, 5.0, "x", 1), (None, 2.0, 1.0, "x", 1), (float("nan"), 2.0, 1.0, None, 1), (1.0, 1.0, None, "x", 1),
            (1.0, 1.0, float("nan"), "x", 1)] * 3
    df = spark.createDataFrame(rows, schema)
    model = fit_boosted_l2(df, ["a", "b.c"], "y", rounds=2, depth=2, step=1.0, l2=0.0, row_share=1.0, column_share=1.0)
    assert model.base == pytest.approx(7 / 3)
    got = model.transform(df, "p").select("a", "p", "row").collect()
    assert len(got) == 15 and {round(r.p, 6) for r in got if r.a == 1.0} == {5.0} and {round(r.p, 6) for r in got if r.a != 1.0} == {1.0}
    empty = fit_boosted_l2(df.limit(0), ["a"], "y")
    assert empty.trees == [] and [r.p for r in empty.transform(df.limit(1), "p").collect()] == [0.0]
    same = fit_boosted_l2(df.where("a = 1 and y = 5"), ["a"], "y", rounds=1, depth=2, row_share=1.0)
    assert isinstance(same, Boosted) and same.importance() == {"a": 0.0}
