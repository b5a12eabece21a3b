"""Sweeps over grids of any size count what each threshold denies."""

import random

import pytest

from creditloom.operators import decisions


@pytest.mark.parametrize("tree", [500, 3])
def test_counts_on_fine_and_coarse_grids(spark, monkeypatch, tree):
    monkeypatch.setattr(decisions, "TREE_GRID", tree)
    draw = random.Random(2)
    rows = [(draw.randrange(2), round(draw.random(), 3)) for _ in range(400)] + [(1, None), (0, float("nan")), (1, 0.5)]
    df = spark.createDataFrame(rows, "y int, s double")
    grid = [i / 10 for i in range(1, 10)] + [0.123]
    got = {r.threshold: (r.tn, r.fp, r.fn, r.tp) for r in decisions.sweep_counts(df, "y", "s", grid).collect()}
    for t in grid:
        own = [(y, s != s or s >= t) for y, s in rows if s is not None]
        assert got[t] == tuple(sum(o == want for o in own) for want in ((0, False), (0, True), (1, False), (1, True)))


def test_ten_thousand_thresholds(spark):
    df = spark.range(5000).selectExpr("int(id % 3 = 0) AS y", "(id + 0.5) / 5000 AS s").selectExpr("y", "double(s) AS s")
    got = decisions.sweep_counts(df, "y", "s", [i / 10_000 for i in range(10_000)])
    rows = sorted(got.collect())
    assert len(rows) == 10_000 and all(r.tn + r.fp + r.fn + r.tp == 5000 for r in rows)
    assert rows[5000].tn + rows[5000].fn == 2500
