"""The index of projections: bounded visits, recall against all pairs, copies and hot vectors."""

import numpy as np
import pyarrow as pa
import pytest

from creditloom.operators import neighbour_index
from creditloom.operators.neighbour_index import indexed_neighbour_lists, visits


def _points(n, width, factors, seed=3):
    """Rows as loan features are: some factors behind many columns, and noise in each."""
    draw = np.random.default_rng(seed)
    return draw.normal(size=(n, factors)) @ draw.normal(size=(factors, width)) + 0.3 * draw.normal(size=(n, width))


def _brute(x, k):
    out = []
    for i, row in enumerate(x):
        d = np.sqrt(((x - row) ** 2).sum(axis=1))
        d[i] = np.inf
        out.append(set(np.lexsort((np.arange(len(x)), d))[:k].tolist()))
    return out


@pytest.mark.parametrize("width, factors", [(20, 20), (110, 10)])
def test_recall_in_many_dimensions(spark, width, factors):
    """20 dimensions without any structure, 110 with the structure of derived features."""
    x, k = _points(6000, width, factors), 5
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, x array<double>").repartition(8)
    got = {r.id: r.near for r in indexed_neighbour_lists(df, "id", "x", k, block_rows=48).collect()}
    assert len(got) == len(x) and all(len(v) == k for v in got.values())
    hits = sum(len({e.neighbour for e in got[i]} & want) for i, want in enumerate(_brute(x, k)))
    print("recall", width, hits / (k * len(x)))
    assert hits / (k * len(x)) >= 0.9
    for i in range(0, 6000, 500):
        assert [e.distance for e in got[i]] == pytest.approx([np.linalg.norm(x[i] - x[e.neighbour]) for e in got[i]])


def test_visits_are_bounded(monkeypatch):
    seen, own = [], neighbour_index._nearest

    def counting(ids, points, keys, others, m):
        seen.extend([len(keys)] * len(ids))
        return own(ids, points, keys, others, m)

    monkeypatch.setattr(neighbour_index, "_nearest", counting)
    for width in (20, 110):
        seen.clear()
        order = np.repeat([0, 1, 2], [5000, 1, 3000]).astype(np.int32)
        x = pa.array(_points(len(order), width, 5).tolist())
        table = pa.table({"order": order, "vid": np.arange(len(order)), "x": x})
        out = pa.Table.from_batches(neighbour_index._search(iter(table.to_batches(max_chunksize=77)), 64, 6))
        assert len(seen) == len(order) and max(seen) <= 3 * 64
        assert set(out["vid"].to_pylist()) == set(range(len(order)))
        assert set(order[out["vid"].to_numpy()] - order[out["neighbour"].to_numpy()]) == {0}
    assert visits(5, 10, 64, 2) == 10 * 3 * 64 + 2 * 36


def test_copies_hot_vectors_and_small_tables(spark):
    rows = [(i, [1.0, 2.0]) for i in range(500)] + [(500 + i, [float(i), 0.0]) for i in range(7)]
    df = spark.createDataFrame(rows, "id bigint, x array<double>")
    got = {r.id: [(e.distance, e.neighbour) for e in r.near] for r in indexed_neighbour_lists(df, "id", "x", 3, block_rows=16).collect()}
    assert got[0] == [(0.0, 1), (0.0, 2), (0.0, 3)] and got[400] == [(0.0, 0), (0.0, 1), (0.0, 2)]
    assert got[506] == [(1.0, 505), (2.0, 504), (3.0, 503)]
    assert indexed_neighbour_lists(df.limit(0), "id", "x", 3).collect() == []
    assert [len(r.near) for r in indexed_neighbour_lists(df.limit(1), "id", "x", 3).collect()] == [0]
