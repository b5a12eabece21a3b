"""Near neighbours in many dimensions: sorted orders along several projections, blocks of bounded size.

Where no single direction tells near from far, exact search visits almost all pairs. The index sorts the vectors
in several ways. Each order has a code of its own, one bit per random direction (above or below the middle), and
one more direction to sort by within a code. A vector is compared with its own block of the order and the
blocks beside it, then with the neighbours of its neighbours. Visits per vector are bounded by :func:`visits`, whatever the
rows; what is found is nearly always, but not surely, the nearest.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import quoted
from ..session import materialize
from .neighbours import _look_up, _nearest

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDERS = 10
BLOCK_ROWS = 128
ROUNDS = 2
#: Vectors that the middle of each direction is estimated from; every vector is indexed.
FITTED_ROWS = 10_000


def visits(k: int, orders: int = ORDERS, block_rows: int = BLOCK_ROWS, rounds: int = ROUNDS) -> int:
    """The most vectors that one vector is compared with."""
    return orders * 3 * block_rows + rounds * (k + 1) ** 2


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


class _Orders:
    """Directions of all orders and where their codes are cut."""

    def __init__(self, sample: np.ndarray, orders: int, depth: int):
        draws = np.random.default_rng(7).normal(size=(orders * (depth + 1), sample.shape[1]))
        spread = sample.std(axis=0)
        self.directions = (draws / np.where(spread > 0, spread, 1.0)).T
        self.orders, self.depth = orders, depth
        self.middles = np.median(sample @ self.directions, axis=0).reshape(orders, depth + 1)

    def places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code and position within the code, per vector and order."""
        shadows = (x @ self.directions).reshape(len(x), self.orders, self.depth + 1)
        bits = shadows[:, :, 1:] > self.middles[:, 1:]
        return bits @ (1 << np.arange(self.depth)[::-1]), shadows[:, :, 0]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(order, ids, vectors) of at most ``size`` rows in a row that belong to one order."""
    at, ids, points = None, [], []

    def block() -> tuple[int, np.ndarray, np.ndarray]:
        return at, np.concatenate(ids), np.concatenate(points)

    for batch in batches:
        if not batch.num_rows:
            continue
        order, own, x = batch["order"].to_numpy(), batch["vid"].to_numpy(), _matrix(batch["x"])
        start = 0
        while start < len(order):
            if order[start] != at and ids:
                yield block()
                ids, points = [], []
            at = int(order[start])
            stop = min(len(order), start + size - sum(map(len, ids)), int(np.searchsorted(order, at, "right")))
            ids.append(own[start:stop])
            points.append(x[start:stop])
            start = stop
            if sum(map(len, ids)) == size:
                yield block()
                ids, points = [], []
    if ids:
        yield block()


def _search(batches: Iterator[pa.RecordBatch], size: int, m: int) -> Iterator[pa.RecordBatch]:
    """Sorted vectors -> (vid, neighbour, distance) for the ``m`` nearest of the own block and those beside it."""

    def found(before, here, after) -> pa.RecordBatch:
        near = [b for b in (before, here, after) if b is not None and b[0] == here[0]]
        others, points = np.concatenate([b[1] for b in near]), np.concatenate([b[2] for b in near])
        by_id = np.argsort(others)
        hits = list(_nearest(here[1], here[2], others[by_id], points[by_id], m))
        ids = np.repeat([i for i, _, _ in hits], [len(keys) for _, keys, _ in hits])
        keys, distances = (np.concatenate([h[c] for h in hits]) for c in (1, 2))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys), pa.array(distances)], ["vid", "neighbour", "distance"])

    before = here = None
    for block in _blocks(batches, size):
        if here is not None:
            yield found(before, here, block)
        before, here = here, block
    if here is not None:
        yield found(before, here, None)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        squares = np.zeros(batch.num_rows)
        for a, b in zip(_matrix(batch["x"]).T, _matrix(batch["y"]).T):  # the same order of summing as in a block
            squares += (a - b) ** 2
        yield pa.RecordBatch.from_arrays([batch["vid"], batch["neighbour"], pa.array(np.sqrt(squares))], ["vid", "neighbour", "distance"])


def _best(found: DataFrame, m: int) -> DataFrame:
    order = Window.partitionBy("vid").orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= m).drop("rank")


def indexed_neighbour_lists(
    df: DataFrame,
    key: str,
    x: str,
    k: int,
    orders: int = ORDERS,
    block_rows: int = BLOCK_ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """As :func:`neighbours.neighbour_lists`, from the index: (key, near), near an array of (distance, neighbour).

    Distances are exact and ties go by key; some of the ``k`` neighbours may not be the nearest. Equal vectors are
    searched once and are always found. More orders, larger blocks and more rounds find more.
    """
    m = k + 1
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(x).alias("x"))
    by_vector = Window.partitionBy("x").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    copies = rows.select("*", F.row_number().over(by_vector).alias("copy"), F.min("key").over(by_vector).alias("vid"))
    copies = materialize(copies.where(F.col("copy") <= m), "copies")
    vectors = copies.where("copy = 1").select("vid", "x")
    n = vectors.count()
    if not n:
        return df.selectExpr(quoted(key), "CAST(NULL AS array<struct<distance:double,neighbour:bigint>>) AS near")
    sample = vectors.orderBy(F.xxhash64("vid"), "vid").limit(FITTED_ROWS).select("x").collect()
    depth = max(1, math.ceil(math.log2(max(2, n / block_rows))))
    index = _Orders(np.array([r["x"] for r in sample], float), orders, depth)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, shadows = index.places(_matrix(batch["x"]))
            for order in range(index.orders):
                own = pa.array(np.full(batch.num_rows, order, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(codes[:, order]), pa.array(shadows[:, order]), batch["vid"], batch["x"]],
                    ["order", "code", "place", "vid", "x"],
                )

    kind = vectors.schema["x"].dataType.simpleString()
    sorted_ = (
        vectors.mapInArrow(placed, f"order int, code bigint, place double, vid bigint, x {kind}")
        .repartitionByRange("order", "code", "place")
        .sortWithinPartitions("order", "code", "place", "vid")
    )
    pairs = "vid bigint, neighbour bigint, distance double"
    found = sorted_.mapInArrow(lambda batches: _search(batches, block_rows, m), pairs)
    graph = materialize(_best(found.dropDuplicates(["vid", "neighbour"]), m), "graph")
    for _ in range(rounds):
        onward = graph.select(F.col("vid").alias("neighbour"), F.col("neighbour").alias("next"))
        tried = graph.join(onward, "neighbour").selectExpr("vid", "next AS neighbour").where("vid <> neighbour").distinct()
        tried = tried.join(graph, ["vid", "neighbour"], "left_anti")
        both = tried.join(vectors, "vid").join(vectors.selectExpr("vid AS neighbour", "x AS y"), "neighbour")
        more = both.select("vid", "neighbour", "x", "y").mapInArrow(_measured, pairs)
        graph = materialize(_best(graph.unionByName(more), m), "graph")
    held = copies.selectExpr("vid AS neighbour", "key")
    keyed = graph.join(held, "neighbour").selectExpr("vid", "key AS neighbour", "distance")
    pair = F.sort_array(F.collect_list(F.struct("distance", "neighbour"))).alias("near")
    nearest = _best(keyed, m).groupBy("vid").agg(pair)
    sizes = rows.groupBy("x").agg(F.min("key").alias("vid"), F.count("*").alias("n"))
    out = _look_up(rows, materialize(sizes.join(nearest, "vid").drop("vid"), "nearest"), "x", "n")
    others = F.slice(F.filter("near", lambda e: e["neighbour"] != F.col("key")), 1, k)
    return out.select(F.col("key").cast(df.schema[key].dataType).alias(key), others.alias("near"))
