"""Exact nearest neighbours among many rows, and minority synthesis built on them."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import HashOrder, number, quoted, xxhash_order
from ..session import materialize
from .running import slice_edges, with_slice
from .sampling import NTH, _two_classes, take

# Send the search functions themselves to the executors, so that this package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLAB_ROWS = 4_096
MAX_SLABS = 10_000
HOT_ENTRIES = 1_000
VISITORS_PER_TASK = 20_000
_BLOCK_CELLS = 2_000_000


def _nearest(
    ids: np.ndarray, points: np.ndarray, keys: np.ndarray, others: np.ndarray, m: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each point its ``m`` nearest others by (distance, key). ``keys`` ascend."""
    m = min(m, len(keys))
    step = max(1, _BLOCK_CELLS // max(1, len(keys)))
    for start in range(0, len(ids), step):
        block = points[start : start + step]
        squares = np.zeros((len(block), len(keys)))
        for j in range(block.shape[1]):  # dimension by dimension, in order: the sum is reproducible
            squares += (block[:, j, None] - others[None, :, j]) ** 2
        distances = np.sqrt(squares)
        bounds = np.partition(distances, m - 1, axis=1)[:, m - 1]
        for i, row in enumerate(distances):
            near = np.flatnonzero(row <= bounds[i])
            near = near[np.argsort(row[near], kind="stable")][:m]
            yield ids[start + i], keys[near], row[near]


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _direction(width: int) -> list[float]:
    # A fixed direction that no natural feature combination is constant along.
    w = np.random.default_rng(7).normal(size=width)
    return (w / np.sqrt((w**2).sum())).tolist()


def nearest_neighbours(df: DataFrame, key: str, x: str, k: int, slab_rows: int = SLAB_ROWS) -> DataFrame:
    """The ``k`` nearest other rows of each row: (key, rank, neighbour, distance), ties by key.

    Exact without comparing all pairs. Rows are cut into slabs along one direction; a row first
    searches its own slab, which bounds how far its neighbours can be, and then visits only the
    slabs within that bound, since a distance is never less than its shadow on the direction.
    Equal vectors are searched once, and at most ``k + 1`` copies of a vector can be anyone's
    neighbour, so a group of copies of any size stays cheap. A slab with many visitors is given to
    several tasks. The work still grows faster than the rows where the data has no shape that the
    direction can show.
    """
    return (
        neighbour_lists(df, key, x, k, slab_rows)
        .select(key, F.posexplode("near").alias("at", "n"))
        .select(key, (F.col("at") + 1).alias("rank"), "n.neighbour", "n.distance")
    )


def neighbour_lists(df: DataFrame, key: str, x: str, k: int, slab_rows: int = SLAB_ROWS) -> DataFrame:
    """As :func:`nearest_neighbours`, as one array ``near`` of (distance, neighbour) per row."""
    m = k + 1
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(x).alias("x"))
    first = rows.first()
    if first is None:
        return df.selectExpr(quoted(key), "CAST(NULL AS array<struct<distance:double,neighbour:bigint>>) AS near")
    by_vector = Window.partitionBy("x").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    weights = ", ".join(map(number, _direction(len(first["x"]))))
    shadow = f"aggregate(zip_with(x, array({weights}), (v, w) -> v * w), 0D, (a, v) -> a + v)"
    # Spark keeps only the first m copies on the map side already.
    copies = materialize(
        rows.select("*", F.row_number().over(by_vector).alias("copy"), F.min("key").over(by_vector).alias("vid"))
        .filter(F.col("copy") <= m)
        .selectExpr("*", f"{shadow} AS p"),
        "vectors",
    )
    edges = slice_edges(copies, "p", slab_rows, MAX_SLABS)
    slabs = with_slice(copies, "p", edges, "slab")

    def search_own(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", kind="stable")
        asks = pdf[pdf["copy"] == 1]
        lists = []
        if len(asks):
            found = _nearest(
                np.arange(len(asks)), _stack(asks["x"]), pdf["key"].to_numpy(), _stack(pdf["x"]), m
            )
            lists = [(keys, distances) for _, keys, distances in found]
        return asks[["vid", "x", "p", "slab"]].assign(
            keys=[a for a, _ in lists],
            distances=[b for _, b in lists],
            reach=[b[-1] if len(b) == m else np.inf for _, b in lists],
        )

    own = slabs.groupBy("slab").applyInPandas(
        search_own,
        "vid bigint, x array<double>, p double, slab double, "
        "keys array<bigint>, distances array<double>, reach double",
    )
    lists = own.select("vid", "keys", "distances")
    if edges:
        own = materialize(own, "own")
        lists = own.select("vid", "keys", "distances").unionByName(_visit(own, slabs, edges, m))
    pair = F.struct(F.col("e.distances").alias("distance"), F.col("e.keys").alias("neighbour"))
    best = Window.partitionBy("vid").orderBy("e.distances", "e.keys")
    nearest = (
        lists.select("vid", F.explode(F.arrays_zip("keys", "distances")).alias("e"))
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") <= m)
        .groupBy("vid")
        .agg(F.sort_array(F.collect_list(pair)).alias("near"))
    )
    vectors = rows.groupBy("x").agg(F.min("key").alias("vid"), F.count("*").alias("n"))
    found = _look_up(rows, materialize(vectors.join(nearest, "vid").drop("vid"), "nearest"), "x", "n")
    others = F.slice(F.filter("near", lambda n: n["neighbour"] != F.col("key")), 1, k)
    return found.select(F.col("key").cast(df.schema[key].dataType).alias(key), others.alias("near"))


def _look_up(rows: DataFrame, table: DataFrame, on: str, n: str) -> DataFrame:
    """Join each row to its one entry, where some entries have a large share of the rows.

    ``n`` counts the rows of an entry. Fewer than ``HOT_ENTRIES`` entries can have more than
    that fraction of all rows each, so those are broadcast; the rest meet by a shuffle without them.
    """
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = table.filter(F.col(n) > F.lit(total / HOT_ENTRIES))
    light = table.filter(F.col(n) <= F.lit(total / HOT_ENTRIES))
    if total < HOT_ENTRIES or hot.isEmpty():
        return rows.join(table, on)
    cold = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(light, on)
    return rows.join(F.broadcast(hot), on).unionByName(cold)


def _visit(own: DataFrame, slabs: DataFrame, edges: list[float], m: int) -> DataFrame:
    slack = F.col("reach") * (1 + 1e-9) + 1e-9 * (1 + F.abs("p"))
    ranged = own.withColumns({"_from": F.col("p") - slack, "_to": F.col("p") + slack})
    ranged = with_slice(with_slice(ranged, "_from", edges, "_first"), "_to", edges, "_last")
    span = F.sequence(F.col("_first").cast("int"), F.col("_last").cast("int"))
    visits = ranged.select(
        "vid", "x", "reach", F.col("slab").cast("int").alias("_home"), F.explode(span).alias("slab")
    ).filter("slab <> _home")
    load = {r["slab"]: r["count"] for r in visits.groupBy("slab").count().collect()}
    tasks = F.lit([-(-load.get(i, 0) // VISITORS_PER_TASK) for i in range(len(edges) + 1)])
    parts = F.element_at(tasks, F.col("slab").cast("int") + 1)
    visits = visits.withColumn("part", F.pmod(F.xxhash64("vid"), parts).cast("int"))
    residents = slabs.withColumn("slab", F.col("slab").cast("int")).withColumn("_parts", parts).filter("_parts > 0")
    residents = residents.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))

    def search(visitors: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(visitors) and len(held):
            held = held.sort_values("key", kind="stable")
            found = _nearest(
                np.arange(len(visitors)),
                _stack(visitors["x"]),
                held["key"].to_numpy(),
                _stack(held["x"]),
                m,
            )
            vids, reach = visitors["vid"].to_numpy(), visitors["reach"].to_numpy()
            for i, keys, distances in found:
                close = distances <= reach[i]
                if close.any():
                    out.append((vids[i], keys[close], distances[close]))
        return pd.DataFrame(out, columns=["vid", "keys", "distances"])

    return (
        visits.groupBy("slab", "part")
        .cogroup(residents.groupBy("slab", "part"))
        .applyInPandas(search, "vid bigint, keys array<bigint>, distances array<double>")
    )


def _standardised(df: DataFrame, x: str) -> DataFrame:
    width = df.select(F.size(x)).first()[0]
    row = df.agg(*[F.stddev_pop(F.col(x)[j]).alias(f"s{j}") for j in range(width)]).first()
    scale = F.lit([row[f"s{j}"] or 1.0 for j in range(width)])
    return df.withColumn(x, F.zip_with(x, scale, lambda v, s: v / s))


def smote(
    df: DataFrame,
    label: str,
    key: str,
    x: str = "x",
    ratio: float = 0.3,
    k: int = 5,
    seed: int = 42,
    standardise: bool = True,
    order: HashOrder | None = None,
    search: Callable[[DataFrame, str, str, int], DataFrame] = neighbour_lists,
) -> DataFrame:
    """Add minority rows until minority / majority = ``ratio``: (key, label, x, synthetic).

    A new row lies at a random place between a minority row and one of its ``k`` nearest minority
    neighbours. Every minority row starts the same number of new rows, and the first remainder
    rows in hash order one more. New rows have no key. ``search`` finds the neighbours:
    :func:`neighbour_lists` exactly, :func:`neighbour_index.indexed_neighbour_lists` with a bound on the work per row,
    for many dimensions. Apply to the training rows of a fold only.
    """
    minor, n_minor, _, n_major = _two_classes(df, label)
    need = int(n_major * ratio - n_minor)
    real = df.select(key, label, x, F.lit(False).alias("synthetic"))
    if need <= 0:
        return real
    if n_minor < 2:
        raise ValueError("one minority row has no minority neighbour")
    minority = df.filter(F.col(label) == F.lit(minor)).select(key, label, x)
    space = _standardised(minority, x) if standardise else minority
    near = search(space, key, x, k).selectExpr(quoted(key), "near.neighbour AS _near")
    copies, rest = divmod(need, n_minor)
    table, extra = take(minority, label, {minor: rest}, key, order or xxhash_order(seed))
    starts = (
        table.selectExpr("*", f"{copies} + int({extra}) AS _n")
        .drop(NTH)
        .filter("_n > 0")
        .join(near, key)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    )
    draw = F.pmod(F.xxhash64(key, "_copy", F.lit(seed)), F.lit(2**40))
    place = F.pmod(F.xxhash64(key, "_copy", F.lit(seed + 1)), F.lit(2**40)) / F.lit(float(2**40))
    starts = starts.withColumns(
        {"_to": F.col("_near")[F.pmod(draw, F.size("_near")).cast("int")], "_u": place}
    )
    ends = minority.select(F.col(key).alias("_to"), F.col(x).alias("_x_to"))
    made = starts.join(ends, "_to").select(
        F.lit(None).cast(df.schema[key].dataType).alias(key),
        label,
        F.zip_with(F.col(x), F.col("_x_to"), lambda a, b: a + F.col("_u") * (b - a)).alias(x),
        F.lit(True).alias("synthetic"),
    )
    return real.unionByName(made)
