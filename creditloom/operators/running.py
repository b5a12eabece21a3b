"""Running totals over a sorted table without a window that spans it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import number, quoted

ROWS_PER_SLICE = 250_000
MAX_SLICES = 1_000


def slice_edges(
    df: DataFrame, col: str, rows_per_slice: int | None = None, max_slices: int = MAX_SLICES
) -> list[float]:
    """Values that cut ``col`` into slices of about equal size; one pass with a bounded sketch."""
    shares = ", ".join(number(i / max_slices) for i in range(1, max_slices))
    x = f"double({quoted(col)})"
    n, cuts = df.selectExpr(
        f"count({x})",
        f"percentile_approx(CASE WHEN NOT isnan({x}) THEN {x} END, array({shares}), {2 * max_slices})",
    ).first()
    slices = min(max_slices, -(-n // (rows_per_slice or ROWS_PER_SLICE)))
    if slices <= 1:
        return []
    return sorted({cuts[i * max_slices // slices - 1] for i in range(1, slices)})


def with_slice(df: DataFrame, col: str, edges: Sequence[float], out: str) -> DataFrame:
    """Number of the slice that holds ``col``, found by binary search."""
    if not edges:
        return df.withColumn(out, F.lit(0.0))
    splits = [float("-inf"), *edges, float("inf")]
    return Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(df)


def before_in_slice(sliced: DataFrame, order: str, sums: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """Add the sum of each ``sums`` column over the rows of the same slice with a smaller ``order``."""
    rows = Window.partitionBy(*by, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sliced.withColumns({out: F.coalesce(F.sum(c).over(rows), F.lit(0)) for out, c in sums.items()})


def before_slice(totals: DataFrame, sums: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """The same over the smaller slices, for a table of one row per slice."""
    slices = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({out: F.coalesce(F.sum(c).over(slices), F.lit(0)) for out, c in sums.items()})


def running_before(
    df: DataFrame, order: str, sums: Mapping[str, str], edges: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Add, per ``by`` group, the sum of each ``sums`` column over the rows with a smaller ``order``.

    ``df`` holds one row per (by, order). The slices bound what one task sorts; slice offsets come
    from a table of one row per slice. The join and the window share one partitioning.
    """
    keys = [*by, "_slice"]
    sliced = with_slice(df, order, edges, "_slice")
    ranked = before_in_slice(sliced, order, sums, by)
    if not edges:
        return ranked.drop("_slice")
    totals = sliced.groupBy(*keys).agg(*[F.sum(c).alias(f"_t_{out}") for out, c in sums.items()])
    offsets = before_slice(totals, {f"_o_{out}": f"_t_{out}" for out in sums}, by)
    return (
        ranked.join(offsets.select(*keys, *[f"_o_{out}" for out in sums]), keys)
        .withColumns({out: F.col(out) + F.col(f"_o_{out}") for out in sums})
        .drop("_slice", *[f"_o_{out}" for out in sums])
    )
