"""Child rows to one row per parent key."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import quoted, with_exprs
from .features import add_ratios


def rows() -> str:
    """Number of rows, nulls included."""
    return "count(1)"


def tally(test: str) -> str:
    """Number of rows where the test holds; a null test does not count, and the result is never null."""
    return f"count_if({test})"


def total(col: str) -> str:
    """Sum; 0 where every value is null."""
    return f"coalesce(sum(double({quoted(col)})), 0D)"


def average(col: str) -> str:
    """Mean of the non-null values."""
    return f"avg({quoted(col)})"


def highest(col: str) -> str:
    """Maximum, leaving out null and NaN."""
    return f"max(CASE WHEN NOT isnan({quoted(col)}) THEN {quoted(col)} END)"


@dataclass(frozen=True)
class HistorySpec:
    """What to derive from a child table, as SQL expressions.

    ``row_metrics`` are computed on each child row, ``measures`` per key, and ``ratios`` from the
    measures as ``(numerator, denominator, digits)``. Names get ``prefix`` in front, also where a
    ratio refers to them.
    """

    prefix: str
    measures: Mapping[str, str]
    ratios: Mapping[str, tuple[str, str, int]] = field(default_factory=dict)
    row_metrics: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [self.prefix + c for c in (*self.measures, *self.ratios)]


def aggregate_to_key(
    df: DataFrame, key: str, spec: HistorySpec, with_ratios: bool = True, on_zero: str = "ieee"
) -> DataFrame:
    """One row per key.

    All measures are partial aggregates, so a key that owns a large share of the rows shrinks to
    one row per map task before the only shuffle.
    """
    df = with_exprs(df, spec.row_metrics)
    out = df.groupBy(key).agg(*[F.expr(f"{e} AS {quoted(spec.prefix + n)}") for n, e in spec.measures.items()])
    if not with_ratios:
        return out
    p = spec.prefix
    return add_ratios(out, {p + n: (p + a, p + b, d) for n, (a, b, d) in spec.ratios.items()}, on_zero)
