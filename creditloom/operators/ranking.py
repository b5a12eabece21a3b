"""Leaderboards, top-k and argmax over report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import quoted, round_half_away, with_exprs


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The ``k`` rows with the highest ``by``; ties go to the smaller ``tie``."""
    return df.orderBy(F.desc_nulls_last(by), F.asc(tie)).limit(k)


def leaderboard(df: DataFrame, by: str, name: str, digits: int = 4, place: str | None = None) -> DataFrame:
    """Rounded metric, best first; ``place`` numbers the rows, of which a report has few, from 1."""
    rounded = with_exprs(df, {by: round_half_away(quoted(by), digits)})
    if place is not None:
        order = Window.orderBy(F.desc_nulls_last(by), F.asc(name))
        rounded = rounded.withColumn(place, F.row_number().over(order).cast("bigint"))
    return rounded.orderBy(F.desc_nulls_last(by), F.asc(name))


def argmax(df: DataFrame, by: str, prefer_low: str, groups: Sequence[str] = ()) -> DataFrame:
    """The row with the highest ``by`` in each group; among equals the one with the lowest ``prefer_low``.

    An aggregate, not a sort or a window, so a large group is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in (*groups, by, prefer_low)]
    scored = df.filter(F.col(by).isNotNull() & ~F.isnan(by))
    best = F.max(F.struct(F.col(by), (-F.col(prefer_low)).alias("_low"), F.struct("*").alias("row")))
    return (
        scored.groupBy(*groups)
        .agg(best.alias("_best"))
        .filter(F.col("_best").isNotNull())
        .select(
            *groups,
            *[F.col(f"_best.row.{c}").alias(c) for c in (prefer_low, by, *rest)],
        )
    )


def summarise_folds(df: DataFrame, by: str, metric: str) -> DataFrame:
    """Mean and population standard deviation of a metric over the folds."""
    return df.groupBy(by).agg(
        F.avg(metric).alias(f"mean_{metric}"),
        F.stddev_pop(metric).alias(f"std_{metric}"),
        F.count(metric).alias("folds"),
    )
