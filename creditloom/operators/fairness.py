"""Group rates, gaps between groups and display labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_rates(df: DataFrame, by: str, label: str, score: str, threshold: float) -> DataFrame:
    """Size, actual default rate and model approval rate per group; the null group is left out."""
    approved = (F.col(score) < F.lit(threshold)).cast("double")
    return (
        df.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(label).alias("actual_default_rate"),
            F.avg(approved).alias("model_approval_rate"),
        )
    )


def rate_gap(rates: DataFrame, by: str, favoured: str, other: str) -> DataFrame:
    """Gaps in percentage points: how much more often the favoured group is approved and the other defaults."""

    def of(group: str, col: str) -> Column:
        return F.max(F.when(F.col(by) == group, F.col(col)))

    approval = of(favoured, "model_approval_rate") - of(other, "model_approval_rate")
    default = of(other, "actual_default_rate") - of(favoured, "actual_default_rate")
    return rates.agg(
        F.lit(favoured).alias("favoured"),
        F.lit(other).alias("other"),
        (approval * 100).alias("approval_gap_pp"),
        (default * 100).alias("default_gap_pp"),
    )


def flag_disparity(gap: DataFrame) -> DataFrame:
    """True where the approval gap exceeds the gap in default rates."""
    return gap.withColumn("disparity", F.col("approval_gap_pp") > F.col("default_gap_pp"))


def relabel(
    df: DataFrame,
    col: str,
    out: str,
    names: Mapping[str, str] | None = None,
    replace: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Display label: literal replacements in order, then a code-to-name map (null for other codes)."""
    text = F.col(col)
    for old, new in replace:
        text = F.replace(text, F.lit(old), F.lit(new))
    if names is not None:
        named = F.lit(None).cast("string")
        for code, name in names.items():
            named = F.when(text == code, name).otherwise(named)
        text = named
    return df.withColumn(out, text)
