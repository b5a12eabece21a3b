"""Value of a threshold policy, threshold sweep, bands and cost sensitivity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import edge_index, edge_search, number, quoted
from .evaluation import COUNTS, add_metrics, confusion_counts
from .quantiles import exact_medians
from .ranking import argmax

GRID = [i / 100 for i in range(1, 100)]
TREE_GRID = 500  # above so many thresholds cells are searched for, and added up by running totals


@dataclass(frozen=True)
class CostModel:
    """Unrounded money values per loan."""

    median_amount: float
    loan: float
    profit: float
    loss: float


def cost_model(
    df: DataFrame, amount: str, fx: float, margin: float, lgd: float, recovery: float
) -> CostModel:
    """Profit of a repaid and loss of a defaulted loan of median size."""
    median = exact_medians(df, [amount])[amount]
    if median is None:
        raise ValueError(f"{amount} holds no value")
    loan = median / fx
    return CostModel(median, loan, loan * margin, loan * lgd * (1 - recovery))


def net_value(profit: Column | float, loss: Column | float, opportunity_cost: bool = True) -> Column:
    """Approved repayers earn the profit, approved defaulters cost the loss.

    With ``opportunity_cost`` a denied repayer costs the profit that was not made.
    """
    profit, loss = (v if isinstance(v, Column) else F.lit(float(v)) for v in (profit, loss))
    value = F.col("tn") * profit - F.col("fn") * loss
    return value - F.col("fp") * profit if opportunity_cost else value


def sweep_counts(df: DataFrame, label: str, score: str, grid: Sequence[float] = GRID) -> DataFrame:
    """Confusion counts at every threshold of the grid.

    Rows are first counted per grid cell, so the table is read once and shrinks to at most
    ``len(grid) + 1`` rows per task; only those counts meet the thresholds. Cells are found by
    comparing with the thresholds themselves, never by scaling the score.
    """
    grid = sorted(set(grid))
    fine = len(grid) > TREE_GRID
    cell = (edge_search if fine else edge_index)(quoted(score), grid)
    cells = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.expr(cell).alias("_cell"))
        .agg(F.count_if(F.col(label) == 0).alias("_n0"), F.count_if(F.col(label) == 1).alias("_n1"))
    )
    if fine:
        return _running(cells, grid)
    denied = F.col("_cell") > F.col("_at")

    def sum_where(count: str, test: Column) -> Column:
        return F.sum(F.when(test, F.col(count)).otherwise(F.lit(0)))

    return (
        cells.selectExpr("*", f"posexplode(array({', '.join(map(number, grid))})) AS (_at, threshold)")
        .groupBy("threshold")
        .agg(
            sum_where("_n0", ~denied).alias("tn"),
            sum_where("_n0", denied).alias("fp"),
            sum_where("_n1", ~denied).alias("fn"),
            sum_where("_n1", denied).alias("tp"),
        )
    )


def _running(cells: DataFrame, grid: Sequence[float]) -> DataFrame:
    """The counts at each threshold from running totals over the cells, a row per threshold and one more."""
    rows = cells.sparkSession.createDataFrame([(i, t) for i, t in enumerate([*grid, None])], "_cell int, threshold double")
    upto = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.orderBy("_cell").rowsBetween(1, Window.unboundedFollowing)
    every = rows.join(cells, "_cell", "left").fillna(0, ["_n0", "_n1"])
    counts = {"tn": ("_n0", upto), "fp": ("_n0", after), "fn": ("_n1", upto), "tp": ("_n1", after)}
    summed = every.select("threshold", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(n) for n, (c, w) in counts.items()])
    return summed.where("threshold IS NOT NULL")


def threshold_sweep(
    df: DataFrame,
    label: str,
    score: str,
    cost: CostModel,
    grid: Sequence[float] = GRID,
    opportunity_cost: bool = True,
) -> DataFrame:
    """Net value in millions, precision, recall and approval rate per threshold."""
    value = net_value(cost.profit, cost.loss, opportunity_cost) / 1e6
    swept = add_metrics(sweep_counts(df, label, score, grid)).withColumn("net_value_m", value)
    return swept.select("threshold", "net_value_m", "precision", "recall", "approval_rate")


def best_threshold(sweep: DataFrame, by: str = "net_value_m") -> DataFrame:
    """The sweep row with the highest value; the lowest threshold among equals."""
    return argmax(sweep, by, "threshold")


def policy_table(
    df: DataFrame,
    label: str,
    score: str,
    policies: Mapping[str, float | None],
    cost: CostModel,
    opportunity_cost: bool = True,
) -> DataFrame:
    """Counts, net value and metrics per named policy in one pass; ``None`` approves everyone."""
    y = F.col(label)
    packed = []
    for name, t in policies.items():
        positive = F.lit(False) if t is None else F.col(score) >= F.lit(t)
        packed.append((name, t, dict(zip(COUNTS, confusion_counts(y, positive)))))
    wide = df.agg(*[c.alias(f"{n}{i}") for i, (_, _, m) in enumerate(packed) for n, c in m.items()])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("policy"),
                F.lit(t).cast("double").alias("threshold"),
                *[F.col(f"{n}{i}").alias(n) for n in COUNTS],
            )
            for i, (name, t, _) in enumerate(packed)
        ]
    )
    long = wide.select(F.inline(rows))
    return add_metrics(long.withColumn("net_value", net_value(cost.profit, cost.loss, opportunity_cost)))


def cost_sensitivity(
    counts: DataFrame, cost: CostModel, factors: Sequence[float], opportunity_cost: bool = True
) -> DataFrame:
    """Best threshold when the loss-to-profit ratio is scaled by each factor.

    Works on the rows of :func:`sweep_counts`, one per threshold, each repeated per factor.
    """
    scaled = counts.withColumn("factor", F.explode(F.array(*[F.lit(float(f)) for f in factors])))
    value = net_value(F.lit(cost.profit), F.col("factor") * F.lit(cost.loss), opportunity_cost)
    valued = scaled.select("factor", "threshold", value.alias("net_value"))
    return argmax(valued, "net_value", "threshold", ["factor"])


def tier(score: str, low: float, high: float) -> Column:
    """approve below ``low``, deny above ``high``, review between, both edges included."""
    s = F.col(score)
    return F.when(s < low, "approve").when(s <= high, "review").when(s > high, "deny")


def tier_summary(df: DataFrame, label: str, score: str, low: float, high: float) -> DataFrame:
    """Rows and default rate per band."""
    return (
        df.groupBy(tier(score, low, high).alias("band"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("default_rate"))
        .filter(F.col("band").isNotNull())
    )
