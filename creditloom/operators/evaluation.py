"""Decisions at a threshold, confusion counts, exact AUC and the ROC curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import before_in_slice, before_slice, running_before, slice_edges, with_slice

COUNTS = ("tn", "fp", "fn", "tp")


def decide(df: DataFrame, score: str, threshold: float, out: str = "DECISION") -> DataFrame:
    """1 (deny) where the score reaches the threshold, else 0 (approve)."""
    return df.withColumn(out, (F.col(score) >= F.lit(threshold)).cast("int"))


def confusion_counts(label: Column, positive: Column) -> list[Column]:
    """The four counts tn, fp, fn, tp as aggregates; rows with a null on either side count nowhere."""
    return [
        F.count_if((label == 0) & ~positive).alias("tn"),
        F.count_if((label == 0) & positive).alias("fp"),
        F.count_if((label == 1) & ~positive).alias("fn"),
        F.count_if((label == 1) & positive).alias("tp"),
    ]


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts of a 0/1 prediction in one pass."""
    return df.groupBy(*by).agg(*confusion_counts(F.col(label), F.col(prediction) == 1))


def add_metrics(counts: DataFrame) -> DataFrame:
    """Precision and recall (0 for an empty denominator) and approval rate from confusion counts."""

    def share(num: Column, den: Column) -> Column:
        return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    return counts.withColumns(
        {
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "approval_rate": share(tn + fn, tn + fp + fn + tp),
        }
    )


def metrics_at(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Confusion counts and metrics at one threshold."""
    positive = F.col(score) >= F.lit(threshold)
    return add_metrics(df.agg(*confusion_counts(F.col(label), positive)))


def accuracy(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose 0/1 prediction equals the label."""
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def _labelled(df: DataFrame, label: str, score: str, by: Sequence[str], bins: int | None) -> DataFrame:
    s = F.col(score).cast("double")
    if bins is not None:
        s = F.floor(s * bins) / F.lit(float(bins))
    return df.select(*by, F.col(label).alias("_y"), s.alias("_s")).filter(
        F.col("_y").isNotNull() & F.col("_s").isNotNull()
    )


def _score_counts(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    # A score shared by many rows shrinks to one row per map task here.
    return rows.groupBy(*by, "_s").agg(
        F.count_if(F.col("_y") == 1).alias("_pos"), F.count_if(F.col("_y") == 0).alias("_neg")
    )


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), bins: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; one row per ``by`` group.

    Counts per distinct score, then running totals in slices: no task ever sorts the whole table.
    Null where a group has one class only. ``bins`` rounds scores in [0, 1] down to that many steps
    first, which bounds the number of distinct scores.
    """
    rows = _labelled(df, label, score, by, bins)
    sliced = with_slice(_score_counts(rows, by), "_s", slice_edges(rows, "_s"), "_slice")
    ranked = before_in_slice(sliced, "_s", {"_below": "_neg"}, by)
    # Pairs won inside a slice; those won against smaller slices follow from the slice totals.
    won = F.col("_pos") * (F.col("_below") + F.col("_neg") / 2.0)
    slices = ranked.groupBy(*by, "_slice").agg(
        F.sum(won).alias("_won"),
        F.sum("_pos").cast("double").alias("_pos"),
        F.sum("_neg").cast("double").alias("_neg"),
    )
    summed = before_slice(slices, {"_before": "_neg"}, by)
    all_won = F.sum(F.col("_won") + F.col("_pos") * F.col("_before"))
    return summed.groupBy(*by).agg(F.try_divide(all_won, F.sum("_pos") * F.sum("_neg")).alias("auc"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score, from the (0, 0) point at threshold infinity downwards.

    Every distinct threshold is kept, points on a straight stretch too; the curve is the same.
    """
    rows = _labelled(df, label, score, (), None)
    totals = rows.agg(
        F.count_if(F.col("_y") == 0).alias("neg"), F.count_if(F.col("_y") == 1).alias("pos")
    ).first()
    edges = slice_edges(rows, "_s")
    sums = {"_neg_below": "_neg", "_pos_below": "_pos"}
    ranked = running_before(_score_counts(rows, ()), "_s", sums, edges)

    def rate(total: int, below: str) -> Column:
        return F.try_divide((F.lit(total) - F.col(below)).cast("double"), F.lit(float(total)))

    points = ranked.select(
        F.col("_s").alias("threshold"),
        rate(totals["neg"], "_neg_below").alias("fpr"),
        rate(totals["pos"], "_pos_below").alias("tpr"),
    )
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], points.schema)
    return start.unionByName(points)
