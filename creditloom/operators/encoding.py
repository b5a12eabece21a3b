"""Imputation, scaling and encoding in front of a model, fitted on training rows only."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import finite_or_null, number, quoted, text, with_exprs
from ..session import materialize
from .alignment import bool_to_byte, split_by_type
from .quantiles import exact_medians, leave_one_out_medians

DRIVER_LEVELS = 10_000  # categories over all columns that may be held as plain values
LITERAL_LEVELS = 256  # categories of one column that may sit in the plan as an array
BROADCAST_CHARS = 5_000_000  # text that the categories of one column may hold to be broadcast


def fit_imputer(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact median of the finite values per column; 0 for a column without any."""
    finite = df.selectExpr(*[f"{finite_or_null(quoted(c))} AS {quoted(c)}" for c in cols])
    return {c: 0.0 if m is None else m for c, m in exact_medians(finite, cols).items()}


def imputed(col: str, median: float) -> str:
    """The finite value or the median."""
    return f"coalesce({finite_or_null(quoted(col))}, {number(median)})"


def fit_scaler(df: DataFrame, values: Mapping[str, str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per expression in one pass; a zero deviation becomes 1."""
    if not values:
        return {}
    measures = []
    for i, v in enumerate(values.values()):
        measures += [f"avg({v}) AS m{i}", f"stddev_pop({v}) AS s{i}"]
    row = df.selectExpr(*measures).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(values)}


def scaled(value: str, mean: float, std: float) -> str:
    return f"(({value} - {number(mean)}) / {number(std)})"


def _level_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    # One row per (column, value): counted before the shuffle, so a hot value is one row per task.
    pairs = ", ".join(f"struct({text(c)} AS col, string({quoted(c)}) AS level)" for c in cols)
    return (
        df.selectExpr(f"inline(array({pairs}))")
        .filter("level IS NOT NULL")
        .groupBy("col", "level")
        .agg(F.count("*").alias("n"))
    )


def fit_mode_imputer(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per column, the smallest among equals; null for an all-null column."""
    if not cols:
        return {}
    best = F.min(F.struct((-F.col("n")).alias("_n"), "level"))["level"]
    found = {r["col"]: r["mode"] for r in _level_counts(df, cols).groupBy("col").agg(best.alias("mode")).collect()}
    return {c: found.get(c) for c in cols}


@dataclass(frozen=True)
class OrdinalFit:
    """Sorted categories per column; those of columns with very many are kept as a table."""

    levels: Mapping[str, tuple[str, ...]]
    tables: Mapping[str, DataFrame] = field(default_factory=dict)


def _level_table(levels: DataFrame) -> DataFrame:
    """(level, at): the place of each of the distinct ``levels`` in their order.

    Cut into ranges, numbered within each, and moved on by the sizes of the ranges before, of which there
    are as many as shuffle partitions.
    """
    ranged = levels.repartitionByRange("level").select("level", F.spark_partition_id().alias("part"))
    ranged = materialize(ranged, "level-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("level"))
    numbered = ranged.join(F.broadcast(sizes), "part").select("level", (F.col("start") + within - 1).cast("bigint").alias("at"))
    return materialize(numbered, "levels")


def fit_ordinal(
    df: DataFrame,
    cols: Sequence[str],
    modes: Mapping[str, str | None] | None = None,
    driver_levels: int = DRIVER_LEVELS,
) -> OrdinalFit:
    """Sorted distinct categories per column. ``modes`` are levels too, as nulls become the mode."""
    if not cols:
        return OrdinalFit({})
    counts = _level_counts(df, cols)
    sizes = {r["col"]: r["count"] for r in counts.groupBy("col").count().collect()}
    small, spent = [], 0
    for c in sorted(cols, key=lambda c: sizes.get(c, 0)):
        spent += sizes.get(c, 0)
        if spent <= driver_levels:
            small.append(c)
    levels: dict[str, set[str]] = {c: set() for c in small}
    for r in counts.filter(F.col("col").isin(small)).select("col", "level").collect():
        levels[r["col"]].add(r["level"])
    tables = {c: _level_table(counts.filter(F.col("col") == c).select("level")) for c in cols if c not in levels}
    return OrdinalFit({c: tuple(sorted(v)) for c, v in levels.items()}, tables)


def apply_ordinal(df: DataFrame, fit: OrdinalFit, modes: Mapping[str, str | None] | None = None) -> DataFrame:
    """Replace each category by its position as double, -1 for one not seen in fitting.

    Null takes the mode first where ``modes`` has one. Few categories sit in the plan itself. More
    are joined: those held as plain values are broadcast if their text is short enough, those kept
    as a table are left to Spark, which knows the table's size.
    """
    spark, modes = df.sparkSession, modes or {}

    def filled(c: str) -> str:
        value = f"string({quoted(c)})"
        return value if modes.get(c) is None else f"coalesce({value}, {text(modes[c])})"

    def position(c: str, levels: Sequence[str]) -> str:
        # array_position counts from 1 and gives 0 for an absent value.
        known = ", ".join(map(text, levels))
        return f"double(array_position(array({known}), {filled(c)}) - 1)" if levels else "-1D"

    literal = {c: v for c, v in fit.levels.items() if len(v) <= LITERAL_LEVELS}
    out = with_exprs(df, {c: position(c, v) for c, v in literal.items()})
    joined = {c: None for c in fit.levels if c not in literal} | dict(fit.tables)
    for c, table in joined.items():
        if table is None:
            rows = [(v, i) for i, v in enumerate(fit.levels[c])]
            table = spark.createDataFrame(rows, "level string, at bigint")
            if sum(map(len, fit.levels[c])) <= BROADCAST_CHARS:
                table = F.broadcast(table)
        places = table.selectExpr("level AS _level", "double(at) AS _at")
        out = with_exprs(out, {"_level": filled(c)}).join(places, "_level", "left")
        found = "CASE WHEN _level IS NOT NULL THEN coalesce(_at, -1D) END"
        out = with_exprs(out, {c: found}).drop("_level", "_at")
    return out.select(*df.columns)


def _combined(parts: Sequence[tuple[int, float, float]]) -> tuple[int, float, float]:
    """Count, mean and sum of squared deviations of several groups as one group."""
    n, mean, squares = 0, 0.0, 0.0
    for count, average, own in parts:
        if count:
            step = average - mean
            squares += own + step * step * n * count / (n + count)
            mean += step * count / (n + count)
            n += count
    return n, mean, squares


def _fold_scales(
    df: DataFrame, medians: Mapping[int, Mapping[str, float]], numeric: Sequence[str], fold: str
) -> dict[int, dict[str, tuple[float, float]]]:
    # One pass: moments of the finite values and the rows without one, per fold and column. An
    # imputed column is its finite values and so many copies of the median.
    measures = []
    for i, c in enumerate(numeric):
        x = finite_or_null(quoted(c))
        measures += [f"count({x}) AS n{i}", f"avg({x}) AS m{i}", f"var_pop({x}) AS v{i}"]
    rows = df.groupBy(fold).agg(F.count("*").alias("rows"), *map(F.expr, measures)).collect()
    out: dict[int, dict[str, tuple[float, float]]] = {}
    for g, fitted in medians.items():
        own = [r for r in rows if r[fold] != g]
        out[g] = {}
        for i, c in enumerate(numeric):
            parts = [(r[f"n{i}"], r[f"m{i}"] or 0.0, (r[f"v{i}"] or 0.0) * r[f"n{i}"]) for r in own]
            filled = (sum(r["rows"] - r[f"n{i}"] for r in own), fitted[c], 0.0)
            n, mean, squares = _combined([*parts, filled])
            out[g][c] = (mean, math.sqrt(squares / n) or 1.0) if n else (0.0, 1.0)
    return out


def _fold_levels(
    df: DataFrame, categorical: Sequence[str], fold: str, folds: Sequence[int], driver_levels: int
) -> dict[int, tuple[dict[str, str | None], OrdinalFit]]:
    """Fold -> modes and levels of the rows outside it, from one table of counts per (column, value, fold)."""
    if not categorical:
        return {g: ({}, OrdinalFit({})) for g in folds}
    pairs = ", ".join(f"struct({text(c)} AS col, string({quoted(c)}) AS level)" for c in categorical)
    # Rows outside each fold, per value: counted before the shuffle, so a hot value is one row per task.
    outside = [F.count_if(~F.col("_fold").eqNullSafe(F.lit(g))).alias(f"n{j}") for j, g in enumerate(folds)]
    counts = (
        df.selectExpr(f"{quoted(fold)} AS _fold", f"inline(array({pairs}))")
        .filter("level IS NOT NULL")
        .groupBy("col", "level")
        .agg(*outside)
    )
    counts = materialize(counts, "fold-levels")
    best = [F.min(F.when(F.col(f"n{j}") > 0, F.struct(-F.col(f"n{j}"), "level"))).alias(f"b{j}") for j in range(len(folds))]
    found = {r["col"]: r for r in counts.groupBy("col").agg(F.count("*").alias("n"), *best).collect()}
    small, spent = set(), 0
    for c in sorted(categorical, key=lambda c: found[c]["n"] if c in found else 0):
        spent += found[c]["n"] if c in found else 0
        if spent <= driver_levels:
            small.add(c)
    held = counts.filter(F.col("col").isin(sorted(small))).collect()
    out = {}
    for j, g in enumerate(folds):
        modes = {c: found[c][f"b{j}"]["level"] if c in found and found[c][f"b{j}"] else None for c in categorical}
        levels: dict[str, list[str]] = {c: [] for c in small}
        for r in held:
            if r[f"n{j}"]:
                levels[r["col"]].append(r["level"])
        tables = {
            c: _level_table(counts.filter((F.col("col") == c) & (F.col(f"n{j}") > 0)).select("level"))
            for c in categorical
            if c not in small
        }
        out[g] = modes, OrdinalFit({c: tuple(sorted(v)) for c, v in levels.items()}, tables)
    return out


def fit_folds(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    fold: str,
    folds: Sequence[int],
    driver_levels: int = DRIVER_LEVELS,
) -> dict[int, PreprocessorModel]:
    """Fold -> what :class:`Preprocessor` would fit on the rows outside that fold.

    The statistics of all folds come from the same few passes over ``df``, however many folds there are:
    medians share their brackets, moments and counts are kept per fold and summed without one.
    Only columns with more levels than the driver may hold are numbered fold by fold.
    """
    df = bool_to_byte(df)
    finite = df.selectExpr(*[f"{finite_or_null(quoted(c))} AS {quoted(c)}" for c in numeric], quoted(fold))
    found = leave_one_out_medians(finite, numeric, fold, folds)
    medians = {g: {c: 0.0 if m is None else m for c, m in row.items()} for g, row in found.items()}
    scales = _fold_scales(df, medians, numeric, fold) if numeric else {g: {} for g in folds}
    levels = _fold_levels(df, categorical, fold, folds, driver_levels)
    return {g: PreprocessorModel(medians[g], scales[g], *levels[g]) for g in folds}


class Preprocessor(Estimator):
    """Numeric columns: median, then standardise. Others: most frequent value, then position.

    Columns that are neither listed are dropped. Booleans count as numeric.
    """

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], scale: bool = True):
        super().__init__()
        self.numeric, self.categorical, self.scale = list(numeric), list(categorical), scale

    def _fit(self, dataset: DataFrame) -> PreprocessorModel:
        df = bool_to_byte(dataset)
        medians = fit_imputer(df, self.numeric)
        values = {c: imputed(c, m) for c, m in medians.items()}
        scales = fit_scaler(df, values) if self.scale else dict.fromkeys(self.numeric, (0.0, 1.0))
        modes = fit_mode_imputer(df, self.categorical)
        return PreprocessorModel(medians, scales, modes, fit_ordinal(df, self.categorical, modes))


class PreprocessorModel(Model):
    """Fitted values of :class:`Preprocessor`."""

    def __init__(self, medians, scales, modes, ordinal: OrdinalFit):
        super().__init__()
        self.medians, self.scales, self.modes, self.ordinal = medians, scales, modes, ordinal

    @property
    def feature_names(self) -> list[str]:
        return [*self.medians, *self.modes]

    def only(self, columns: Sequence[str]) -> PreprocessorModel:
        """The same fit for some of the columns. Each column is fitted by itself, so nothing else changes."""
        kept = set(columns)

        def some(values: Mapping) -> dict:
            return {c: v for c, v in values.items() if c in kept}

        ordinal = OrdinalFit(some(self.ordinal.levels), some(self.ordinal.tables))
        return PreprocessorModel(some(self.medians), some(self.scales), some(self.modes), ordinal)

    def encode(self, dataset: DataFrame, keep: Sequence[str], out: str = "x") -> DataFrame:
        """``keep`` columns and the features as one array."""
        kept = {c: f"_keep_{i}" for i, c in enumerate(keep)}
        df = with_exprs(bool_to_byte(dataset), {alias: quoted(c) for c, alias in kept.items()})
        df = apply_ordinal(df, self.ordinal, self.modes)
        numbers = [scaled(imputed(c, m), *self.scales[c]) for c, m in self.medians.items()]
        codes = [f"coalesce({quoted(c)}, -1D)" for c in self.modes]
        return df.selectExpr(
            *[f"{alias} AS {quoted(c)}" for c, alias in kept.items()],
            f"array({', '.join([*numbers, *codes])}) AS {quoted(out)}",
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.encode(dataset, dataset.columns).withColumn("features", array_to_vector("x")).drop("x")


def build_preprocessor(df: DataFrame, exclude: Sequence[str], scale: bool = True) -> Preprocessor:
    """Split the columns of ``df`` by type, less the excluded ones (id, label, fold)."""
    numeric, other = split_by_type(bool_to_byte(df.drop(*exclude)))
    return Preprocessor(numeric, other, scale)
