"""Row-local cleaning. Each operator is a projection, so a chain of them collapses into one."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

from ..functions import number, quoted, text, with_exprs
from .quantiles import exact_medians

Value = str | float | int


def _literal(value: Value) -> str:
    if isinstance(value, str):
        return text(value)
    return str(value) if isinstance(value, int) else number(value)


def _typed(df: DataFrame, col: str, expr: str) -> str:
    return f"CAST({expr} AS {df.schema[col].dataType.simpleString()})"


def sentinel_to_null(df: DataFrame, col: str, value: Value, flag: str) -> DataFrame:
    """Replace a placeholder value by null and record where it stood; the flag is null for null."""
    hit = f"{quoted(col)} = {_literal(value)}"
    return with_exprs(df, {col: f"CASE WHEN {hit} THEN NULL ELSE {quoted(col)} END", flag: hit})


def code_to_null(df: DataFrame, col: str, codes: Sequence[Value]) -> DataFrame:
    """Replace codes that stand for "not known" by null."""
    listed = ", ".join(map(_literal, codes))
    return with_exprs(df, {col: f"CASE WHEN {quoted(col)} IN ({listed}) THEN NULL ELSE {quoted(col)} END"})


def fill_where(df: DataFrame, col: str, predicate: str, value: Value) -> DataFrame:
    """Overwrite ``col`` where the SQL predicate holds; a null predicate keeps the value."""
    return with_exprs(df, {col: f"CASE WHEN {predicate} THEN {_literal(value)} ELSE {quoted(col)} END"})


def fill_null(
    df: DataFrame,
    cols: Mapping[str, Value] | Iterable[str],
    value: Value | None = None,
    if_exists: bool = False,
) -> DataFrame:
    """Replace null, and only null, by a constant per column. NaN stays."""
    values = dict(cols) if isinstance(cols, Mapping) else dict.fromkeys(cols, value)
    if if_exists:
        values = {c: v for c, v in values.items() if c in df.columns}
    return with_exprs(
        df, {c: f"coalesce({quoted(c)}, {_typed(df, c, _literal(v))})" for c, v in values.items()}
    )


def impute(df: DataFrame, cols: Sequence[str], values: Mapping[str, float] | None = None) -> DataFrame:
    """Fill nulls with the given values, or with the exact medians of ``df`` where none are given.

    A fitted value of ``None``, from a column without any value, fills nothing.
    """
    if values is None:
        values = exact_medians(df, cols)
    missing = [c for c in cols if c not in values]
    if missing:
        raise ValueError(f"no fitted value for {missing}: fit the parameters on training data first")
    known = {c: values[c] for c in cols if values[c] is not None}
    return with_exprs(df, {c: f"coalesce({quoted(c)}, {number(v)})" for c, v in known.items()})


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the listed columns that are present."""
    return df.drop(*cols)


def null_shares(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Share of nulls per column, all in one aggregate; 0 for an empty table."""
    if not cols:
        return {}
    shares = [f"coalesce(avg(double({quoted(c)} IS NULL)), 0D) AS {quoted(c)}" for c in cols]
    return df.selectExpr(*shares).first().asDict()


def drop_high_missing(
    df: DataFrame, threshold: float = 0.5, candidates: Sequence[str] | None = None
) -> DataFrame:
    """Drop the candidate columns whose share of nulls exceeds ``threshold``."""
    cols = df.columns if candidates is None else [c for c in candidates if c in df.columns]
    shares = null_shares(df, cols)
    return df.drop(*[c for c, share in shares.items() if share > threshold])
