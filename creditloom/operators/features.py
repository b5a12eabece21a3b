"""Row-local feature columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame

from ..functions import bin_by_edges, number, quoted, ratio, round_half_away, row_mean, with_exprs


def days_to_years(
    df: DataFrame, names: Mapping[str, str], digits: int = 2, days_per_year: float = 365.25
) -> DataFrame:
    """Signed day offsets to positive years: ``{source: new column}``."""
    return with_exprs(
        df,
        {
            new: round_half_away(f"(abs({quoted(old)}) / {number(days_per_year)})", digits)
            for old, new in names.items()
        },
    )


def add_ratios(
    df: DataFrame, ratios: Mapping[str, tuple[str, str, int]], on_zero: str = "ieee"
) -> DataFrame:
    """Rounded quotients: ``{new column: (numerator, denominator, digits)}``."""
    return with_exprs(
        df,
        {
            new: round_half_away(ratio(quoted(a), quoted(b), on_zero), digits)
            for new, (a, b, digits) in ratios.items()
        },
    )


def missing_flags(df: DataFrame, cols: Sequence[str], prefix: str = "MISS_") -> DataFrame:
    """A boolean per listed column that is present: was the value null?"""
    return with_exprs(df, {prefix + c: f"{quoted(c)} IS NULL" for c in cols if c in df.columns})


def add_row_mean(df: DataFrame, cols: Sequence[str], out: str, digits: int = 6) -> DataFrame:
    """Null-skipping mean across columns."""
    return with_exprs(df, {out: round_half_away(row_mean(*map(quoted, cols)), digits)})


def add_interactions(df: DataFrame, names: Mapping[str, str], stem: str, digits: int = 6) -> DataFrame:
    """Pairwise products and squares of columns; ``names`` maps each column to its short name.

    Products are called ``<stem>_<a>x<b>`` and squares ``<stem>_<a>_SQ``.
    """
    pairs = {f"{stem}_{names[a]}x{names[b]}": (a, b) for a, b in combinations(names, 2)}
    pairs |= {f"{stem}_{short}_SQ": (c, c) for c, short in names.items()}
    return with_exprs(
        df, {new: round_half_away(f"({quoted(a)} * {quoted(b)})", digits) for new, (a, b) in pairs.items()}
    )


def add_bins(
    df: DataFrame,
    bins: Mapping[str, tuple[str, Sequence[float], Sequence[str]]],
    null_label: str | None = None,
) -> DataFrame:
    """Fixed-edge bins: ``{new column: (source, edges, labels)}``. Null lands in the last bin by default."""
    return with_exprs(
        df,
        {new: bin_by_edges(quoted(c), edges, labels, null_label) for new, (c, edges, labels) in bins.items()},
    )


def select_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[c for c in names if c in df.columns])
