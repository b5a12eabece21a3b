"""Scalar expressions with the float semantics the loan formulas rely on, as SQL text."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

NAN = "double('NaN')"
INF = "double('Infinity')"


def quoted(name: str) -> str:
    """A column name as an identifier."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string as a literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def number(value: float) -> str:
    """A number as a double literal, exact to the last bit."""
    value = float(value)
    if math.isnan(value):
        return NAN
    if math.isinf(value):
        return INF if value > 0 else f"(-{INF})"
    return f"({value!r}D)"


def with_exprs(df: DataFrame, exprs: Mapping[str, str]) -> DataFrame:
    """Add or replace columns, all computed from the columns as they are in ``df``."""
    if not exprs:
        return df
    new = {c: f"{e} AS {quoted(c)}" for c, e in exprs.items()}
    if set(new).isdisjoint(df.columns):
        return df.selectExpr("*", *new.values())
    return df.selectExpr(*[new.pop(c, quoted(c)) for c in df.columns], *new.values())


def ratio(num: str, den: str, on_zero: str = "ieee") -> str:
    """``num / den`` as double.

    ``on_zero="ieee"`` gives +-Inf or NaN for a zero divisor, as float division does;
    ``"null"`` gives null. A null operand gives null either way, and ANSI mode never raises.
    """
    a, b = f"double({num})", f"double({den})"
    if on_zero == "null":
        return f"try_divide({a}, {b})"
    if on_zero != "ieee":
        raise ValueError(f"on_zero must be 'ieee' or 'null', not {on_zero!r}")
    at_zero = f"CASE WHEN {a} = 0 OR isnan({a}) THEN {NAN} WHEN {a} > 0 THEN {INF} WHEN {a} < 0 THEN -{INF} END"
    return f"(CASE WHEN {b} = 0 THEN {at_zero} ELSE try_divide({a}, {b}) END)"


def _rounded(x: str, digits: int, scaled: str) -> str:
    bound = number(9e15 / 10**digits)
    return f"(CASE WHEN abs({x}) < {bound} THEN {scaled} / {number(10**digits)} ELSE double({x}) END)"


def round_half_away(x: str, digits: int) -> str:
    """Scale, round half away from zero, unscale.

    Spark's own ``round`` works on the decimal text of a double and moves near-ties. Values too
    large for an exact scaled integer, Inf, NaN and null pass through.
    """
    steps = f"double(floor(abs({x}) * {number(10**digits)} + 0.5D))"
    return _rounded(x, digits, f"signum({x}) * {steps}")


def round_half_even(x: str, digits: int) -> str:
    """As :func:`round_half_away` but ties go to the even neighbour."""
    return _rounded(x, digits, f"rint({x} * {number(10**digits)})")


def row_mean(*values: str) -> str:
    """Mean across expressions of one row, skipping nulls; null where all are null."""
    total = " + ".join(f"coalesce(double({v}), 0D)" for v in values)
    filled = " + ".join(f"int({v} IS NOT NULL)" for v in values)
    return f"try_divide({total}, double({filled}))"


def finite_or_null(x: str) -> str:
    """Inf and NaN become null."""
    return f"(CASE WHEN abs(double({x})) < {INF} THEN double({x}) END)"


def _search(x: str, edges: Sequence[float], leaves: Sequence[str]) -> str:
    # A balanced tree of comparisons: log2(len(edges)) tests per row, all in generated code.
    # Null and NaN fail every test and so reach the last leaf.
    if not edges:
        return leaves[0]
    mid = len(edges) // 2
    low, high = _search(x, edges[:mid], leaves[: mid + 1]), _search(x, edges[mid + 1 :], leaves[mid + 1 :])
    return f"CASE WHEN {x} < {number(edges[mid])} THEN {low} ELSE {high} END"


def _tree(x: str, edges: Sequence[float], leaves: Sequence[str]) -> str:
    if any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError("edges must be strictly ascending")
    return f"({_search(x, edges, leaves)})"


def edge_index(x: str, edges: Sequence[float]) -> str:
    """How many of the ascending ``edges`` are <= the value. Meant for up to some hundred edges."""
    return _tree(x, edges, [str(i) for i in range(len(edges) + 1)])


def edge_search(x: str, edges: Sequence[float]) -> str:
    """As :func:`edge_index`, for any number of edges: a binary search in an array instead of a tree in the plan."""
    if any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError("edges must be strictly ascending")
    if not edges:
        return "0"
    steps = ", ".join(str(2**i) for i in reversed(range(len(edges).bit_length())))
    array = f"transform(split({text(','.join(map(repr, map(float, edges))))}, ','), _edge -> double(_edge))"
    # Names that no column has: a lambda's variables hide the columns of the row.
    tried = "_edge_at + _edge_step"
    step = f"(_edge_at, _edge_step) -> CASE WHEN {tried} <= {len(edges)} AND NOT {x} < get({array}, {tried} - 1) THEN {tried} ELSE _edge_at END"
    return f"(CASE WHEN {x} IS NULL THEN {len(edges)} ELSE aggregate(array({steps}), 0, {step}) END)"


def bin_by_edges(
    x: str, edges: Sequence[float], labels: Sequence[str], null_label: str | None = None
) -> str:
    """Label of the half-open bin ``[edge, next edge)`` that holds the value.

    Null and NaN fall into the last bin, unless ``null_label`` names a bin for null.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one label more than edges")
    binned = _tree(x, edges, [text(label) for label in labels])
    return binned if null_label is None else f"(CASE WHEN {x} IS NULL THEN {text(null_label)} ELSE {binned} END)"


@dataclass(frozen=True)
class HashOrder:
    """A repeatable shuffle order: ``of(key)`` is a hash in ``[0, span)``, ties go by key."""

    of: Callable[[str], str]
    span: int


def xxhash_order(seed: int) -> HashOrder:
    """Default order; 2**40 hash values, so ties are rare at any table size."""
    span = 2**40
    return HashOrder(lambda key: f"pmod(xxhash64({key}, {seed}), {span}L)", span)


def portable_order(seed: int) -> HashOrder:
    """An order that any SQL engine can reproduce. The key is reduced first, so it cannot overflow."""
    m = 1000003
    return HashOrder(lambda key: f"pmod(pmod({key}, {m}L) * 7919L + {104729 * seed}L, {m}L)", m)
