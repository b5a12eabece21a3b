"""Expressions as SQL text, and the helper that adds them to a table.

Each function takes and returns SQL text, so an operator hands Spark one string per column however
deep the expression is, and everything stays inside generated code.
"""

from .scalar import (
    HashOrder,
    bin_by_edges,
    edge_index,
    edge_search,
    finite_or_null,
    number,
    portable_order,
    quoted,
    ratio,
    round_half_away,
    round_half_even,
    row_mean,
    text,
    with_exprs,
    xxhash_order,
)

__all__ = [
    "HashOrder",
    "bin_by_edges",
    "edge_index",
    "edge_search",
    "finite_or_null",
    "number",
    "portable_order",
    "quoted",
    "ratio",
    "round_half_away",
    "round_half_even",
    "row_mean",
    "text",
    "with_exprs",
    "xxhash_order",
]
