"""Name -> query and, where SQL can say it, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType

from ..functions import finite_or_null, portable_order, quoted, round_half_away, with_exprs
from ..session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

SEED = 42
ORDER = portable_order(SEED)


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: query(tune(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return query

    return add


def settle(df: DataFrame) -> DataFrame:
    """Doubles to four digits, Inf and NaN to null: the twin of ``settled`` on the SQL side."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return with_exprs(
        df, {c: round_half_away(f"({finite_or_null(quoted(c))} + 1e-6D)", 4) for c in doubles}
    )
