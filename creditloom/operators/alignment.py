"""Column-level alignment. These rewrite the select list from the schema and run no job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, NumericType, StructType

from ..functions import quoted, with_exprs


def align_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order: absent ones as typed nulls, others dropped."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            quoted(f.name)
            if f.name in have
            else f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
            for f in schema.fields
        ]
    )


def without(schema: StructType, *names: str) -> StructType:
    """The schema less the named fields."""
    return StructType([f for f in schema.fields if f.name not in names])


def align_pair(train: DataFrame, test: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Give ``test`` the feature columns of ``train``; the label goes last in ``train`` if present."""
    features = without(train.schema, label)
    tail = [label] if label in train.columns else []
    return train.select(*features.names, *tail), align_to(test, features)


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """Names of the numeric columns and of the others."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return numeric, [c for c in df.columns if c not in set(numeric)]


def bool_to_byte(df: DataFrame) -> DataFrame:
    """Cast every boolean column to a one-byte integer."""
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, BooleanType)]
    return with_exprs(df, {c: f"tinyint({quoted(c)})" for c in flags})


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    """The feature matrix: everything but the label, the id and other excluded columns."""
    return df.drop(*exclude)
