"""Table reading and writing, and the one-row checks made after loading and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None, fmt: str = "csv"
) -> DataFrame:
    """Read a table. CSV has a header; without ``schema`` its types are inferred.

    The columns of ``schema`` are found in a CSV file by name, whatever their order and whatever else
    the file holds; one that is not there is an error, and so is a part file with another header.
    """
    reader = spark.read
    if fmt != "csv":
        return (reader if schema is None else reader.schema(schema)).format(fmt).load(path)
    reader = reader.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    names = reader.csv(path).columns
    if missing := [f.name for f in schema if f.name not in names]:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    known = {f.name: f for f in schema}
    in_file = StructType([known.get(n, StructField(n, StringType())) for n in names])
    return reader.schema(in_file).option("enforceSchema", False).csv(path).select(*schema.names)


def write_scores(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Write a score table as a folder of part files, one per task."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def score_table(df: DataFrame, id_col: str, score_col: str, out: str = "TARGET") -> DataFrame:
    """Id and score only, with the score renamed. Rows are tied to applicants by id, not by position."""
    return df.select(id_col, F.col(score_col).alias(out))


def profile(df: DataFrame, label: str | None = None, score: str | None = None) -> DataFrame:
    """Row and column counts, label balance and score range in one pass; one row."""
    measures: list[Column] = [
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    ]
    if label is not None:
        measures += [
            F.avg(label).alias("label_mean"),
            F.count_if(F.col(label) == 0).alias("n_negative"),
            F.count_if(F.col(label) == 1).alias("n_positive"),
        ]
    if score is not None:
        measures += [
            F.avg(score).alias("score_mean"),
            F.min(score).alias("score_min"),
            F.max(score).alias("score_max"),
        ]
    return df.agg(*measures)


def head_n(df: DataFrame, n: int, by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in a stated order (a bounded heap per task, no full sort)."""
    return df.orderBy(*by).limit(n)
