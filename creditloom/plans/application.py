"""Fit, clean, engineer and align the application table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

from ..operators import alignment, cleaning, features
from ..operators.quantiles import exact_medians
from . import loan_columns as names

DURATIONS = {
    "DAYS_EMPLOYED": "EMPLOYED_YEARS",
    "DAYS_REGISTRATION": "REGISTRATION_YEARS",
    "DAYS_ID_PUBLISH": "ID_PUBLISH_YEARS",
    "DAYS_LAST_PHONE_CHANGE": "PHONE_CHANGE_YEARS",
}
# {new column: (numerator, denominator, digits)}
RATIOS = {
    "CREDIT_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL", 4),
    "ANNUITY_INCOME_RATIO": ("AMT_ANNUITY", "AMT_INCOME_TOTAL", 4),
    "LOAN_TO_VALUE_RATIO": ("AMT_CREDIT", "AMT_GOODS_PRICE", 4),
    "CREDIT_TERM_MONTHS": ("AMT_CREDIT", "AMT_ANNUITY", 2),
    "GOODS_TO_INCOME_RATIO": ("AMT_GOODS_PRICE", "AMT_INCOME_TOTAL", 4),
}
BINS = {
    "AGE_BIN": ("AGE_YEARS", names.AGE_EDGES, names.AGE_LABELS),
    "CREDIT_INCOME_BIN": ("CREDIT_INCOME_RATIO", names.CREDIT_INCOME_EDGES, names.LEVEL_LABELS),
    "EXT_SOURCE_MEAN_BIN": ("EXT_SOURCE_MEAN", names.EXT_MEAN_EDGES, names.LEVEL_LABELS),
}


@dataclass(frozen=True)
class FittedParams:
    """Values learned from the raw training table only; never changed afterwards.

    ``schema`` holds the feature columns of the prepared training table and is set by
    ``prepare_application(..., is_train=True)`` on the returned copy.
    """

    medians: tuple[tuple[str, float], ...] = ()
    schema: StructType | None = None

    def save(self, spark: SparkSession, path: str) -> None:
        """Write as a one-row table."""
        row = Row(
            medians=[Row(column=c, median=m) for c, m in self.medians],
            schema=self.schema.json() if self.schema else None,
        )
        ddl = "medians array<struct<column:string,median:double>>, schema string"
        spark.createDataFrame([row], ddl).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedParams:
        """Read what :meth:`save` wrote."""
        import json

        row = spark.read.parquet(path).first()
        schema = StructType.fromJson(json.loads(row["schema"])) if row["schema"] else None
        return cls(tuple((m["column"], m["median"]) for m in row["medians"]), schema)


def external_medians(train: DataFrame) -> dict[str, float | None]:
    """Exact medians of the three external scores, before any cleaning."""
    return exact_medians(train, names.EXTERNAL_SCORES)


def fit_params(train: DataFrame) -> FittedParams:
    """Fit on the raw training table."""
    return FittedParams(tuple(external_medians(train).items()))


def mask_sentinel(df: DataFrame) -> DataFrame:
    return cleaning.sentinel_to_null(df, "DAYS_EMPLOYED", names.EMPLOYED_SENTINEL, "DAYS_EMPLOYED_ANOM")


def add_age(df: DataFrame) -> DataFrame:
    return features.days_to_years(df, {"DAYS_BIRTH": "AGE_YEARS"}, 2, names.DAYS_PER_YEAR)


def mask_gender(df: DataFrame) -> DataFrame:
    return cleaning.code_to_null(df, "CODE_GENDER", [names.UNKNOWN_GENDER])


def zero_car_age(df: DataFrame) -> DataFrame:
    return cleaning.fill_where(df, "OWN_CAR_AGE", "FLAG_OWN_CAR = 'N'", 0.0)


def impute_scores(df: DataFrame, medians: Mapping[str, float] | None = None) -> DataFrame:
    return cleaning.impute(df, names.EXTERNAL_SCORES, medians)


def name_unknown_occupation(df: DataFrame) -> DataFrame:
    return cleaning.fill_null(df, {"OCCUPATION_TYPE": "Unknown"})


def drop_housing(df: DataFrame) -> DataFrame:
    return cleaning.drop_columns(df, names.HOUSING)


def zero_inquiries(df: DataFrame) -> DataFrame:
    return cleaning.fill_null(df, names.INQUIRY_COUNTS, 0, if_exists=True)


def clean_application(df: DataFrame, medians: Mapping[str, float] | None = None) -> DataFrame:
    """All cleaning steps; Catalyst folds them into one projection.

    Without ``medians`` they are taken from ``df`` itself, which suits the training table only.
    """
    return (
        df.transform(mask_sentinel)
        .transform(add_age)
        .transform(mask_gender)
        .transform(zero_car_age)
        .transform(impute_scores, medians)
        .transform(name_unknown_occupation)
        .transform(drop_housing)
        .transform(zero_inquiries)
    )


def add_durations(df: DataFrame) -> DataFrame:
    return features.days_to_years(df, DURATIONS, 2, names.DAYS_PER_YEAR)


def add_employed_share(df: DataFrame) -> DataFrame:
    """Employed years over age, both as already rounded."""
    return features.add_ratios(df, {"EMPLOYED_TO_AGE_RATIO": ("EMPLOYED_YEARS", "AGE_YEARS", 4)})


def add_financial_ratios(df: DataFrame, on_zero: str = "ieee") -> DataFrame:
    return features.add_ratios(df, RATIOS, on_zero)


def add_missing_flags(df: DataFrame) -> DataFrame:
    return features.missing_flags(df, names.MISSING_FLAGGED)


def add_score_mean(df: DataFrame) -> DataFrame:
    return features.add_row_mean(df, names.EXTERNAL_SCORES, "EXT_SOURCE_MEAN")


def add_score_interactions(df: DataFrame) -> DataFrame:
    short = {c: c[-1] for c in names.EXTERNAL_SCORES}
    return features.add_interactions(df, short, "EXT_SOURCE")


def add_bins(df: DataFrame) -> DataFrame:
    return features.add_bins(df, BINS)


def engineer_features(df: DataFrame) -> DataFrame:
    """All engineered columns of a cleaned application table."""
    return (
        df.transform(add_durations)
        .transform(add_employed_share)
        .transform(add_financial_ratios)
        .transform(add_missing_flags)
        .transform(add_score_mean)
        .transform(add_score_interactions)
        .transform(add_bins)
    )


def prepare_application(
    df: DataFrame, params: FittedParams, is_train: bool = True
) -> tuple[DataFrame, FittedParams]:
    """Clean and engineer; then record (train) or align to (test) the feature columns.

    Returns the table and the parameters; a training call returns a copy that knows the schema.
    """
    if not params.medians:
        raise ValueError("unfitted parameters: call fit_params on the training table first")
    if not is_train and params.schema is None:
        raise ValueError("prepare the training table first: the parameters hold no schema to align to")
    prepared = engineer_features(clean_application(df, dict(params.medians)))
    if is_train:
        return prepared, replace(params, schema=alignment.without(prepared.schema, names.LABEL))
    return alignment.align_to(prepared, params.schema), params
