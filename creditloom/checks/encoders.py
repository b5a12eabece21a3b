"""Imputation, scaling and encoding: fitted on the training split, applied to all applications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import encoding
from ..plans import application as app
from ..plans import loan_columns as names
from .fixtures import fixture
from .registry import check, settle
from .sql import check_sql, settled_select

KEY = names.KEY
_NUMBERS = ["AMT_ANNUITY", "AMT_GOODS_PRICE", "OWN_CAR_AGE", "CNT_FAM_MEMBERS", "EXT_SOURCE_1", "EXT_SOURCE_3"]
_CODES = ["CODE_GENDER", "NAME_TYPE_SUITE", "OCCUPATION_TYPE"]

# The training split has no unknown gender, so the raw table brings a category that was never seen.
_FIT = "SELECT * REPLACE (nullif(CODE_GENDER, 'XNA') AS CODE_GENDER) FROM train"
_MEDIANS = "SELECT " + ", ".join(f"median({c}) AS {c}" for c in _NUMBERS) + " FROM fit"
_IMPUTED = ", ".join(f"coalesce({c}, (SELECT {c} FROM med)) AS {c}" for c in _NUMBERS)
_MOMENTS = (
    "SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _NUMBERS)
    + f" FROM (SELECT {_IMPUTED} FROM fit) AS i"
)
_SCALED = ", ".join(f"({c} - (SELECT m_{c} FROM moments))/(SELECT s_{c} FROM moments) AS {c}" for c in _NUMBERS)
_SCALED_ALL = f"SELECT SK_ID_CURR, {_SCALED} FROM (SELECT SK_ID_CURR, {_IMPUTED} FROM application) AS i"


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM fit WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


_FILLED = ", ".join(f"coalesce({c}, {_mode_sql(c)}) AS {c}" for c in _CODES)


def _position_sql(c: str) -> str:
    ranks = f"SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS i FROM (SELECT DISTINCT {c} FROM fit WHERE {c} IS NOT NULL) AS d"
    return f"CAST(coalesce((SELECT i FROM ({ranks}) AS q WHERE q.v = f.{c}), -1) AS DOUBLE) AS {c}"


_POSITIONS = ", ".join(_position_sql(c) for c in _CODES)
_ENCODED = f"SELECT SK_ID_CURR, {_POSITIONS} FROM (SELECT SK_ID_CURR, {_FILLED} FROM application) AS f"


def _fit(spark, sf) -> DataFrame:
    return app.mask_gender(fixture(spark, sf, "train"))


def _all(spark, sf) -> DataFrame:
    return fixture(spark, sf, "application").select(KEY, *_NUMBERS, *_CODES)


@check("m1_median_impute", check_sql(f"SELECT SK_ID_CURR, {_IMPUTED} FROM application", fit=_FIT, med=_MEDIANS))
def median_impute(spark, sf):
    medians = encoding.fit_imputer(_fit(spark, sf), _NUMBERS)
    return _all(spark, sf).selectExpr(KEY, *[f"{encoding.imputed(c, m)} AS {c}" for c, m in medians.items()])


@check(
    "m2_standardize",
    check_sql(settled_select("z", _NUMBERS, [KEY]), fit=_FIT, med=_MEDIANS, moments=_MOMENTS, z=_SCALED_ALL),
)
def standardize(spark, sf):
    train = _fit(spark, sf)
    medians = encoding.fit_imputer(train, _NUMBERS)
    values = {c: encoding.imputed(c, m) for c, m in medians.items()}
    fitted = encoding.fit_scaler(train, values)
    return settle(
        _all(spark, sf).selectExpr(KEY, *[f"{encoding.scaled(values[c], *fitted[c])} AS {c}" for c in _NUMBERS])
    )


@check("m3_mode_impute", check_sql(f"SELECT SK_ID_CURR, {_FILLED} FROM application", fit=_FIT))
def mode_impute(spark, sf):
    modes = encoding.fit_mode_imputer(_fit(spark, sf), _CODES)
    return _all(spark, sf).select(KEY, *[F.coalesce(F.col(c), F.lit(modes[c])).alias(c) for c in _CODES])


@check("m4_ordinal", check_sql(_ENCODED, fit=_FIT))
def ordinal(spark, sf):
    train = _fit(spark, sf)
    modes = encoding.fit_mode_imputer(train, _CODES)
    fitted = encoding.fit_ordinal(train, _CODES, modes)
    return encoding.apply_ordinal(_all(spark, sf).select(KEY, *_CODES), fitted, modes)


@check(
    "m4_many_levels",
    check_sql(
        "SELECT SK_ID_CURR, CAST(coalesce(i, -1) AS DOUBLE) AS at FROM application LEFT JOIN ranks ON v = CAST(SK_ID_CURR AS VARCHAR)",
        ranks="SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT CAST(SK_ID_CURR AS VARCHAR) AS v FROM train) AS d",
    ),
)
def many_levels(spark, sf):
    """A category column with a level per row: numbered as a table, joined to the rows."""
    text = f"string({KEY}) AS at"
    fitted = encoding.fit_ordinal(fixture(spark, sf, "train").selectExpr(text), ["at"], driver_levels=0)
    return encoding.apply_ordinal(fixture(spark, sf, "application").selectExpr(KEY, text), fitted)


@check(
    "m5_preprocess",
    check_sql(
        settled_select("j", [*_NUMBERS, *_CODES], [KEY]),
        fit=_FIT,
        med=_MEDIANS,
        moments=_MOMENTS,
        j=f"SELECT * FROM ({_SCALED_ALL}) AS n JOIN ({_ENCODED}) AS c USING (SK_ID_CURR)",
    ),
)
def preprocess(spark, sf):
    fitted = encoding.Preprocessor(_NUMBERS, _CODES).fit(_fit(spark, sf))
    rows = fitted.encode(_all(spark, sf), [KEY])
    return settle(rows.select(KEY, *[F.col("x")[i].alias(c) for i, c in enumerate(fitted.feature_names)]))
