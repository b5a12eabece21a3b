"""Samples, folds and rebalancing, over the whole application table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import neighbours, sampling
from ..plans import application as app
from ..plans import loan_columns as names
from .fixtures import fixture
from .registry import ORDER, SEED, check
from .sql import check_sql, dbl, hash_sql

Y, KEY = names.LABEL, names.KEY
_N = 1_000
_ROWS = f"SELECT SK_ID_CURR, TARGET, {hash_sql()} AS h FROM application"
_RANKED = f"SELECT *, row_number() OVER (PARTITION BY TARGET ORDER BY h, SK_ID_CURR) AS rn FROM ({_ROWS}) AS r"
_SIZES = "SELECT count(*) FILTER (WHERE TARGET=0) AS n0, count(*) FILTER (WHERE TARGET=1) AS n1 FROM application"


def _app(spark, sf) -> DataFrame:
    return fixture(spark, sf, "application").select(KEY, Y)


@check(
    "f1_sample_n",
    check_sql(f"SELECT SK_ID_CURR, TARGET FROM rows_ ORDER BY h, SK_ID_CURR LIMIT {_N}", rows_=_ROWS),
)
def sample_n(spark, sf):
    return sampling.sample_n(_app(spark, sf), _N, KEY, SEED, ORDER)


@check(
    "f2_sample_stratified",
    check_sql(
        "SELECT SK_ID_CURR, ranked.TARGET FROM ranked JOIN quotas ON ranked.TARGET = quotas.TARGET WHERE rn <= quota",
        ranked=_RANKED,
        classes="SELECT TARGET, count(*) AS c, (SELECT count(*) FROM application) AS n FROM application GROUP BY TARGET",
        quotas=f"SELECT TARGET, least(c, {_N}*c//n + CASE WHEN row_number() OVER (ORDER BY ({_N}*c)%n DESC, TARGET) <= "
        f"{_N} - sum({_N}*c//n) OVER () THEN 1 ELSE 0 END) AS quota FROM classes",
    ),
)
def sample_stratified(spark, sf):
    return sampling.sample_stratified(_app(spark, sf), Y, _N, KEY, SEED, ORDER)


@check("f3_folds", check_sql("SELECT SK_ID_CURR, TARGET, fold FROM folds"))
def folds(spark, sf):
    return sampling.stratified_folds(_app(spark, sf), Y, 3, KEY, SEED, ORDER)


def _under_sql(ratio: float) -> str:
    return check_sql(
        f"SELECT SK_ID_CURR, TARGET FROM ranked, sizes WHERE TARGET=1 OR rn <= floor(n1/{dbl(ratio)})",
        ranked=_RANKED,
        sizes=_SIZES,
    )


@check("f4_undersample", _under_sql(0.3))
def undersample(spark, sf):
    return sampling.undersample(_app(spark, sf), Y, KEY, 0.3, SEED, ORDER)


@check("f5_undersample_balanced", _under_sql(1.0))
def undersample_balanced(spark, sf):
    return sampling.undersample(_app(spark, sf), Y, KEY, 1.0, SEED, ORDER)


@check(
    "f6_oversample",
    check_sql(
        "SELECT SK_ID_CURR, TARGET, CAST(unnest(range(1, CASE WHEN TARGET=1 THEN n0//n1 + (rn <= n0%n1)::INT ELSE 1 END + 1)) "
        "AS INTEGER) AS copy FROM ranked, sizes",
        ranked=_RANKED,
        sizes=_SIZES,
    ),
)
def oversample(spark, sf):
    return sampling.oversample(_app(spark, sf), Y, KEY, 1.0, SEED, ORDER, copy_col="copy")


_SPACE = ["EXT_SOURCE_2", "EXT_SOURCE_3", "AGE_YEARS"]
_GAP = [f"(a.{c}-b.{c})*(a.{c}-b.{c})" for c in _SPACE]


def _space(spark, sf) -> DataFrame:
    table = app.clean_application(fixture(spark, sf, "application"))
    return table.select(KEY, Y, F.array(*_SPACE).alias("x"))


@check(
    "f7_smote_neighbours",
    check_sql(
        "SELECT SK_ID_CURR, CAST(rk AS INTEGER) AS rank, neighbour, distance FROM (SELECT *, row_number() OVER "
        "(PARTITION BY SK_ID_CURR ORDER BY distance, neighbour) AS rk FROM pairs) AS r WHERE rk <= 5",
        minority=f"SELECT SK_ID_CURR, {', '.join(_SPACE)} FROM clean_all WHERE TARGET = 1",
        pairs=f"SELECT a.SK_ID_CURR, b.SK_ID_CURR AS neighbour, sqrt({'+'.join(_GAP)}) AS distance "
        "FROM minority a, minority b WHERE a.SK_ID_CURR <> b.SK_ID_CURR",
    ),
)
def smote_neighbours(spark, sf):
    minority = _space(spark, sf).filter(F.col(Y) == 1)
    return neighbours.nearest_neighbours(minority, KEY, "x", 5)


@check("f7_smote")
def smote(spark, sf):
    made = neighbours.smote(_space(spark, sf), Y, KEY, "x", 0.3, 5, SEED, order=ORDER)
    return made.select(KEY, Y, *[F.col("x")[i].alias(c) for i, c in enumerate(_SPACE)], "synthetic")
