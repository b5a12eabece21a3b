"""Sources, cleaning, fitted values, features and alignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import finite_or_null, with_exprs
from ..operators import alignment, cleaning, features, models
from ..plans import application as app
from ..plans import loan_columns as names
from ..session import new_path
from ..sources import head_n, profile, read_table, write_scores
from . import sql
from .fixtures import CHILDREN, child_columns, children, fixture
from .registry import check, settle
from .sql import check_sql, columns

KEY = names.KEY


def _app(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "application")


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return app.clean_application(_app(spark, sf))


@check("s1_csv_roundtrip", check_sql("SELECT * FROM application"))
def csv_roundtrip(spark, sf):
    table, path = _app(spark, sf), new_path(spark, "csv")
    write_scores(table, path)
    return read_table(spark, path, table.schema)


@check(
    "s5_profile",
    check_sql(
        "SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns, "
        f"{sql.settled('avg(TARGET)')} AS label_mean, "
        "count(*) FILTER (WHERE TARGET=0) AS n_negative, count(*) FILTER (WHERE TARGET=1) AS n_positive, "
        f"{sql.settled('avg(SCORE)')} AS score_mean, {sql.settled('min(SCORE)')} AS score_min, "
        f"{sql.settled('max(SCORE)')} AS score_max FROM scored"
    ),
)
def table_profile(spark, sf):
    return settle(profile(fixture(spark, sf, "scored"), names.LABEL, "SCORE"))


def _child_sql(table: str) -> str:
    nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in child_columns(table))
    return (
        f"SELECT '{table}' AS child, count(*) AS n_rows, CAST({len(child_columns(table))} AS BIGINT) AS n_columns, "
        f"CAST(sum(SK_ID_CURR) AS BIGINT) AS key_sum, CAST(sum({nulls}) AS BIGINT) AS n_nulls FROM {table}"
    )


@check("s2_children_csv", check_sql(" UNION ALL ".join(map(_child_sql, CHILDREN))))
def children_csv(spark, sf):
    """The five child tables as CSV files, read back by their schemas: rows, keys and nulls of each."""
    found = []
    for name, table in children(spark, sf).items():
        path = new_path(spark, name)
        write_scores(table, path)
        again = read_table(spark, path, table.schema)
        nulls = " + ".join(f"bigint({c} IS NULL)" for c in again.columns)
        found.append(
            again.selectExpr(
                f"'{name}' AS child", "count(*) AS n_rows", f"{len(again.columns)}L AS n_columns",
                f"sum({KEY}) AS key_sum", f"sum({nulls}) AS n_nulls",
            )
        )
    return reduce(DataFrame.unionByName, found)


@check(
    "t4_head",
    check_sql("SELECT SK_ID_CURR, AMT_CREDIT, EXT_SOURCE_2 FROM application ORDER BY AMT_CREDIT DESC, SK_ID_CURR LIMIT 25"),
)
def first_rows(spark, sf):
    table = _app(spark, sf).select(KEY, "AMT_CREDIT", "EXT_SOURCE_2")
    return head_n(table, 25, [F.desc("AMT_CREDIT"), KEY])


@check("a6_feature_matrix", check_sql("SELECT * EXCLUDE (SK_ID_CURR, TARGET) FROM application"))
def feature_matrix(spark, sf):
    return alignment.feature_columns(_app(spark, sf), [KEY, names.LABEL])


@check(
    "c1_sentinel",
    check_sql(
        "SELECT SK_ID_CURR, CASE WHEN DAYS_EMPLOYED=365243 THEN NULL ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED, "
        "a.DAYS_EMPLOYED=365243 AS DAYS_EMPLOYED_ANOM FROM application AS a"
    ),
)
def sentinel(spark, sf):
    return app.mask_sentinel(_app(spark, sf)).select(KEY, "DAYS_EMPLOYED", "DAYS_EMPLOYED_ANOM")


@check("c2_age_years", check_sql(f"SELECT SK_ID_CURR, {sql._years('DAYS_BIRTH')} AS AGE_YEARS FROM application"))
def age_years(spark, sf):
    return app.add_age(_app(spark, sf)).select(KEY, "AGE_YEARS")


@check("c3_code_to_null", check_sql("SELECT SK_ID_CURR, nullif(CODE_GENDER, 'XNA') AS CODE_GENDER FROM application"))
def gender_code(spark, sf):
    return app.mask_gender(_app(spark, sf)).select(KEY, "CODE_GENDER")


@check("c4_fill_where", check_sql("SELECT SK_ID_CURR, OWN_CAR_AGE FROM clean_all"))
def car_age(spark, sf):
    return app.zero_car_age(_app(spark, sf)).select(KEY, "OWN_CAR_AGE")


_EXT = ", ".join(names.EXTERNAL_SCORES)
_BY_TRAIN = ", ".join(
    f"coalesce({c}, (SELECT {c} FROM train_medians)) AS {c}" for c in names.EXTERNAL_SCORES
)


@check("c5_impute_fitted", check_sql(f"SELECT SK_ID_CURR, {_BY_TRAIN} FROM test"))
def impute_fitted(spark, sf):
    medians = app.external_medians(fixture(spark, sf, "train"))
    return app.impute_scores(fixture(spark, sf, "test"), medians).select(KEY, *names.EXTERNAL_SCORES)


@check("c5_impute_self", check_sql(f"SELECT SK_ID_CURR, {_EXT} FROM clean_all"))
def impute_self(spark, sf):
    return app.impute_scores(_app(spark, sf)).select(KEY, *names.EXTERNAL_SCORES)


@check("c6_fill_unknown", check_sql("SELECT SK_ID_CURR, coalesce(OCCUPATION_TYPE, 'Unknown') AS OCCUPATION_TYPE FROM application"))
def unknown_occupation(spark, sf):
    return app.name_unknown_occupation(_app(spark, sf)).select(KEY, "OCCUPATION_TYPE")


@check(
    "c7_fill_zero",
    check_sql(
        "SELECT SK_ID_CURR, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in names.INQUIRY_COUNTS) + " FROM application"
    ),
)
def zero_inquiries(spark, sf):
    return app.zero_inquiries(_app(spark, sf)).select(KEY, *names.INQUIRY_COUNTS)


@check("c8_drop_columns", check_sql("SELECT * EXCLUDE (APARTMENTS_AVG, HOUSETYPE_MODE) FROM application"))
def drop_housing(spark, sf):
    return app.drop_housing(_app(spark, sf))


_SHARES = ["APARTMENTS_AVG", "HOUSETYPE_MODE", "EXT_SOURCE_1", "EXT_SOURCE_3", "OWN_CAR_AGE", "OCCUPATION_TYPE"]


@check(
    "c9_null_share",
    # The columns kept by the rule, checked against their shares.
    check_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_share, "
            f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) <= 0.5 AS kept FROM application"
            for c in _SHARES
        )
    ),
)
def null_share(spark, sf):
    table = _app(spark, sf)
    kept = set(cleaning.drop_high_missing(table, 0.5, _SHARES).columns)
    shares = table.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in _SHARES])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_share"), F.lit(c in kept).alias("kept"))
            for c in _SHARES
        ]
    )
    return shares.select(F.inline(rows))


@check("c10_clean", check_sql("SELECT * FROM clean_train"))
def clean(spark, sf):
    train = fixture(spark, sf, "train")
    return app.clean_application(train, app.external_medians(train))


@check("p1_medians", check_sql(f"SELECT {_EXT} FROM train_medians"))
def medians(spark, sf):
    found = app.external_medians(fixture(spark, sf, "train"))
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{c} double" for c in found))


@check(
    "p3_pos_weight",
    check_sql(
        "SELECT count(*) FILTER (WHERE TARGET=0) // count(*) FILTER (WHERE TARGET=1) AS scale_pos_weight FROM train"
    ),
)
def pos_weight(spark, sf):
    weight = models.scale_pos_weight(fixture(spark, sf, "train"), names.LABEL)
    return spark.createDataFrame([(weight,)], "scale_pos_weight bigint")


@check(
    "p4_balanced_weight",
    check_sql(
        "SELECT SK_ID_CURR, TARGET, CAST(count(*) OVER () AS DOUBLE)/(2*count(*) OVER (PARTITION BY TARGET)) AS weight FROM train"
    ),
)
def balanced_weight(spark, sf):
    train = fixture(spark, sf, "train")
    weights = models.class_weights(train, names.LABEL)
    return models.add_class_weight(train, names.LABEL, weights, "weight").select(KEY, names.LABEL, "weight")


@check("e1_durations", check_sql(f"SELECT SK_ID_CURR, {columns(sql.DURATION_SQL)} FROM clean_all"))
def durations(spark, sf):
    return app.add_durations(_clean(spark, sf)).select(KEY, *sql.DURATION_SQL)


@check("e2_employed_to_age", check_sql("SELECT SK_ID_CURR, EMPLOYED_TO_AGE_RATIO FROM prepared_all"))
def employed_to_age(spark, sf):
    return app.add_employed_share(app.add_durations(_clean(spark, sf))).select(KEY, "EMPLOYED_TO_AGE_RATIO")


@check(
    "e3_ratios",
    check_sql(
        "SELECT SK_ID_CURR, "
        + ", ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS {c}" for c in sql.RATIO_SQL)
        + " FROM prepared_all"
    ),
)
def ratios(spark, sf):
    table = app.add_financial_ratios(_app(spark, sf))
    return table.select(KEY, *[F.expr(finite_or_null(c)).alias(c) for c in sql.RATIO_SQL])


def _kinds_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS ratio, count(*) FILTER (WHERE isinf({c})) AS n_inf, "
        f"count(*) FILTER (WHERE isnan({c})) AS n_nan, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM "
    )


_ZERO_RATIOS = {"CREDIT_INCOME_RATIO": "prepared_all", "PAYMENT_RATIO": "installment_rows"}


@check(
    "e3_zero_denominator",
    check_sql(" UNION ALL ".join(_kinds_sql(c) + t for c, t in _ZERO_RATIOS.items())),
)
def zero_denominator(spark, sf):
    from ..plans.history import INSTALLMENTS

    payments = with_exprs(fixture(spark, sf, "installments"), INSTALLMENTS.row_metrics).select("PAYMENT_RATIO")
    credit = app.add_financial_ratios(_app(spark, sf)).select("CREDIT_INCOME_RATIO")

    def kinds(df: DataFrame) -> DataFrame:
        (c,) = df.columns
        return df.agg(
            F.lit(c).alias("ratio"),
            F.count_if(F.abs(F.col(c)) == float("inf")).alias("n_inf"),
            F.count_if(F.isnan(c)).alias("n_nan"),
            F.count_if(F.col(c).isNull()).alias("n_null"),
        )

    return kinds(credit).unionByName(kinds(payments))


@check("e4_missing_flags", check_sql(f"SELECT SK_ID_CURR, {', '.join(sql.FLAG_SQL)} FROM prepared_all"))
def missing_flags(spark, sf):
    return app.add_missing_flags(_clean(spark, sf)).select(KEY, *sql.FLAG_SQL)


@check("e5_row_mean", check_sql(f"SELECT SK_ID_CURR, {sql.MEAN_SQL} AS EXT_SOURCE_MEAN FROM application"))
def row_mean(spark, sf):
    # Before imputation, so that the mean of one, two and three values all occur.
    return app.add_score_mean(_app(spark, sf)).select(KEY, "EXT_SOURCE_MEAN")


@check("e6_interactions", check_sql(f"SELECT SK_ID_CURR, {', '.join(sql.INTERACTION_SQL)} FROM prepared_all"))
def interactions(spark, sf):
    return app.add_score_interactions(_clean(spark, sf)).select(KEY, *sql.INTERACTION_SQL)


def _binned(spark: SparkSession, sf: str, col: str) -> DataFrame:
    table = app.add_score_mean(app.add_financial_ratios(_clean(spark, sf)))
    return features.add_bins(table, {col: app.BINS[col]}).select(KEY, col)


@check("e7_age_bin", check_sql("SELECT SK_ID_CURR, AGE_BIN FROM prepared_all"))
def age_bin(spark, sf):
    return _binned(spark, sf, "AGE_BIN")


@check("e8_credit_income_bin", check_sql("SELECT SK_ID_CURR, CREDIT_INCOME_BIN FROM prepared_all"))
def credit_income_bin(spark, sf):
    return _binned(spark, sf, "CREDIT_INCOME_BIN")


@check("e9_ext_mean_bin", check_sql("SELECT SK_ID_CURR, EXT_SOURCE_MEAN_BIN FROM prepared_all"))
def ext_mean_bin(spark, sf):
    return _binned(spark, sf, "EXT_SOURCE_MEAN_BIN")


# Prepared tables hold Inf where income is zero; report it as null.
_FINITE = ", ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS {c}" for c in sql.RATIO_SQL)


def _finite(df: DataFrame) -> DataFrame:
    return with_exprs(df, {c: finite_or_null(c) for c in sql.RATIO_SQL})


@check("e10_engineer", check_sql(f"SELECT * REPLACE ({_FINITE}) FROM prepared_all"))
def engineer(spark, sf):
    return _finite(app.engineer_features(_clean(spark, sf)))


@check("e11_prepare_train", check_sql(f"SELECT * REPLACE ({_FINITE}) FROM prepared_train"))
def prepare_train(spark, sf):
    train = fixture(spark, sf, "train")
    return _finite(app.prepare_application(train, app.fit_params(train))[0])


def _prepared_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    train = fixture(spark, sf, "train")
    prepared, params = app.prepare_application(train, app.fit_params(train))
    return prepared, app.prepare_application(fixture(spark, sf, "test"), params, is_train=False)[0]


@check("e11_prepare_test", check_sql(f"SELECT * REPLACE ({_FINITE}) FROM prepared_test"))
def prepare_test(spark, sf):
    return _finite(_prepared_pair(spark, sf)[1])


@check(
    "e12_engineered_subset",
    check_sql(f"SELECT {', '.join(names.ENGINEERED)} FROM (SELECT * REPLACE ({_FINITE}) FROM prepared_all) AS p"),
)
def engineered_subset(spark, sf):
    return features.select_present(engineer(spark, sf), [*names.ENGINEERED, "NOT_A_COLUMN"])


@check(
    "a1_align_missing",
    check_sql(
        f"SELECT * REPLACE ({_FINITE}, CAST(NULL AS VARCHAR) AS NAME_TYPE_SUITE, "
        "CAST(NULL AS BOOLEAN) AS MISS_NAME_TYPE_SUITE) FROM prepared_test"
    ),
)
def align_missing(spark, sf):
    train = fixture(spark, sf, "train")
    _, params = app.prepare_application(train, app.fit_params(train))
    test = fixture(spark, sf, "test").drop("NAME_TYPE_SUITE").withColumn("EXTRA", F.col(KEY) * 2)
    return _finite(app.prepare_application(test, params, is_train=False)[0])


@check(
    "a2_align_pair",
    check_sql(
        "SELECT 'train' AS part, SK_ID_CURR, AMT_CREDIT, NAME_TYPE_SUITE, DAYS_BIRTH, TARGET FROM train UNION ALL "
        "SELECT 'test', SK_ID_CURR, AMT_CREDIT, NULL, DAYS_BIRTH, NULL FROM test"
    ),
)
def align_both(spark, sf):
    wanted = [KEY, names.LABEL, "AMT_CREDIT", "NAME_TYPE_SUITE", "DAYS_BIRTH"]
    train = fixture(spark, sf, "train").select(*wanted)
    test = fixture(spark, sf, "test").select("DAYS_BIRTH", KEY, "AMT_CREDIT", F.lit(1).alias("EXTRA"))
    left, right = alignment.align_pair(train, test, names.LABEL)
    if left.columns[-1] != names.LABEL or left.columns[:-1] != right.columns:
        raise AssertionError("the pair is not aligned")
    return left.withColumn("part", F.lit("train")).unionByName(
        right.withColumns({"part": F.lit("test"), names.LABEL: F.lit(None).cast("bigint")})
    )


@check(
    "a4_cast_bool",
    check_sql(
        "SELECT SK_ID_CURR, CAST(DAYS_EMPLOYED_ANOM AS TINYINT) AS DAYS_EMPLOYED_ANOM, "
        + ", ".join(f"CAST({c} AS TINYINT) AS {c}" for c in sql.FLAG_SQL)
        + " FROM prepared_all"
    ),
)
def cast_bool(spark, sf):
    numeric, _ = alignment.split_by_type(alignment.bool_to_byte(app.add_missing_flags(_clean(spark, sf))))
    wanted = [c for c in numeric if c == KEY or c.startswith("MISS_") or c.endswith("_ANOM")]
    return alignment.bool_to_byte(app.add_missing_flags(_clean(spark, sf))).select(*wanted)
