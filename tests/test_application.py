"""Cleaning, features, fitted parameters and alignment on hand-made rows."""

import math

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from creditloom.operators import alignment, cleaning, features
from creditloom.plans import application as app
from creditloom.plans import loan_columns as names
from creditloom.sources import SCHEMAS, head_n, profile, read_table, score_table, write_scores
from creditloom.streaming import decide_stream, prepare_stream


def _applications(spark, *rows, drop=()):
    base = dict.fromkeys(f.name for f in SCHEMAS["application_train"])
    base |= {"DAYS_BIRTH": -10_000, "AMT_CREDIT": 1000.0, "AMT_INCOME_TOTAL": 500.0, "TARGET": 0}
    schema = StructType([f for f in SCHEMAS["application_train"] if f.name not in drop])
    data = [tuple({**base, "SK_ID_CURR": i, **r}[f.name] for f in schema) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def _col(df, *cols):
    return [tuple(r) for r in df.orderBy("SK_ID_CURR").select(*cols).collect()]


def test_sentinel_flag_is_null_for_null(spark):
    df = _applications(spark, {"DAYS_EMPLOYED": 365243}, {"DAYS_EMPLOYED": -5}, {"DAYS_EMPLOYED": None})
    got = _col(app.mask_sentinel(df), "DAYS_EMPLOYED", "DAYS_EMPLOYED_ANOM")
    assert got == [(None, True), (-5, False), (None, None)]


def test_gender_and_car_age(spark):
    df = _applications(
        spark,
        {"CODE_GENDER": "XNA", "FLAG_OWN_CAR": "N", "OWN_CAR_AGE": 3.0},
        {"CODE_GENDER": "F", "FLAG_OWN_CAR": "Y", "OWN_CAR_AGE": None},
        {"CODE_GENDER": None, "FLAG_OWN_CAR": None, "OWN_CAR_AGE": 4.0},
    )
    got = _col(app.zero_car_age(app.mask_gender(df)), "CODE_GENDER", "OWN_CAR_AGE")
    assert got == [(None, 0.0), ("F", None), (None, 4.0)]


def test_fill_null_keeps_nan_and_type(spark):
    df = spark.createDataFrame([(None, None, None), (math.nan, 2, "x")], "a double, b int, c string")
    out = cleaning.fill_null(df, {"a": 0, "b": 7, "c": "Unknown"})
    assert [f.dataType.simpleString() for f in out.schema] == ["double", "int", "string"]
    rows = out.collect()
    assert tuple(rows[0]) == (0.0, 7, "Unknown") and math.isnan(rows[1]["a"])
    assert cleaning.fill_null(df, ["a", "zzz"], 1, if_exists=True).columns == df.columns


def test_imputation_needs_fitted_values(spark):
    df = spark.createDataFrame([(None,), (1.0,), (4.0,)], "a double")
    assert sorted(r[0] for r in cleaning.impute(df, ["a"]).collect()) == [1.0, 2.5, 4.0]
    with pytest.raises(ValueError, match="fit the parameters"):
        cleaning.impute(df, ["a"], {})
    assert cleaning.impute(df.filter("a IS NULL"), ["a"]).first()["a"] is None


def test_drop_high_missing(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 1), (3, 1, 1), (4, 1, 1)], "a int, b int, c int")
    assert cleaning.drop_high_missing(df, 0.5).columns == ["a", "b", "c"]
    assert cleaning.drop_high_missing(df, 0.4).columns == ["a", "c"]
    assert cleaning.drop_high_missing(df, 0.4, ["c", "zzz"]).columns == ["a", "b", "c"]
    assert cleaning.drop_high_missing(df.limit(0), 0.4).columns == ["a", "b", "c"]


def test_there_are_47_housing_columns():
    assert len(names.HOUSING) == len(set(names.HOUSING)) == 47


def test_published_shapes(spark):
    raw = _applications(spark, {"EXT_SOURCE_1": 0.5, "EXT_SOURCE_2": 0.5, "EXT_SOURCE_3": 0.5})
    clean = app.clean_application(raw, dict.fromkeys(names.EXTERNAL_SCORES, 0.5))
    assert len(clean.columns) == len(raw.columns) - 47 + 2
    assert len(app.engineer_features(clean).columns) == len(clean.columns) + 30


def test_engineered_values(spark):
    df = _applications(
        spark,
        {
            "DAYS_BIRTH": -7305,
            "DAYS_EMPLOYED": -1461,
            "AMT_INCOME_TOTAL": 0.0,
            "AMT_ANNUITY": None,
            "EXT_SOURCE_1": 0.2,
            "EXT_SOURCE_2": 0.4,
        },
        {"DAYS_BIRTH": None, "AMT_CREDIT": 0.0, "AMT_INCOME_TOTAL": 0.0},
    )
    out = app.engineer_features(app.clean_application(df, {"EXT_SOURCE_1": 0.1, "EXT_SOURCE_2": 0.1, "EXT_SOURCE_3": 0.6}))
    first, second = out.orderBy("SK_ID_CURR").collect()
    assert (first["AGE_YEARS"], first["EMPLOYED_YEARS"], first["EMPLOYED_TO_AGE_RATIO"]) == (20.0, 4.0, 0.2)
    assert first["CREDIT_INCOME_RATIO"] == math.inf and math.isnan(second["CREDIT_INCOME_RATIO"])
    assert first["CREDIT_TERM_MONTHS"] is None and first["MISS_AMT_ANNUITY"] is True
    assert (first["EXT_SOURCE_MEAN"], first["EXT_SOURCE_1x2"], first["EXT_SOURCE_3_SQ"]) == (0.4, 0.08, 0.36)
    assert first["AGE_BIN"] == "20-24" and second["AGE_BIN"] == "60+"
    assert first["CREDIT_INCOME_BIN"] == second["CREDIT_INCOME_BIN"] == "Very High"
    assert second["MISS_DAYS_EMPLOYED"] is True


def test_parameters_come_from_training_only(spark):
    train = _applications(spark, *[{"EXT_SOURCE_1": v, "EXT_SOURCE_2": v, "EXT_SOURCE_3": v} for v in (0.1, 0.2, 0.9)])
    test = _applications(spark, {"EXT_SOURCE_1": 0.7}, drop=["TARGET"])
    params = app.fit_params(train)
    prepared, full = app.prepare_application(train, params)
    assert params.schema is None and full.medians == params.medians
    out, same = app.prepare_application(test.drop("NAME_TYPE_SUITE"), full, is_train=False)
    assert same is full
    assert out.columns == [c for c in prepared.columns if c != "TARGET"]
    assert out.schema["NAME_TYPE_SUITE"].dataType == StringType()
    assert out.first()["EXT_SOURCE_2"] == 0.2


def test_unfitted_parameters_are_refused(spark):
    df = _applications(spark, {})
    with pytest.raises(ValueError, match="unfitted"):
        app.prepare_application(df, app.FittedParams())
    with pytest.raises(ValueError, match="training table first"):
        app.prepare_application(df, app.FittedParams((("EXT_SOURCE_1", 0.1),)), is_train=False)


def test_parameters_survive_storage(spark, tmp_path):
    schema = StructType([StructField("a", LongType())])
    params = app.FittedParams((("EXT_SOURCE_1", 0.1), ("EXT_SOURCE_2", None)), schema)
    params.save(spark, str(tmp_path / "p"))
    assert app.FittedParams.load(spark, str(tmp_path / "p")) == params


def test_alignment(spark):
    train = spark.createDataFrame([(1, 0, "a")], "id bigint, y int, c string")
    test = spark.createDataFrame([(5, 2, 9)], "extra int, id bigint, y int")
    left, right = alignment.align_pair(train, test, "y")
    assert left.columns == ["id", "c", "y"] and right.columns == ["id", "c"]
    assert tuple(right.first()) == (2, None) and right.schema["c"].dataType == StringType()
    unlabelled, _ = alignment.align_pair(train.drop("y"), test, "y")
    assert unlabelled.columns == ["id", "c"]


def test_types_and_subsets(spark):
    df = spark.createDataFrame([(1, True, "a", 0.5)], "id bigint, b boolean, c string, d double")
    assert alignment.split_by_type(df) == (["id", "d"], ["b", "c"])
    cast = alignment.bool_to_byte(df)
    assert cast.columns == df.columns and cast.schema["b"].dataType.simpleString() == "tinyint"
    assert alignment.feature_columns(df, ["id", "zzz"]).columns == ["b", "c", "d"]
    assert features.select_present(df, ["d", "zzz", "id"]).columns == ["d", "id"]


def test_csv_round_trip_and_scores(spark, tmp_path):
    df = _applications(spark, {"CODE_GENDER": "F"}, {"AMT_CREDIT": 0.1 + 0.2})
    write_scores(df, str(tmp_path / "csv"))
    back = read_table(spark, str(tmp_path / "csv"), SCHEMAS["application_train"])
    assert _col(back, *df.columns) == _col(df, *df.columns)
    inferred = read_table(spark, str(tmp_path / "csv"))
    assert inferred.columns == df.columns
    scores = score_table(df.withColumn("p", df.AMT_CREDIT), "SK_ID_CURR", "p")
    assert scores.columns == ["SK_ID_CURR", "TARGET"]
    assert head_n(scores, 1, ["SK_ID_CURR"]).count() == 1
    row = profile(df, "TARGET", "AMT_CREDIT").first()
    assert (row["n_rows"], row["n_positive"], row["score_max"]) == (2, 0, 1000.0)


def test_streaming_applies_the_batch_plan(spark, tmp_path):
    train = _applications(spark, *[{"EXT_SOURCE_1": v, "EXT_SOURCE_2": v, "EXT_SOURCE_3": v} for v in (0.1, 0.2, 0.9)])
    _, params = app.prepare_application(train, app.fit_params(train))
    arriving = _applications(spark, {"EXT_SOURCE_1": 0.7}, {"CODE_GENDER": "XNA"}, drop=["TARGET"])
    arriving.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(arriving.schema).parquet(str(tmp_path / "in"))
    out = decide_stream(prepare_stream(stream, params), "EXT_SOURCE_MEAN", 0.3, 0.5)
    query = out.writeStream.format("memory").queryName("prepared").start()
    query.processAllAvailable()
    query.stop()
    batch, _ = app.prepare_application(arriving, params, is_train=False)
    got = spark.table("prepared")
    assert _col(got.drop("BAND"), *batch.columns) == _col(batch, *batch.columns)
    assert {r["BAND"] for r in got.collect()} <= {"approve", "review", "deny"}
    with pytest.raises(ValueError):
        prepare_stream(arriving, params)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    wide = spark.sql("SELECT 9 AS SK_ID_BUREAU, -30 AS DAYS_CREDIT, 'Active' AS CREDIT_ACTIVE, 5 AS SK_ID_CURR, 1.5 AS AMT_CREDIT_SUM, 2.5 AS AMT_CREDIT_SUM_DEBT, 0 AS CREDIT_DAY_OVERDUE, 0.5 AS AMT_CREDIT_SUM_OVERDUE, 0.25 AS AMT_CREDIT_MAX_OVERDUE")
    wide.write.option("header", True).csv(str(tmp_path / "wide"))
    row = read_table(spark, str(tmp_path / "wide"), SCHEMAS["bureau"]).first()
    assert (row.SK_ID_CURR, row.CREDIT_ACTIVE, row.AMT_CREDIT_SUM_DEBT, row.DAYS_CREDIT) == (5, "Active", 2.5, -30)
    wide.drop("DAYS_CREDIT").write.option("header", True).csv(str(tmp_path / "narrow"))
    with pytest.raises(ValueError, match="DAYS_CREDIT"):
        read_table(spark, str(tmp_path / "narrow"), SCHEMAS["bureau"])


def test_null_keys_are_refused(spark):
    from creditloom.operators import sampling

    rows = spark.createDataFrame([(None,), (1,)], "id long")
    with pytest.raises(ValueError, match="null keys"):
        sampling.sample_n(rows, 1, "id")
