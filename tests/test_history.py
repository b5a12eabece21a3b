import math

import pytest

from creditloom.operators.joins import columns_added, history_coverage, join_features
from creditloom.plans import history
from creditloom.sources import SCHEMAS


def _agg(spark, name, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMAS[name])
    return {r["SK_ID_CURR"]: r for r in history.aggregate_history(name, df, **kw).collect()}


def test_published_widths(spark):
    widths = {n: len(s.columns) for n, s in history.HISTORIES.items()}
    assert widths == {"bureau": 15, "previous_application": 12, "installments": 12, "pos_cash": 6, "credit_card": 9}
    assert sum(widths.values()) == 54


def test_bureau_null_rules(spark):
    got = _agg(
        spark,
        "bureau",
        [
            (1, "Active", 0, 100.0, None, 0.0, None, -10),
            (1, "Closed", 5, 300.0, None, None, 7.0, -3),
            (2, None, None, 0.0, 5.0, None, math.nan, None),
            (None, "Active", 1, 1.0, 1.0, 1.0, 1.0, -1),
        ],
    )
    one, two = got[1], got[2]
    assert (one["BUREAU_COUNT"], one["BUREAU_ACTIVE_COUNT"], one["BUREAU_OVERDUE_COUNT"]) == (2, 1, 1)
    assert one["BUREAU_SUM_DEBT"] == 0.0 and one["BUREAU_DEBT_CREDIT_RATIO"] == 0.0
    assert one["BUREAU_DAYS_CREDIT_MIN"] == -3 and one["BUREAU_MAX_OVERDUE"] == 7.0
    assert two["BUREAU_ACTIVE_COUNT"] == 0 and two["BUREAU_MEAN_DAYS_OVERDUE"] is None
    assert two["BUREAU_DEBT_CREDIT_RATIO"] == math.inf and two["BUREAU_MAX_OVERDUE"] is None
    assert got[None]["BUREAU_COUNT"] == 1


def test_installments(spark):
    rows = [
        (1, -10, -8, 100.0, 90.0),
        (1, -10, -10, 100.0, 100.0),
        (1, -10, None, 0.0, None),
        (2, -10, -12, 0.0, 5.0),
        (3, -10, -12, 0.0, 0.0),
    ]
    got = _agg(spark, "installments", rows)
    one = got[1]
    assert (one["INST_COUNT"], one["INST_LATE_COUNT"], one["INST_ONTIME_COUNT"], one["INST_UNDERPAY_COUNT"]) == (3, 1, 1, 1)
    assert one["INST_PAYMENT_RATIO_MEAN"] == pytest.approx(0.95) and one["INST_LATE_RATIO"] == 0.3333
    assert got[2]["INST_PAYMENT_RATIO_MEAN"] == math.inf and math.isnan(got[3]["INST_PAYMENT_RATIO_MEAN"])
    assert set(history.INSTALLMENTS.ratios) == {"LATE_RATIO", "UNDERPAY_RATIO"}


def test_card_without_limit(spark):
    got = _agg(spark, "credit_card", [(1, 50.0, 0, None, 0), (1, 0.0, 99, 2.0, 4)])
    assert (got[1]["CC_MAX_UTILIZATION"], got[1]["CC_TOTAL_DRAWINGS"], got[1]["CC_LATE_RATIO"]) == (50.0, 2.0, 0.5)


def test_left_joins(spark):
    app = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    a = spark.createDataFrame([(1, "x"), (None, "n")], "k bigint, a string")
    b = spark.createDataFrame([(2, 5)], "k bigint, b int")
    out = join_features(app, a, None, b, key="k")
    assert columns_added(app, out) == 2
    assert {tuple(r) for r in out.collect()} == {(1, "x", None), (2, None, 5), (None, None, None)}
    assert join_features(app, None, key="k").columns == ["k"]


def test_join_guards(spark):
    app = spark.createDataFrame([(1, 2)], "k bigint, a int")
    with pytest.raises(ValueError, match="both sides"):
        join_features(app, app, key="k")
    twice = spark.createDataFrame([(1, 2), (1, 3)], "k bigint, b int")
    with pytest.raises(ValueError, match="more than one row"):
        join_features(app, twice, key="k", check_keys=True)


def test_coverage(spark):
    app = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k bigint")
    child = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k bigint")
    got = {r["child"]: tuple(r)[1:] for r in history_coverage(app, {"a": child, "none": child.limit(0)}, "k").collect()}
    assert got == {"a": (4, 3, 0.75), "none": (4, 4, 1.0)}


def test_each_child_costs_one_shuffle(spark):
    """The aggregate's partitioning serves the join; the applicants are shuffled once."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = {n: spark.createDataFrame([], SCHEMAS[n]) for n in history.HISTORIES}
        app = spark.createDataFrame([(1, 0)], "SK_ID_CURR bigint, TARGET int")
        plan = history.join_histories(app, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 5 and plan.count("Exchange hashpartitioning") == 6
