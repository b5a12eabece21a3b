import math

import pytest

from creditloom.functions import (
    bin_by_edges,
    edge_index,
    finite_or_null,
    number,
    portable_order,
    ratio,
    round_half_away,
    round_half_even,
    row_mean,
    text,
    with_exprs,
    xxhash_order,
)

INF, NAN = math.inf, math.nan


def _values(spark, rows, schema, **exprs):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.selectExpr(*[f"{e} AS {n}" for n, e in exprs.items()]).collect()]


def _same(got, want):
    return (got is None and want is None) or got == want or (got is not None and want is not None and math.isnan(got) and math.isnan(want))


@pytest.mark.parametrize(
    "a, b, ieee, null",
    [
        (1.0, 2.0, 0.5, 0.5),
        (1.0, 0.0, INF, None),
        (-1.0, 0.0, -INF, None),
        (0.0, 0.0, NAN, None),
        (NAN, 0.0, NAN, None),
        (None, 0.0, None, None),
        (1.0, None, None, None),
        (INF, INF, NAN, NAN),
        (1.0, INF, 0.0, 0.0),
    ],
)
def test_ratio(spark, a, b, ieee, null):
    ((x, y),) = _values(spark, [(a, b)], "a double, b double", x=ratio("a", "b"), y=ratio("a", "b", "null"))
    assert _same(x, ieee) and _same(y, null)


def test_ratio_rejects_unknown_mode():
    with pytest.raises(ValueError):
        ratio("a", "b", "zero")


@pytest.mark.parametrize(
    "x, want", [(2.5, 3.0), (-2.5, -3.0), (0.49999, 0.0), (1e18, 1e18), (INF, INF), (-INF, -INF), (NAN, NAN), (None, None)]
)
def test_round_half_away(spark, x, want):
    ((got,),) = _values(spark, [(x,)], "x double", y=round_half_away("x", 0))
    assert _same(got, want)


def test_round_modes_differ_on_ties_only(spark):
    rows = [(0.125,), (0.375,), (0.1251,)]
    got = _values(spark, rows, "x double", a=round_half_away("x", 2), b=round_half_even("x", 2))
    assert got == [(0.13, 0.12), (0.38, 0.38), (0.13, 0.13)]


def test_row_mean_skips_null(spark):
    rows = [(1.0, 2.0, 6.0), (1.0, None, 2.0), (None, None, None)]
    got = _values(spark, rows, "a double, b double, c double", m=row_mean("a", "b", "c"))
    assert got == [(3.0,), (1.5,), (None,)]


def test_bins_edges_null_and_nan(spark):
    rows = [(1.9,), (2.0,), (5.99,), (6.0,), (NAN,), (None,)]
    labels = ["Low", "Medium", "High", "Very High"]
    got = _values(
        spark,
        rows,
        "x double",
        bin=bin_by_edges("x", [2, 4, 6], labels),
        named=bin_by_edges("x", [2, 4, 6], labels, "None"),
        at=edge_index("x", [2, 4, 6]),
    )
    assert [g[0] for g in got] == ["Low", "Medium", "High", "Very High", "Very High", "Very High"]
    assert got[-1][1] == "None" and got[-2][1] == "Very High"
    assert [g[2] for g in got[:4]] == [0, 1, 2, 3]


def test_bins_check_their_arguments():
    with pytest.raises(ValueError):
        bin_by_edges("x", [1, 2], ["a", "b"])
    with pytest.raises(ValueError):
        edge_index("x", [2, 1])


def test_finite_or_null(spark):
    got = _values(spark, [(1.0,), (INF,), (-INF,), (NAN,), (None,)], "x double", y=finite_or_null("x"))
    assert got == [(1.0,), (None,), (None,), (None,), (None,)]


@pytest.mark.parametrize("value", [0.1, -3.5, 1e-300, 123456789.123456789, 5e-324, 1.7976931348623157e308])
def test_number_is_exact(spark, value):
    assert spark.sql(f"SELECT {number(value)} AS x").first()["x"] == value


@pytest.mark.parametrize("value", ["plain", "it's", 'a "b"', "back\\slash", "—"])
def test_text_is_exact(spark, value):
    assert spark.sql(f"SELECT {text(value)} AS x").first()["x"] == value


def test_with_exprs_reads_old_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = with_exprs(df, {"a": "b", "c": "a"})
    assert out.columns == ["a", "b", "c"] and tuple(out.first()) == (2, 2, 1)


@pytest.mark.parametrize("order", [xxhash_order(7), portable_order(7)])
def test_hash_orders_stay_in_range(spark, order):
    row = spark.range(-5, 10**12, 10**9).selectExpr(f"min({order.of('id')})", f"max({order.of('id')})").first()
    assert 0 <= row[0] and row[1] < order.span
