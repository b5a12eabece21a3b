"""Aggregation of the child tables, joins and coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..functions import with_exprs
from ..operators.joins import columns_added, history_coverage, join_features
from ..plans import end_to_end
from ..plans import loan_columns as names
from ..plans.history import HISTORIES, aggregate_history
from .fixtures import CHILDREN, children, fixture
from .registry import check, settle
from .sql import HISTORY_SQL, check_sql, settled_select


def _aggregated(table: str, ratios: bool):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return settle(aggregate_history(table, fixture(spark, sf, table), ratios))

    return query


def _register(name: str, table: str, ratios: bool) -> None:
    counts, reals = HISTORY_SQL[table].columns(ratios)
    source = f"({HISTORY_SQL[table].select(ratios)}) AS h"
    check(name, check_sql(settled_select(source, reals, ["SK_ID_CURR", *counts])))(_aggregated(table, ratios))


_register("g1_bureau", "bureau", False)
_register("g2_bureau_ratios", "bureau", True)
_register("g3_previous", "previous_application", False)
_register("g4_previous_ratios", "previous_application", True)
_register("g6_installments", "installments", False)
_register("g7_installment_ratios", "installments", True)
_register("g8_pos", "pos_cash", True)
_register("g9_credit_card", "credit_card", True)


@check(
    "g5_installment_rows",
    check_sql(
        settled_select(
            "installment_rows", ["PAYMENT_DIFF", "PAYMENT_RATIO"], ["SK_ID_CURR", "DAYS_INSTALMENT", "DAYS_LATE"]
        )
    ),
)
def installment_rows(spark, sf):
    metrics = HISTORIES["installments"].row_metrics
    table = with_exprs(fixture(spark, sf, "installments"), metrics)
    return settle(table.select(names.KEY, "DAYS_INSTALMENT", *metrics))


def _join_sql(split: str, tables: list[str], lead: list[str]) -> str:
    counts = [c for t in tables for c in HISTORY_SQL[t].columns()[0]]
    reals = [c for t in tables for c in HISTORY_SQL[t].columns()[1]]
    joins = " ".join(f"LEFT JOIN {t}_agg USING (SK_ID_CURR)" for t in tables)
    source = f"(SELECT * FROM {split} {joins}) AS j"
    return check_sql(settled_select(source, reals, [*lead, *counts]))


def _joined(spark: SparkSession, sf: str, split: str, tables: list[str], lead: list[str]) -> DataFrame:
    found = children(spark, sf)
    aggregates = [aggregate_history(t, found[t]) if t in tables else None for t in CHILDREN]
    return settle(join_features(fixture(spark, sf, split).select(*lead), *aggregates, key=names.KEY))


_LEAD = [names.KEY, names.LABEL]


@check("j1_join_three", _join_sql("train", CHILDREN[:3], _LEAD))
def join_three(spark, sf):
    return _joined(spark, sf, "train", CHILDREN[:3], _LEAD)


@check("j1_join_partial", _join_sql("train", ["installments"], _LEAD))
def join_partial(spark, sf):
    return _joined(spark, sf, "train", ["installments"], _LEAD)


@check("j2_join_five", _join_sql("train", CHILDREN, _LEAD))
def join_five(spark, sf):
    return _joined(spark, sf, "train", CHILDREN, _LEAD)


@check("j3_join_test", _join_sql("test", CHILDREN, [names.KEY]))
def join_test(spark, sf):
    return _joined(spark, sf, "test", CHILDREN, [names.KEY])


def _added_sql(table: str) -> str:
    counts, reals = HISTORY_SQL[table].columns()
    return f"SELECT '{table}' AS child, CAST({len(counts) + len(reals)} AS BIGINT) AS added, count(*) AS n_rows FROM application"


@check("j4_columns_added", check_sql(" UNION ALL ".join(map(_added_sql, CHILDREN))))
def added(spark, sf):
    """Columns that each child table adds to the applicants, and the rows, which a join leaves as many."""
    table, found = fixture(spark, sf, "application"), []
    for name, child in children(spark, sf).items():
        joined = join_features(table, aggregate_history(name, child), key=names.KEY)
        found.append(joined.selectExpr(f"'{name}' AS child", f"{columns_added(table, joined)}L AS added", "count(*) AS n_rows"))
    return reduce(DataFrame.unionByName, found)


@check(
    "j5_coverage",
    check_sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS child, count(*) AS applicants, count(*) FILTER (WHERE NOT seen) AS without_history, "
            "CAST(count(*) FILTER (WHERE NOT seen) AS DOUBLE)/count(*) AS share FROM (SELECT SK_ID_CURR IN "
            f"(SELECT SK_ID_CURR FROM {t} WHERE SK_ID_CURR IS NOT NULL) AS seen FROM application) AS s"
            for t in CHILDREN
        )
    ),
)
def coverage(spark, sf):
    return history_coverage(fixture(spark, sf, "application"), children(spark, sf), names.KEY)


@check(
    "external_score_report",
    check_sql(
        settled_select("r", ["default_rate", "mean_debt_credit_ratio"], ["EXT_SOURCE_MEAN_BIN", "n"]),
        r="SELECT EXT_SOURCE_MEAN_BIN, count(*) AS n, avg(TARGET) AS default_rate, "
        "avg(CASE WHEN isfinite(BUREAU_DEBT_CREDIT_RATIO) THEN BUREAU_DEBT_CREDIT_RATIO END) "
        "AS mean_debt_credit_ratio FROM prepared_all LEFT JOIN bureau_agg USING (SK_ID_CURR) "
        "GROUP BY EXT_SOURCE_MEAN_BIN",
    ),
)
def external_score_report(spark, sf):
    return settle(end_to_end.flagship(fixture(spark, sf, "application"), fixture(spark, sf, "bureau")))
