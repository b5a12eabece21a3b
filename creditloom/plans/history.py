"""The five child tables as aggregation specs, and their join to the applicants."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import ratio
from ..operators.aggregation import HistorySpec, aggregate_to_key, average, highest, rows, tally, total
from ..operators.joins import join_features
from . import loan_columns as names


def _is(col: str, value: str) -> str:
    return tally(f"{col} = '{value}'")


BUREAU = HistorySpec(
    prefix="BUREAU_",
    measures={
        "COUNT": rows(),
        "ACTIVE_COUNT": _is("CREDIT_ACTIVE", "Active"),
        "CLOSED_COUNT": _is("CREDIT_ACTIVE", "Closed"),
        "OVERDUE_COUNT": tally("CREDIT_DAY_OVERDUE > 0"),
        "SUM_CREDIT": total("AMT_CREDIT_SUM"),
        "SUM_DEBT": total("AMT_CREDIT_SUM_DEBT"),
        "MEAN_CREDIT": average("AMT_CREDIT_SUM"),
        "SUM_OVERDUE": total("AMT_CREDIT_SUM_OVERDUE"),
        "MAX_OVERDUE": highest("AMT_CREDIT_MAX_OVERDUE"),
        "MEAN_DAYS_OVERDUE": average("CREDIT_DAY_OVERDUE"),
        "DAYS_CREDIT_MEAN": average("DAYS_CREDIT"),
        # The most recent credit: offsets are negative, so "fewest days ago" is the maximum.
        "DAYS_CREDIT_MIN": highest("DAYS_CREDIT"),
    },
    ratios={
        "ACTIVE_RATIO": ("ACTIVE_COUNT", "COUNT", 4),
        "OVERDUE_RATIO": ("OVERDUE_COUNT", "COUNT", 4),
        "DEBT_CREDIT_RATIO": ("SUM_DEBT", "SUM_CREDIT", 4),
    },
)

PREVIOUS = HistorySpec(
    prefix="PREV_",
    measures={
        "APP_COUNT": rows(),
        "APPROVED_COUNT": _is("NAME_CONTRACT_STATUS", "Approved"),
        "REFUSED_COUNT": _is("NAME_CONTRACT_STATUS", "Refused"),
        "CANCELED_COUNT": _is("NAME_CONTRACT_STATUS", "Canceled"),
        "AMT_APPLICATION_MEAN": average("AMT_APPLICATION"),
        "AMT_CREDIT_MEAN": average("AMT_CREDIT"),
        "AMT_APPLICATION_SUM": total("AMT_APPLICATION"),
        "DAYS_DECISION_MEAN": average("DAYS_DECISION"),
        # The most recent decision, as above.
        "DAYS_DECISION_MIN": highest("DAYS_DECISION"),
    },
    ratios={
        "APPROVAL_RATE": ("APPROVED_COUNT", "APP_COUNT", 4),
        "REFUSAL_RATE": ("REFUSED_COUNT", "APP_COUNT", 4),
        # Granted over requested, as a ratio of means.
        "CREDIT_REQUEST_RATIO": ("AMT_CREDIT_MEAN", "AMT_APPLICATION_MEAN", 4),
    },
)

INSTALLMENTS = HistorySpec(
    prefix="INST_",
    row_metrics={
        "DAYS_LATE": "DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT",
        "PAYMENT_DIFF": "AMT_PAYMENT - AMT_INSTALMENT",
        "PAYMENT_RATIO": ratio("AMT_PAYMENT", "AMT_INSTALMENT"),
    },
    measures={
        "COUNT": rows(),
        # A payment without a date is neither late nor on time.
        "LATE_COUNT": tally("DAYS_LATE > 0"),
        "ONTIME_COUNT": tally("DAYS_LATE <= 0"),
        "UNDERPAY_COUNT": tally("PAYMENT_DIFF < 0"),
        "DAYS_LATE_MEAN": average("DAYS_LATE"),
        "DAYS_LATE_MAX": highest("DAYS_LATE"),
        "PAYMENT_DIFF_MEAN": average("PAYMENT_DIFF"),
        "PAYMENT_RATIO_MEAN": average("PAYMENT_RATIO"),
        "AMT_PAYMENT_SUM": total("AMT_PAYMENT"),
        "AMT_INSTALMENT_SUM": total("AMT_INSTALMENT"),
    },
    ratios={
        "LATE_RATIO": ("LATE_COUNT", "COUNT", 4),
        "UNDERPAY_RATIO": ("UNDERPAY_COUNT", "COUNT", 4),
    },
)

POS_CASH = HistorySpec(
    prefix="POS_",
    row_metrics={"IS_LATE": "SK_DPD > 0"},
    measures={
        "COUNT": rows(),
        "LATE_COUNT": tally("IS_LATE"),
        "MAX_DPD": highest("SK_DPD"),
        "MEAN_DPD": average("SK_DPD"),
        "MEAN_INSTALMENT": average("CNT_INSTALMENT"),
    },
    ratios={"LATE_RATIO": ("LATE_COUNT", "COUNT", 4)},
)

CREDIT_CARD = HistorySpec(
    prefix="CC_",
    # One is added to the limit, so a card without a limit needs no special case.
    row_metrics={"CC_UTILIZATION": ratio("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL + 1")},
    measures={
        "COUNT": rows(),
        "MEAN_UTILIZATION": average("CC_UTILIZATION"),
        "MAX_UTILIZATION": highest("CC_UTILIZATION"),
        "MEAN_DRAWINGS": average("AMT_DRAWINGS_CURRENT"),
        "TOTAL_DRAWINGS": total("AMT_DRAWINGS_CURRENT"),
        "MAX_DPD": highest("SK_DPD"),
        "MEAN_DPD": average("SK_DPD"),
        "LATE_COUNT": tally("SK_DPD > 0"),
    },
    ratios={"LATE_RATIO": ("LATE_COUNT", "COUNT", 4)},
)

# Child table name -> spec, in join order.
HISTORIES = {
    "bureau": BUREAU,
    "previous_application": PREVIOUS,
    "installments": INSTALLMENTS,
    "pos_cash": POS_CASH,
    "credit_card": CREDIT_CARD,
}


def aggregate_history(name: str, df: DataFrame, with_ratios: bool = True) -> DataFrame:
    """One row per applicant from the named child table."""
    return aggregate_to_key(df, names.KEY, HISTORIES[name], with_ratios)


def join_histories(app: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """Aggregate the given child tables and left-join them to the applicants."""
    aggregates = [aggregate_history(n, children[n]) for n in HISTORIES if n in children]
    return join_features(app, *aggregates, key=names.KEY)
