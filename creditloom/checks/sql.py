"""Named SELECTs over the star-schema tables, put together into the SQL of a check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from ..plans import loan_columns as names
from ..plans.application import DURATIONS, RATIOS
from .fixtures import CHILDREN, SPLIT, fixture_sql


def dbl(x: object) -> str:
    return f"CAST({x} AS DOUBLE)"


def rounded(x: str, digits: int) -> str:
    scale = f"1e{digits}"
    return (
        f"(CASE WHEN abs({x}) < {9e15 / 10**digits:e} "
        f"THEN sign({x})*floor(abs({x})*{scale}+0.5)/{scale} ELSE {x} END)"
    )


def divided(a: str, b: str, digits: int) -> str:
    return rounded(f"({dbl(a)}/{dbl(b)})", digits)


def settled(x: str) -> str:
    """Sums and means depend on the order of addition: compare them to four digits.

    The nudge keeps exact ties, which cents and eighths produce, from falling either way.
    """
    return f"(CASE WHEN isfinite({x}) THEN {rounded(f'({x}+1e-6)', 4)} END)"


def settled_select(source: str, doubles: Sequence[str], others: Sequence[str]) -> str:
    cols = [*others, *[f"{settled(c)} AS {c}" for c in doubles]]
    return f"SELECT {', '.join(cols)} FROM {source}"


@dataclass(frozen=True)
class History:
    """SQL twin of a child aggregation: whole-number measures, real-number measures, ratios."""

    prefix: str
    source: str
    counts: dict[str, str]
    reals: dict[str, str]
    ratios: dict[str, tuple[str, str]]

    def columns(self, ratios: bool = True) -> tuple[list[str], list[str]]:
        real = [*self.reals, *(self.ratios if ratios else [])]
        return [self.prefix + c for c in self.counts], [self.prefix + c for c in real]

    def select(self, ratios: bool = True) -> str:
        p = self.prefix
        measures = [f"CAST({e} AS BIGINT) AS {p}{c}" for c, e in self.counts.items()]
        measures += [f"{e} AS {p}{c}" for c, e in self.reals.items()]
        inner = f"SELECT SK_ID_CURR, {', '.join(measures)} FROM {self.source} GROUP BY SK_ID_CURR"
        if not ratios:
            return inner
        extra = [f"{divided(p + a, p + b, 4)} AS {p}{c}" for c, (a, b) in self.ratios.items()]
        return f"SELECT *, {', '.join(extra)} FROM ({inner}) AS a"


def _where(test: str) -> str:
    return f"count(*) FILTER (WHERE {test})"


def _total(col: str) -> str:
    return f"coalesce(sum({col}), {dbl(0)})"


HISTORY_SQL = {
    "bureau": History(
        "BUREAU_",
        "bureau",
        {
            "COUNT": "count(*)",
            "ACTIVE_COUNT": _where("CREDIT_ACTIVE = 'Active'"),
            "CLOSED_COUNT": _where("CREDIT_ACTIVE = 'Closed'"),
            "OVERDUE_COUNT": _where("CREDIT_DAY_OVERDUE > 0"),
            "DAYS_CREDIT_MIN": "max(DAYS_CREDIT)",
        },
        {
            "SUM_CREDIT": _total("AMT_CREDIT_SUM"),
            "SUM_DEBT": _total("AMT_CREDIT_SUM_DEBT"),
            "MEAN_CREDIT": "avg(AMT_CREDIT_SUM)",
            "SUM_OVERDUE": _total("AMT_CREDIT_SUM_OVERDUE"),
            "MAX_OVERDUE": "max(AMT_CREDIT_MAX_OVERDUE)",
            "MEAN_DAYS_OVERDUE": "avg(CREDIT_DAY_OVERDUE)",
            "DAYS_CREDIT_MEAN": "avg(DAYS_CREDIT)",
        },
        {
            "ACTIVE_RATIO": ("ACTIVE_COUNT", "COUNT"),
            "OVERDUE_RATIO": ("OVERDUE_COUNT", "COUNT"),
            "DEBT_CREDIT_RATIO": ("SUM_DEBT", "SUM_CREDIT"),
        },
    ),
    "previous_application": History(
        "PREV_",
        "previous_application",
        {
            "APP_COUNT": "count(*)",
            "APPROVED_COUNT": _where("NAME_CONTRACT_STATUS = 'Approved'"),
            "REFUSED_COUNT": _where("NAME_CONTRACT_STATUS = 'Refused'"),
            "CANCELED_COUNT": _where("NAME_CONTRACT_STATUS = 'Canceled'"),
            "DAYS_DECISION_MIN": "max(DAYS_DECISION)",
        },
        {
            "AMT_APPLICATION_MEAN": "avg(AMT_APPLICATION)",
            "AMT_CREDIT_MEAN": "avg(AMT_CREDIT)",
            "AMT_APPLICATION_SUM": _total("AMT_APPLICATION"),
            "DAYS_DECISION_MEAN": "avg(DAYS_DECISION)",
        },
        {
            "APPROVAL_RATE": ("APPROVED_COUNT", "APP_COUNT"),
            "REFUSAL_RATE": ("REFUSED_COUNT", "APP_COUNT"),
            "CREDIT_REQUEST_RATIO": ("AMT_CREDIT_MEAN", "AMT_APPLICATION_MEAN"),
        },
    ),
    "installments": History(
        "INST_",
        "installment_rows",
        {
            "COUNT": "count(*)",
            "LATE_COUNT": _where("DAYS_LATE > 0"),
            "ONTIME_COUNT": _where("DAYS_LATE <= 0"),
            "UNDERPAY_COUNT": _where("PAYMENT_DIFF < 0"),
            "DAYS_LATE_MAX": "max(DAYS_LATE)",
        },
        {
            "DAYS_LATE_MEAN": "avg(DAYS_LATE)",
            "PAYMENT_DIFF_MEAN": "avg(PAYMENT_DIFF)",
            "PAYMENT_RATIO_MEAN": "avg(PAYMENT_RATIO)",
            "AMT_PAYMENT_SUM": _total("AMT_PAYMENT"),
            "AMT_INSTALMENT_SUM": _total("AMT_INSTALMENT"),
        },
        {
            "LATE_RATIO": ("LATE_COUNT", "COUNT"),
            "UNDERPAY_RATIO": ("UNDERPAY_COUNT", "COUNT"),
        },
    ),
    "pos_cash": History(
        "POS_",
        "pos_cash",
        {"COUNT": "count(*)", "LATE_COUNT": _where("SK_DPD > 0"), "MAX_DPD": "max(SK_DPD)"},
        {"MEAN_DPD": "avg(SK_DPD)", "MEAN_INSTALMENT": "avg(CNT_INSTALMENT)"},
        {"LATE_RATIO": ("LATE_COUNT", "COUNT")},
    ),
    "credit_card": History(
        "CC_",
        f"(SELECT *, AMT_BALANCE/{dbl('AMT_CREDIT_LIMIT_ACTUAL+1')} AS u FROM credit_card) AS c",
        {"COUNT": "count(*)", "MAX_DPD": "max(SK_DPD)", "LATE_COUNT": _where("SK_DPD > 0")},
        {
            "MEAN_UTILIZATION": "avg(u)",
            "MAX_UTILIZATION": "max(u)",
            "MEAN_DRAWINGS": "avg(AMT_DRAWINGS_CURRENT)",
            "TOTAL_DRAWINGS": _total("AMT_DRAWINGS_CURRENT"),
            "MEAN_DPD": "avg(SK_DPD)",
        },
        {"LATE_RATIO": ("LATE_COUNT", "COUNT")},
    ),
}


def _years(col: str) -> str:
    return rounded(f"(abs({col})/{dbl(365.25)})", 2)


def bins(col: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    tests = " ".join(f"WHEN {col} < {e} THEN '{label}'" for e, label in zip(edges, labels))
    return f"CASE {tests} ELSE '{labels[-1]}' END"


def clean_sql(source: str, medians: str) -> str:
    replaced = [
        "CASE WHEN DAYS_EMPLOYED = 365243 THEN NULL ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED",
        "CASE WHEN CODE_GENDER = 'XNA' THEN NULL ELSE CODE_GENDER END AS CODE_GENDER",
        f"CASE WHEN FLAG_OWN_CAR = 'N' THEN {dbl(0)} ELSE OWN_CAR_AGE END AS OWN_CAR_AGE",
        "coalesce(OCCUPATION_TYPE, 'Unknown') AS OCCUPATION_TYPE",
    ]
    replaced += [f"coalesce({c}, (SELECT {c} FROM {medians})) AS {c}" for c in names.EXTERNAL_SCORES]
    replaced += [f"coalesce({c}, 0) AS {c}" for c in names.INQUIRY_COUNTS]
    return (
        f"SELECT * EXCLUDE (APARTMENTS_AVG, HOUSETYPE_MODE) REPLACE ({', '.join(replaced)}), "
        f"s.DAYS_EMPLOYED = 365243 AS DAYS_EMPLOYED_ANOM, {_years('s.DAYS_BIRTH')} AS AGE_YEARS "
        f"FROM {source} AS s"
    )


DURATION_SQL = {new: _years(old) for old, new in DURATIONS.items()}
RATIO_SQL = {new: divided(a, b, d) for new, (a, b, d) in RATIOS.items()}
FLAG_SQL = {f"MISS_{c}": f"{c} IS NULL" for c in names.MISSING_FLAGGED}
MEAN_SQL = rounded(
    "((coalesce(EXT_SOURCE_1,0)+coalesce(EXT_SOURCE_2,0)+coalesce(EXT_SOURCE_3,0))"
    "/nullif((EXT_SOURCE_1 IS NOT NULL)::INT+(EXT_SOURCE_2 IS NOT NULL)::INT"
    "+(EXT_SOURCE_3 IS NOT NULL)::INT, 0))",
    6,
)
INTERACTION_SQL = {
    f"EXT_SOURCE_{a}x{b}": rounded(f"(EXT_SOURCE_{a}*EXT_SOURCE_{b})", 6)
    for a, b in (("1", "2"), ("1", "3"), ("2", "3"))
} | {f"EXT_SOURCE_{a}_SQ": rounded(f"(EXT_SOURCE_{a}*EXT_SOURCE_{a})", 6) for a in "123"}
BIN_SQL = {
    "AGE_BIN": bins("AGE_YEARS", names.AGE_EDGES, names.AGE_LABELS),
    "CREDIT_INCOME_BIN": bins("CREDIT_INCOME_RATIO", names.CREDIT_INCOME_EDGES, names.LEVEL_LABELS),
    "EXT_SOURCE_MEAN_BIN": bins("EXT_SOURCE_MEAN", names.EXT_MEAN_EDGES, names.LEVEL_LABELS),
}


def columns(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in exprs.items())


def engineer_sql(source: str) -> str:
    share = {"EMPLOYED_TO_AGE_RATIO": divided("EMPLOYED_YEARS", "AGE_YEARS", 4)}
    plain = {**RATIO_SQL, **FLAG_SQL, "EXT_SOURCE_MEAN": MEAN_SQL, **INTERACTION_SQL}
    one = f"SELECT *, {columns(DURATION_SQL)} FROM {source}"
    two = f"SELECT *, {columns({**share, **plain})} FROM ({one}) AS d"
    return f"SELECT *, {columns(BIN_SQL)} FROM ({two}) AS f"


def hash_sql(key: str = "SK_ID_CURR", seed: int = 42) -> str:
    return f"((({key} % 1000003) * 7919 + {104729 * seed}) % 1000003)"


_MEDIANS = ", ".join(f"median({c}) AS {c}" for c in names.EXTERNAL_SCORES)
_FOLDS = (
    "SELECT *, CAST(ntile(3) OVER (PARTITION BY TARGET ORDER BY "
    f"{hash_sql()}, SK_ID_CURR) - 1 AS INTEGER) AS fold FROM "
)

# Name -> SELECT, each using only names above it.
PARTS: dict[str, str] = {"application": fixture_sql("application")}
PARTS |= {split: fixture_sql(split) for split in SPLIT}
PARTS |= {t: fixture_sql(t) for t in ["scored", *CHILDREN]}
PARTS |= {
    "installment_rows": "SELECT *, DAYS_ENTRY_PAYMENT-DAYS_INSTALMENT AS DAYS_LATE, "
    "AMT_PAYMENT-AMT_INSTALMENT AS PAYMENT_DIFF, AMT_PAYMENT/AMT_INSTALMENT AS PAYMENT_RATIO "
    "FROM installments",
    "train_medians": f"SELECT {_MEDIANS} FROM train",
    "all_medians": f"SELECT {_MEDIANS} FROM application",
    "clean_all": clean_sql("application", "all_medians"),
    "clean_train": clean_sql("train", "train_medians"),
    "clean_test": clean_sql("test", "train_medians"),
    "prepared_all": engineer_sql("clean_all"),
    "prepared_train": engineer_sql("clean_train"),
    "prepared_test": engineer_sql("clean_test"),
}
PARTS |= {f"{t}_agg": h.select() for t, h in HISTORY_SQL.items()}
PARTS |= {
    "folds": _FOLDS + "application",
    "cost": (
        f"SELECT m AS median_amount, m/{dbl(22)} AS loan, m/{dbl(22)}*{dbl(0.04)} AS profit, "
        f"m/{dbl(22)}*{dbl(0.6)}*(1-{dbl(0.25)}) AS loss FROM (SELECT median(AMT_CREDIT) AS m "
        "FROM application) AS a"
    ),
    "grid": "SELECT CAST(i AS DOUBLE)/100 AS threshold FROM range(1, 100) AS g(i)",
    "grid_counts": (
        "SELECT threshold, CAST(count(*) FILTER (WHERE TARGET=0 AND SCORE<threshold) AS BIGINT) AS tn, "
        "count(*) FILTER (WHERE TARGET=0 AND SCORE>=threshold) AS fp, "
        "count(*) FILTER (WHERE TARGET=1 AND SCORE<threshold) AS fn, "
        "count(*) FILTER (WHERE TARGET=1 AND SCORE>=threshold) AS tp "
        "FROM scored, grid GROUP BY threshold"
    ),
    "sweep": (
        f"SELECT threshold, (tn*profit-fn*loss-fp*profit)/1e6 AS net_value_m, "
        f"coalesce({dbl('tp')}/nullif(tp+fp,0),0) AS precision, "
        f"coalesce({dbl('tp')}/nullif(tp+fn,0),0) AS recall, "
        f"{dbl('tn+fn')}/(tn+fp+fn+tp) AS approval_rate FROM grid_counts, cost"
    ),
}


def _needed(text: str) -> list[str]:
    import re

    words = set(re.findall(r"\w+", text))
    wanted: set[str] = set()
    for name in reversed(PARTS):
        if name in words:
            wanted.add(name)
            words |= set(re.findall(r"\w+", PARTS[name]))
    return [name for name in PARTS if name in wanted]


def check_sql(body: str, **more: str) -> str:
    """``body`` with the named SELECTs it uses in front; ``more`` adds local ones."""
    local = [f"{n} AS ({s})" for n, s in more.items()]
    shared = [f"{n} AS ({PARTS[n]})" for n in _needed(" ".join([body, *more.values()]))]
    return f"WITH {', '.join([*shared, *local])} {body}"
