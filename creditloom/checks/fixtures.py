"""The loan tables, derived row by row from the star-schema tables.

Every column is a portable expression, so the same text gives the same rows in Spark and in any
other SQL engine. Whole source tables are used: to leave some applicants without history, child
rows of certain customers are handed to the next customer rather than dropped. Applicant keys are
reduced modulo the noise prime before they are multiplied, so no key size overflows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_P = 1000003
# Multipliers of the ten noise terms.
_NOISE = [
    (7919, 23757, 11),
    (104729, 314187, 7728),
    (485818, 457451, 15445),
    (452747, 358238, 23162),
    (979540, 938614, 30879),
    (867766, 603292, 38596),
    (27863, 83589, 46313),
    (949457, 848365, 54030),
    (650516, 951545, 61747),
    (480703, 442106, 69464),
]
_ND = "CAST(NULL AS DOUBLE)"
_NS = "CAST(NULL AS STRING)"


def _d(x: object) -> str:
    return f"CAST({x} AS DOUBLE)"


_TARGET = f"CASE WHEN u_0 < {_d(0.32)}*(1-u_1)*(1-u_2) THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END"
_EDUCATION = (
    "CASE k%5 WHEN 0 THEN 'Higher education' WHEN 1 THEN 'Lower secondary' "
    "WHEN 2 THEN 'Incomplete higher' ELSE 'Secondary / secondary special' END"
)


def _circle(modulus: int) -> str:
    return f"CASE WHEN k%293=12 THEN {_ND} ELSE {_d(f'k%{modulus}')} END"


def _inquiries(modulus: int) -> str:
    return f"CASE WHEN k%8=1 THEN {_ND} ELSE {_d(f'k%{modulus}')} END"


_APPLICATION = {
    "SK_ID_CURR": "k",
    "TARGET": _TARGET,
    "CODE_GENDER": "CASE WHEN k%500=3 THEN 'XNA' WHEN k%3=0 THEN 'M' ELSE 'F' END",
    "FLAG_OWN_CAR": "CASE WHEN k%3=1 THEN 'Y' ELSE 'N' END",
    "OWN_CAR_AGE": f"CASE WHEN k%3=1 AND k%50<>1 THEN {_d('k%25')} ELSE {_ND} END",
    "DAYS_BIRTH": "CAST(-7500-floor(u_3*17500) AS BIGINT)",
    "DAYS_EMPLOYED": "CASE WHEN k%211=9 THEN CAST(NULL AS BIGINT) "
    "WHEN k%11 IN (0,5) THEN CAST(365243 AS BIGINT) ELSE CAST(-floor(u_4*7000) AS BIGINT) END",
    "DAYS_REGISTRATION": _d("-floor(u_9*15000)"),
    "DAYS_ID_PUBLISH": "CAST(-floor(u_8*6000) AS BIGINT)",
    "DAYS_LAST_PHONE_CHANGE": f"CASE WHEN k%307=4 THEN {_ND} ELSE {_d('-floor(u_7*4000)')} END",
    "AMT_INCOME_TOTAL": f"CASE WHEN k%331=6 THEN {_d(0)} ELSE {_d('floor(25650+u_5*400000)')} END",
    "AMT_CREDIT": _d("floor(45000+u_6*1500000)"),
    "AMT_ANNUITY": f"CASE WHEN k%199=7 THEN {_ND} ELSE {_d('floor(2000+u_7*60000)')} END",
    "AMT_GOODS_PRICE": f"CASE WHEN k%97=5 THEN {_ND} ELSE {_d('floor(40000+u_6*1350000)')} END",
    "EXT_SOURCE_1": f"CASE WHEN k%9<5 THEN {_ND} ELSE u_8 END",
    "EXT_SOURCE_2": f"CASE WHEN k%499=2 THEN {_ND} ELSE u_1 END",
    "EXT_SOURCE_3": f"CASE WHEN k%5=4 THEN {_ND} ELSE u_2 END",
    "OCCUPATION_TYPE": f"CASE WHEN k%10<3 THEN {_NS} ELSE c_mktsegment END",
    "NAME_EDUCATION_TYPE": _EDUCATION,
    "NAME_TYPE_SUITE": f"CASE WHEN k%229=8 THEN {_NS} WHEN k%4=0 THEN 'Family' ELSE 'Unaccompanied' END",
    "CNT_FAM_MEMBERS": f"CASE WHEN k%701=10 THEN {_ND} ELSE {_d('1+k%5')} END",
    "OBS_30_CNT_SOCIAL_CIRCLE": _circle(8),
    "DEF_30_CNT_SOCIAL_CIRCLE": _circle(3),
    "OBS_60_CNT_SOCIAL_CIRCLE": _circle(7),
    "DEF_60_CNT_SOCIAL_CIRCLE": _circle(2),
    "AMT_REQ_CREDIT_BUREAU_HOUR": _inquiries(2),
    "AMT_REQ_CREDIT_BUREAU_DAY": _inquiries(3),
    "AMT_REQ_CREDIT_BUREAU_WEEK": _inquiries(4),
    "AMT_REQ_CREDIT_BUREAU_MON": _inquiries(5),
    "AMT_REQ_CREDIT_BUREAU_QRT": _inquiries(6),
    "AMT_REQ_CREDIT_BUREAU_YEAR": _inquiries(9),
    "APARTMENTS_AVG": f"CASE WHEN k%2=0 OR k%3=0 THEN {_ND} ELSE u_9 END",
    "HOUSETYPE_MODE": f"CASE WHEN k%2=0 OR k%7=0 THEN {_NS} ELSE 'block of flats' END",
}
_SCORED = {
    "SK_ID_CURR": "k",
    "TARGET": _TARGET,
    "SCORE": f"{_d('floor((1-u_1)*(1-u_2)*1000)')}/{_d(1000)}",
    "CODE_GENDER": f"CASE WHEN k%500=3 THEN {_NS} WHEN k%3=0 THEN 'M' ELSE 'F' END",
    "NAME_EDUCATION_TYPE": _EDUCATION,
}
_BUREAU = {
    "SK_ID_CURR": "k",
    "CREDIT_ACTIVE": "CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Sold' END",
    "CREDIT_DAY_OVERDUE": "CASE WHEN o_orderpriority='1-URGENT' THEN o_orderkey%60 "
    "ELSE CAST(0 AS BIGINT) END",
    "AMT_CREDIT_SUM": f"CASE WHEN k%53=1 THEN {_d(0)} ELSE o_totalprice END",
    "AMT_CREDIT_SUM_DEBT": f"CASE WHEN o_orderkey%5=0 OR k%41=2 THEN {_ND} "
    f"ELSE o_totalprice*{_d(0.25)} END",
    "AMT_CREDIT_SUM_OVERDUE": f"CASE WHEN o_orderpriority='1-URGENT' THEN o_totalprice*{_d(0.125)} "
    f"ELSE {_d(0)} END",
    "AMT_CREDIT_MAX_OVERDUE": f"CASE WHEN o_orderkey%5<3 THEN {_ND} ELSE o_totalprice*{_d(0.0625)} END",
    "DAYS_CREDIT": "-(1+(o_orderkey*37)%2900)",
}
_PREVIOUS = {
    "SK_ID_CURR": "k",
    "NAME_CONTRACT_STATUS": "CASE WHEN o_orderkey%10<6 THEN 'Approved' WHEN o_orderkey%10<8 "
    "THEN 'Canceled' WHEN o_orderkey%10=8 THEN 'Refused' ELSE 'Unused offer' END",
    "AMT_APPLICATION": f"CASE WHEN k%61=3 THEN {_d(0)} ELSE o_totalprice END",
    "AMT_CREDIT": f"o_totalprice*{_d(0.5)}",
    "DAYS_DECISION": "-(1+(o_orderkey*53)%2900)",
}
_UNPAID = "(l_orderkey+l_linenumber)%83=0"
_INSTALLMENTS = {
    "SK_ID_CURR": "k",
    "DAYS_INSTALMENT": "-(30+(l_orderkey*41)%2800)",
    "DAYS_ENTRY_PAYMENT": f"CASE WHEN {_UNPAID} THEN CAST(NULL AS BIGINT) "
    "ELSE -(30+(l_orderkey*41)%2800) + l_partkey%21 - 12 END",
    "AMT_INSTALMENT": f"CASE WHEN l_partkey%401=0 THEN {_d(0)} ELSE l_extendedprice END",
    "AMT_PAYMENT": f"CASE WHEN {_UNPAID} THEN {_ND} WHEN l_partkey%802=0 THEN {_d(0)} "
    f"WHEN l_discount>={_d(0.08)} THEN l_extendedprice*(1-l_discount) ELSE l_extendedprice END",
}
_POS_CASH = {
    "SK_ID_CURR": "user_id",
    "SK_DPD": "CASE WHEN event_type='click' AND event_id%3=0 THEN event_id%45 ELSE CAST(0 AS BIGINT) END",
    "CNT_INSTALMENT": f"CASE WHEN event_id%71=0 THEN {_ND} ELSE {_d('6+event_id%31')} END",
}
_CREDIT_CARD = {
    "SK_ID_CURR": "user_id",
    "AMT_BALANCE": "value*100",
    "AMT_CREDIT_LIMIT_ACTUAL": "(event_id%10)*4500",
    "AMT_DRAWINGS_CURRENT": f"CASE WHEN event_type='error' THEN {_ND} ELSE value END",
    "SK_DPD": "CASE WHEN event_id%4=0 THEN event_id%30 ELSE CAST(0 AS BIGINT) END",
}


def _noise(key: str) -> dict[str, str]:
    return {
        f"u_{i}": f"{_d(f'(((({key}%{_P})*({key}%{_P}))%{_P})*{a} + ({key}%{_P})*{b} + {c})%{_P}')}/{_d(_P)}"
        for i, (a, b, c) in enumerate(_NOISE)
    }


def _handed_on(key: str, modulus: int) -> dict[str, str]:
    return {"k": f"CASE WHEN {key}%{modulus}=0 THEN {key}+1 ELSE {key} END"}


_CUSTOMER_KEY = {"k": "c_custkey", **_noise("c_custkey")}
_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"

# Table -> (source, filter, helper columns, columns).
_TABLES = {
    "application": ("customer", None, _CUSTOMER_KEY, _APPLICATION),
    "scored": ("customer", None, _CUSTOMER_KEY, _SCORED),
    "bureau": ("orders", None, _handed_on("o_custkey", 7), _BUREAU),
    "previous_application": ("orders", None, _handed_on("o_custkey", 5), _PREVIOUS),
    "installments": (_LINES, None, _handed_on("o_custkey", 6), _INSTALLMENTS),
    "pos_cash": ("events", "event_type IN ('view','click','signup')", {}, _POS_CASH),
    "credit_card": ("events", "event_type IN ('purchase','error')", {}, _CREDIT_CARD),
}
# The two splits of the applications: 11 of 13 keys are for training; the rest carry no label.
SPLIT = {"train": "SK_ID_CURR % 13 >= 2", "test": "SK_ID_CURR % 13 < 2"}
CHILDREN = ["bureau", "previous_application", "installments", "pos_cash", "credit_card"]


def fixture_sql(table: str) -> str:
    """The table as one SELECT over the star-schema tables."""
    if table in SPLIT:
        cols = [c for c in _APPLICATION if table == "train" or c != "TARGET"]
        return f"SELECT {', '.join(cols)} FROM application WHERE {SPLIT[table]}"
    source, where, helpers, cols = _TABLES[table]
    helper = "".join(f", {e} AS {c}" for c, e in helpers.items())
    inner = f"SELECT *{helper} FROM {source}" + (f" WHERE {where}" if where else "")
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in cols.items())} FROM ({inner}) AS src"


def fixture(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table as a DataFrame over the Parquet files of one scale."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    if table in SPLIT:
        rows = fixture(spark, sf_dir, "application").filter(SPLIT[table])
        return rows if table == "train" else rows.drop("TARGET")
    source, where, helpers, cols = _TABLES[table]
    if source == _LINES:
        base = read("lineitem").join(read("orders"), on=_on("l_orderkey", "o_orderkey"))
    else:
        base = read(source)
    if where:
        base = base.filter(where)
    return base.selectExpr("*", *[f"{e} AS {c}" for c, e in helpers.items()]).selectExpr(
        *[f"{e} AS {c}" for c, e in cols.items()]
    )


def _on(left: str, right: str):
    from pyspark.sql import functions as F

    return F.col(left) == F.col(right)


def child_columns(table: str) -> list[str]:
    return list(_TABLES[table][3])


def children(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fixture(spark, sf_dir, name) for name in CHILDREN}
