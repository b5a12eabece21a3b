"""Explicit schemas: the columns of each loan table that the operators name.

An explicit schema saves the extra pass over the files that type inference needs. A CSV file with
more columns than these should be read with a schema that lists all of them, in file order, or
with ``schema=None`` to infer.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..plans.loan_columns import HOUSING, INQUIRY_COUNTS

_TYPES = {"D": DoubleType(), "L": LongType(), "S": StringType()}


def _schema(text: str) -> StructType:
    fields = (entry.split(":") for entry in text.split())
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields])


_HOUSING_TEXT = {"FONDKAPREMONT_MODE", "HOUSETYPE_MODE", "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE"}

APPLICATION = _schema(
    "SK_ID_CURR:L TARGET:L CODE_GENDER:S FLAG_OWN_CAR:S OWN_CAR_AGE:D DAYS_BIRTH:L DAYS_EMPLOYED:L "
    "DAYS_REGISTRATION:D DAYS_ID_PUBLISH:L DAYS_LAST_PHONE_CHANGE:D AMT_INCOME_TOTAL:D AMT_CREDIT:D "
    "AMT_ANNUITY:D AMT_GOODS_PRICE:D EXT_SOURCE_1:D EXT_SOURCE_2:D EXT_SOURCE_3:D OCCUPATION_TYPE:S "
    "NAME_EDUCATION_TYPE:S NAME_TYPE_SUITE:S CNT_FAM_MEMBERS:D OBS_30_CNT_SOCIAL_CIRCLE:D "
    "DEF_30_CNT_SOCIAL_CIRCLE:D OBS_60_CNT_SOCIAL_CIRCLE:D DEF_60_CNT_SOCIAL_CIRCLE:D "
    + " ".join(f"{c}:D" for c in INQUIRY_COUNTS)
    + " "
    + " ".join(f"{c}:{'S' if c in _HOUSING_TEXT else 'D'}" for c in HOUSING)
)

SCHEMAS: dict[str, StructType] = {
    "application_train": APPLICATION,
    "application_test": StructType([f for f in APPLICATION if f.name != "TARGET"]),
    "bureau": _schema(
        "SK_ID_CURR:L CREDIT_ACTIVE:S CREDIT_DAY_OVERDUE:L AMT_CREDIT_SUM:D AMT_CREDIT_SUM_DEBT:D "
        "AMT_CREDIT_SUM_OVERDUE:D AMT_CREDIT_MAX_OVERDUE:D DAYS_CREDIT:L"
    ),
    "previous_application": _schema(
        "SK_ID_CURR:L NAME_CONTRACT_STATUS:S AMT_APPLICATION:D AMT_CREDIT:D DAYS_DECISION:L"
    ),
    "installments": _schema(
        "SK_ID_CURR:L DAYS_INSTALMENT:L DAYS_ENTRY_PAYMENT:L AMT_INSTALMENT:D AMT_PAYMENT:D"
    ),
    "pos_cash": _schema("SK_ID_CURR:L SK_DPD:L CNT_INSTALMENT:D"),
    "credit_card": _schema(
        "SK_ID_CURR:L AMT_BALANCE:D AMT_CREDIT_LIMIT_ACTUAL:L AMT_DRAWINGS_CURRENT:D SK_DPD:L"
    ),
}
