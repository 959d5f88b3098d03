"""Explicit schemas of the credit tables (types fixed instead of inferred).

Only the columns the feature blocks name are listed; ``read_table`` with
``fmt='csv'`` reads all other columns too and finds their types.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


L, I, D, S, H, Fl = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), \
    T.ShortType(), T.FloatType()

APPLICATION = _schema(
    ("SK_ID_CURR", L), ("TARGET", I), ("CODE_GENDER", S), ("FLAG_OWN_CAR", S),
    ("FLAG_OWN_REALTY", S), ("ORGANIZATION_TYPE", S), ("AMT_INCOME_TOTAL", D),
    ("AMT_CREDIT", D), ("AMT_ANNUITY", D), ("AMT_GOODS_PRICE", D), ("CNT_CHILDREN", I),
    ("CNT_FAM_MEMBERS", D), ("DAYS_EMPLOYED", I), ("DAYS_BIRTH", I),
    ("DAYS_LAST_PHONE_CHANGE", D), ("OWN_CAR_AGE", D), ("EXT_SOURCE_1", D),
    ("EXT_SOURCE_2", D), ("EXT_SOURCE_3", D))

BUREAU = _schema(
    ("SK_ID_CURR", L), ("SK_ID_BUREAU", L), ("CREDIT_ACTIVE", S), ("CREDIT_CURRENCY", S),
    ("CREDIT_TYPE", S), ("DAYS_CREDIT", I), ("DAYS_CREDIT_UPDATE", I),
    ("CREDIT_DAY_OVERDUE", I), ("CNT_CREDIT_PROLONG", I), ("DAYS_CREDIT_ENDDATE", D),
    ("DAYS_ENDDATE_FACT", D), ("AMT_CREDIT_MAX_OVERDUE", D), ("AMT_CREDIT_SUM", D),
    ("AMT_CREDIT_SUM_DEBT", D), ("AMT_CREDIT_SUM_OVERDUE", D), ("AMT_CREDIT_SUM_LIMIT", D),
    ("AMT_ANNUITY", D))

BUREAU_BALANCE = _schema(("SK_ID_BUREAU", L), ("MONTHS_BALANCE", I), ("STATUS", S))

PREVIOUS_APPLICATION = _schema(
    ("SK_ID_CURR", L), ("NAME_CONTRACT_STATUS", S), ("AMT_ANNUITY", D),
    ("AMT_APPLICATION", D), ("AMT_CREDIT", D), ("AMT_DOWN_PAYMENT", D),
    ("AMT_GOODS_PRICE", D), ("RATE_DOWN_PAYMENT", D), ("CNT_PAYMENT", D),
    ("HOUR_APPR_PROCESS_START", I), ("DAYS_DECISION", I), ("DAYS_FIRST_DRAWING", D),
    ("DAYS_FIRST_DUE", D), ("DAYS_LAST_DUE_1ST_VERSION", D), ("DAYS_LAST_DUE", D),
    ("DAYS_TERMINATION", D))

POS_CASH_BALANCE = _schema(
    ("SK_ID_CURR", L), ("MONTHS_BALANCE", H), ("CNT_INSTALMENT", Fl),
    ("CNT_INSTALMENT_FUTURE", Fl), ("SK_DPD", I), ("SK_DPD_DEF", I))

INSTALLMENTS_PAYMENTS = _schema(
    ("SK_ID_CURR", L), ("NUM_INSTALMENT_VERSION", D), ("DAYS_INSTALMENT", D),
    ("DAYS_ENTRY_PAYMENT", D), ("AMT_INSTALMENT", D), ("AMT_PAYMENT", D))

CREDIT_CARD_BALANCE = _schema(("SK_ID_PREV", L), ("SK_ID_CURR", L))

CREDIT_SCHEMAS = {
    "application_train": APPLICATION,
    "application_test": T.StructType([f for f in APPLICATION.fields if f.name != "TARGET"]),
    "bureau": BUREAU,
    "bureau_balance": BUREAU_BALANCE,
    "previous_application": PREVIOUS_APPLICATION,
    "POS_CASH_balance": POS_CASH_BALANCE,
    "installments_payments": INSTALLMENTS_PAYMENTS,
    "credit_card_balance": CREDIT_CARD_BALANCE,
}
