"""Hand-made credit tables (FIXTURES.md) covering the cases of its §2."""

from __future__ import annotations

import numpy as np
import pandas as pd

N = None

APP_COLS = ["SK_ID_CURR", "TARGET", "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY",
            "ORGANIZATION_TYPE", "NAME_EDUCATION", "AMT_INCOME_TOTAL", "AMT_CREDIT",
            "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_CHILDREN", "CNT_FAM_MEMBERS",
            "DAYS_EMPLOYED", "DAYS_BIRTH", "DAYS_LAST_PHONE_CHANGE", "OWN_CAR_AGE",
            "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
            "FLAG_DOC_A", "FLAG_DOC_B", "FLAG_DOC_C", "FLAG_DOC_D", "FLAG_DOC_E",
            "FLAG_PHONE_X", "FLAG_MAIL_X", "REG_FLAG_X"]
APP_SCHEMA = (
    "SK_ID_CURR long, TARGET int, CODE_GENDER string, FLAG_OWN_CAR string, "
    "FLAG_OWN_REALTY string, ORGANIZATION_TYPE string, NAME_EDUCATION string, "
    "AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, AMT_GOODS_PRICE double, "
    "CNT_CHILDREN int, CNT_FAM_MEMBERS double, DAYS_EMPLOYED int, DAYS_BIRTH int, "
    "DAYS_LAST_PHONE_CHANGE double, OWN_CAR_AGE double, EXT_SOURCE_1 double, "
    "EXT_SOURCE_2 double, EXT_SOURCE_3 double, FLAG_DOC_A int, FLAG_DOC_B int, FLAG_DOC_C int, "
    "FLAG_DOC_D int, FLAG_DOC_E int, FLAG_PHONE_X int, FLAG_MAIL_X int, REG_FLAG_X int")

# first appearance of CODE_GENDER is F, then M (not alphabetical, not frequency)
APP_TRAIN = [
    (1, 0, "F", "N", "Y", "Org B", "Higher", 100000.0, 200000.0, 10000.0, 180000.0, 0, 2.0,
     -1000, -10000, -100.0, None, 0.5, 0.6, 0.7, 0, 0, 0, 0, 0, 1, 0, 1),
    (2, 1, "M", "Y", "N", "Org A", "Secondary", 50000.0, 100000.0, 0.0, 90000.0, 2, 4.0,
     365243, -15000, -200.0, 5.0, None, None, None, 1, 0, 1, N, N, 0, 1, 0),
    (3, 0, "XNA", "N", "Y", "Org A", "Higher", 70000.0, 150000.0, 7000.0, 140000.0, 1, 3.0,
     -500, -12000, -50.0, None, 0.3, None, None, 1, 1, 1, 1, 1, 1, 1, 1),
    (4, 0, None, "N", None, "Org B", None, 120000.0, 0.0, 12000.0, 0.0, 0, 1.0,
     -2000, -20000, 0.0, 10.0, 0.2, 0.4, None, 0, 1, 0, 1, 1, 0, 0, 0),
    (5, 1, "M", "Y", "Y", None, "Secondary", 80000.0, 160000.0, 8000.0, 150000.0, 3, 5.0,
     -3000, -11000, -300.0, 2.0, 0.9, 0.1, 0.5, 1, 1, 0, 0, 1, 1, 1, 0),
    (6, 0, "F", "N", "N", "Org A", "Higher", 60000.0, 120000.0, 6000.0, 100000.0, 0, 1.0,
     -100, -9000, -10.0, None, 0.4, 0.4, 0.4, 0, 0, 0, 0, 0, 0, 0, 0),
    (7, 1, "M", "N", "Y", "Org C", "Lower", 40000.0, 80000.0, 4000.0, 75000.0, 1, 2.0,
     -4000, -16000, -400.0, 7.0, 0.1, 0.2, 0.3, 1, 0, 0, 0, 0, 1, 0, 1),
    (8, 0, "F", "Y", "Y", "Org B", "Secondary", 90000.0, 180000.0, 9000.0, 170000.0, 2, 4.0,
     -1500, -14000, -150.0, 3.0, 0.6, 0.7, 0.8, 0, 0, 1, 0, 0, 0, 1, 0),
]
APP_TEST = [
    (9, N, "M", "N", "Y", "Org A", "Higher", 65000.0, 130000.0, 6500.0, 120000.0, 0, 1.0,
     -700, -13000, -70.0, None, 0.5, None, 0.5, 0, 0, 0, 0, 0, 1, 1, 1),
    (10, N, "F", "Y", "N", "Org C", "Lower", 30000.0, 60000.0, 3000.0, 55000.0, 1, 2.0,
     365243, -17000, -30.0, 1.0, 0.2, 0.3, 0.4, 1, 1, 1, 1, 0, 0, 0, 0),
    (11, N, "F", "N", "Y", "Org B", "Higher", 110000.0, 220000.0, 11000.0, 200000.0, 0, 2.0,
     -2500, -18000, -250.0, None, None, 0.9, None, 0, 0, 0, 0, 0, 0, 0, 0),
]

BUREAU_COLS = ["SK_ID_CURR", "SK_ID_BUREAU", "CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE",
               "DAYS_CREDIT", "DAYS_CREDIT_UPDATE", "CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG",
               "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "AMT_CREDIT_MAX_OVERDUE",
               "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE",
               "AMT_CREDIT_SUM_LIMIT", "AMT_ANNUITY"]
BUREAU_SCHEMA = (
    "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, CREDIT_CURRENCY string, "
    "CREDIT_TYPE string, DAYS_CREDIT int, DAYS_CREDIT_UPDATE int, CREDIT_DAY_OVERDUE int, "
    "CNT_CREDIT_PROLONG int, DAYS_CREDIT_ENDDATE double, DAYS_ENDDATE_FACT double, "
    "AMT_CREDIT_MAX_OVERDUE double, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, "
    "AMT_CREDIT_SUM_OVERDUE double, AMT_CREDIT_SUM_LIMIT double, AMT_ANNUITY double")
BUREAU = [
    (1, 100, "Active", "currency 1", "Consumer", -100, -10, 0, 0, 200.0, None, None, 5000.0, 1000.0, 0.0, None, None),
    (1, 101, "Closed", "currency 2", "Car", -400, -50, 0, 1, -100.0, -90.0, 100.0, 8000.0, 0.0, 0.0, 0.0, 500.0),
    (1, 102, "Active", "currency 1", "Consumer", -50, -5, 10, 0, 300.0, None, 50.0, 2000.0, None, 0.0, 100.0, None),
    (2, 200, "Closed", "currency 1", "Consumer", -900, -400, 0, 0, -800.0, -850.0, None, None, None, None, None, None),
    (4, 400, "Active", "currency 1", "Mortgage", -30, -2, 0, 2, 1000.0, None, 0.0, 90000.0, 80000.0, 0.0, 0.0, 3000.0),
    (5, 500, "Sold", "currency 1", "Consumer", -700, -600, 0, 0, -500.0, -500.0, None, 1000.0, 0.0, 0.0, None, None),
    (5, 501, None, None, None, -60, -6, 0, 0, None, None, None, 300.0, None, None, None, None),
    (6, 600, "Closed", "currency 1", "Car", -1000, -900, 0, 0, -950.0, -960.0, 0.0, 4000.0, 0.0, 0.0, 0.0, 100.0),
    (9, 900, "Active", "currency 3", "Consumer", -20, -1, 0, 0, 50.0, None, None, 700.0, 700.0, 0.0, None, None),
    (None, 999, "Active", "currency 1", "Consumer", -1, -1, 0, 0, 1.0, None, None, 1.0, 1.0, 0.0, None, None),
]
BB_SCHEMA = "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string"
BUREAU_BALANCE = [
    (100, 0, "C"), (100, -1, "0"), (100, -2, "0"), (100, -3, "1"),
    (101, -10, "C"), (101, -11, "X"),
    (102, -1, None),
    (200, -30, "C"), (200, -31, "C"),
    (400, 0, "0"), (400, -1, "5"),
    (900, 0, "X"),
    # loans 500, 501, 600 have no monthly rows
]

PREV_COLS = ["SK_ID_CURR", "NAME_CONTRACT_STATUS", "NAME_CLIENT_TYPE", "AMT_ANNUITY",
             "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE",
             "RATE_DOWN_PAYMENT", "CNT_PAYMENT", "HOUR_APPR_PROCESS_START", "DAYS_DECISION",
             "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION",
             "DAYS_LAST_DUE", "DAYS_TERMINATION"]
PREV_SCHEMA = (
    "SK_ID_CURR long, NAME_CONTRACT_STATUS string, NAME_CLIENT_TYPE string, AMT_ANNUITY double, "
    "AMT_APPLICATION double, AMT_CREDIT double, AMT_DOWN_PAYMENT double, AMT_GOODS_PRICE double, "
    "RATE_DOWN_PAYMENT double, CNT_PAYMENT double, HOUR_APPR_PROCESS_START int, "
    "DAYS_DECISION int, DAYS_FIRST_DRAWING double, DAYS_FIRST_DUE double, "
    "DAYS_LAST_DUE_1ST_VERSION double, DAYS_LAST_DUE double, DAYS_TERMINATION double")
PREV = [
    (1, "Approved", "New", 1000.0, 10000.0, 9000.0, 0.0, 10000.0, 0.0, 12.0, 10, -100, 365243.0, -90.0, 300.0, 365243.0, 365243.0),
    (1, "Refused", "Repeater", None, 5000.0, 0.0, None, 5000.0, None, None, 15, -50, None, None, None, None, None),
    (1, "Approved", "Repeater", 2000.0, 20000.0, 20000.0, 1000.0, 20000.0, 0.05, 24.0, 9, -300, -280.0, -250.0, 400.0, -20.0, -10.0),
    (2, "Canceled", "New", None, 0.0, 0.0, None, None, None, None, 12, -10, None, None, None, None, None),
    (3, "Refused", None, 500.0, 4000.0, 3500.0, 100.0, 4000.0, 0.02, 6.0, 18, -700, None, None, None, None, None),
    (5, "Approved", "New", 300.0, 3000.0, 3300.0, 0.0, 3000.0, 0.0, 10.0, 11, -20, -10.0, -5.0, 100.0, 50.0, 60.0),
    (10, "Refused", "Refreshed", 800.0, 8000.0, 7000.0, 0.0, 8000.0, 0.0, 10.0, 8, -40, None, None, None, None, None),
]

POS_SCHEMA = ("SK_ID_CURR long, MONTHS_BALANCE int, CNT_INSTALMENT double, "
              "CNT_INSTALMENT_FUTURE double, SK_DPD int, SK_DPD_DEF int, STATUS_NAME string")
POS = [
    (1, -1, 12.0, 6.0, 0, 0, "Active"), (1, -2, 12.0, 7.0, 5, 0, "Active"),
    (1, -3, 12.0, 8.0, 0, 3, "Completed"), (2, -1, 24.0, 20.0, 0, 0, None),
    (5, -10, 6.0, 0.0, 30, 30, "Active"), (9, -1, 10.0, 9.0, 0, 0, "Signed"),
]

INS_SCHEMA = ("SK_ID_CURR long, NUM_INSTALMENT_VERSION double, DAYS_INSTALMENT double, "
              "DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double")
INS = [
    (1, 1.0, -100.0, -105.0, 1000.0, 1000.0), (1, 1.0, -70.0, -60.0, 1000.0, 900.0),
    (1, None, -40.0, None, 1000.0, None),          # payment date missing: DPD = DBD = 0
    (1, 2.0, -10.0, -10.0, 0.0, 50.0),             # zero instalment: ratio NULL
    (2, 1.0, -30.0, -35.0, 500.0, 500.0),          # single row: var NULL
    (5, 0.0, -5.0, -1.0, 0.0, 0.0),                # 0/0
    (5, 1.0, -6.0, -1.0, 200.0, 100.0),
]

CC_SCHEMA = "SK_ID_PREV long, SK_ID_CURR long, NUM_A double, NUM_B double, CAT_A string"
CC = [
    (1000, 1, 1.0, 10.0, "x"), (1001, 1, 3.0, None, "y"), (1002, 1, None, None, None),
    (2000, 2, 5.0, 7.0, "x"), (5000, 5, 0.0, 0.0, "z"),
]


def spark_tables(spark):
    from pyspark.sql import functions as F  # noqa: F401
    train = spark.createDataFrame(APP_TRAIN, APP_SCHEMA)
    test = spark.createDataFrame(APP_TEST, APP_SCHEMA).drop("TARGET")
    return {
        "application_train": train,
        "application_test": test,
        "bureau": spark.createDataFrame(BUREAU, BUREAU_SCHEMA),
        "bureau_balance": spark.createDataFrame(BUREAU_BALANCE, BB_SCHEMA),
        "previous_application": spark.createDataFrame(PREV, PREV_SCHEMA),
        "POS_CASH_balance": spark.createDataFrame(POS, POS_SCHEMA),
        "installments_payments": spark.createDataFrame(INS, INS_SCHEMA),
        "credit_card_balance": spark.createDataFrame(CC, CC_SCHEMA),
    }


def pandas_tables():
    def frame(rows, schema):
        cols = [c.strip().split(" ")[0] for c in schema.split(",")]
        return pd.DataFrame(rows, columns=cols).fillna(np.nan)
    train = frame(APP_TRAIN, APP_SCHEMA)
    test = frame(APP_TEST, APP_SCHEMA).drop(columns=["TARGET"])
    return {
        "application_train": train, "application_test": test,
        "bureau": frame(BUREAU, BUREAU_SCHEMA), "bureau_balance": frame(BUREAU_BALANCE, BB_SCHEMA),
        "previous_application": frame(PREV, PREV_SCHEMA), "POS_CASH_balance": frame(POS, POS_SCHEMA),
        "installments_payments": frame(INS, INS_SCHEMA), "credit_card_balance": frame(CC, CC_SCHEMA),
    }
