"""The credit feature blocks as configurations of the
operators, in the two published variants (``v2`` = the full job, ``v1`` =
the earlier, richer aggregates with other prefixes).

Each block is ONE aggregate over its table keyed by ``SK_ID_CURR`` (views and
category shares fused in), so each costs one scan and one shuffle; the star
assembly then joins blocks that are already hash-partitioned on the key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (clamp_zero, columns_matching, difference, null_safe_ne, product,
                         row_sum, safe_ratio, sentinel_to_null, shifted_ratio, with_row_stats)
from ..operators import (CategoryDictionary, View, agg_features, all_columns_spec,
                         exact_median, factorize, first_appearance_dictionary, left_star,
                         one_hot, union_by_name)
from ..operators import encode
from ..operators.aggregate import rate_exprs
from ..operators.profile import fill_with_mean
from ..operators.skew import skew_left_join
from ..sources.io import cast_columns

KEY = "SK_ID_CURR"

# Column-name patterns and the binary columns of the application table.
DOC_PATTERN = "FLAG_DOC"
LIVE_PATTERN = "FLAG_"
LIVE_EXCLUDE = ("FLAG_DOC", "_FLAG_")
BINARY_FEATURES = ("CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY")

# View prefixes of each variant.
PREFIXES = {
    "v2": {"bureau": "BURO_", "active": "ACTIVE_", "closed": "CLOSED_", "prev": "PREV_",
           "approved": "APPROVED_", "refused": "REFUSED_", "pos": "POS_", "ins": "INSTAL_",
           "cc": "CC_"},
    "v1": {"bureau": "BURO_", "active": "ACT_", "closed": "CLS_", "prev": "PREV_",
           "approved": "APR_", "refused": "REF_", "pos": "POS_", "ins": "INS_", "cc": "CC_"},
}

# Aggregation specs of each variant.
BUREAU_NUM = {
    "v2": {
        "DAYS_CREDIT": ["mean", "var"],
        "DAYS_CREDIT_ENDDATE": ["mean"],
        "DAYS_CREDIT_UPDATE": ["mean"],
        "CREDIT_DAY_OVERDUE": ["mean"],
        "AMT_CREDIT_MAX_OVERDUE": ["mean"],
        "AMT_CREDIT_SUM": ["mean", "sum"],
        "AMT_CREDIT_SUM_DEBT": ["mean", "sum"],
        "AMT_CREDIT_SUM_OVERDUE": ["mean"],
        "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
        "AMT_ANNUITY": ["max", "mean"],
        "CNT_CREDIT_PROLONG": ["sum"],
        "MONTHS_BALANCE_MIN": ["min"],
        "MONTHS_BALANCE_MAX": ["max"],
        "MONTHS_BALANCE_SIZE": ["mean", "sum"],
    },
    "v1": {
        "DAYS_CREDIT": ["min", "max", "mean", "var"],
        "CREDIT_DAY_OVERDUE": ["max", "mean"],
        "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
        "AMT_CREDIT_MAX_OVERDUE": ["mean"],
        "CNT_CREDIT_PROLONG": ["sum"],
        "AMT_CREDIT_SUM": ["max", "mean", "sum"],
        "AMT_CREDIT_SUM_DEBT": ["max", "mean", "sum"],
        "AMT_CREDIT_SUM_OVERDUE": ["mean"],
        "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
        "DAYS_CREDIT_UPDATE": ["min", "max", "mean"],
        "AMT_ANNUITY": ["max", "mean"],
        "MONTHS_BALANCE_MIN": ["min"],
        "MONTHS_BALANCE_MAX": ["max"],
        "MONTHS_BALANCE_SIZE": ["mean", "sum"],
    },
}
BALANCE_SPEC = {"MONTHS_BALANCE": ["min", "max", "size"]}

PREV_NUM = {
    "v2": {
        "AMT_ANNUITY": ["max", "mean"],
        "AMT_APPLICATION": ["max", "mean"],
        "AMT_CREDIT": ["max", "mean"],
        "APP_CREDIT_PERC": ["max", "mean"],
        "AMT_DOWN_PAYMENT": ["max", "mean"],
        "AMT_GOODS_PRICE": ["max", "mean"],
        "HOUR_APPR_PROCESS_START": ["max", "mean"],
        "RATE_DOWN_PAYMENT": ["max", "mean"],
        "DAYS_DECISION": ["max", "mean"],
        "CNT_PAYMENT": ["mean", "sum"],
    },
    "v1": {
        "AMT_ANNUITY": ["min", "max", "mean"],
        "AMT_APPLICATION": ["min", "max", "mean"],
        "AMT_CREDIT": ["min", "max", "mean"],
        "APP_CREDIT_PERC": ["min", "max", "mean", "var"],
        "AMT_DOWN_PAYMENT": ["min", "max", "mean"],
        "AMT_GOODS_PRICE": ["min", "max", "mean"],
        "HOUR_APPR_PROCESS_START": ["min", "max", "mean"],
        "RATE_DOWN_PAYMENT": ["min", "max", "mean"],
        "DAYS_DECISION": ["min", "max", "mean"],
        "CNT_PAYMENT": ["mean", "sum"],
    },
}
PREV_SENTINEL_COLS = ("DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION",
                      "DAYS_LAST_DUE", "DAYS_TERMINATION")

POS_SPEC = {
    "MONTHS_BALANCE": ["max", "mean", "size"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
}
POS_CASTS = {"MONTHS_BALANCE": "int16", "CNT_INSTALMENT": "float16",
             "CNT_INSTALMENT_FUTURE": "float16", "SK_DPD": "int32", "SK_DPD_DEF": "int32"}

INS_SPEC = {
    "v2": {
        "NUM_INSTALMENT_VERSION": ["nunique"],
        "DPD": ["max", "mean", "sum"],
        "DBD": ["max", "mean", "sum"],
        "PAYMENT_PERC": ["mean", "var"],
        "PAYMENT_DIFF": ["mean", "var"],
        "AMT_INSTALMENT": ["max", "mean", "sum"],
        "AMT_PAYMENT": ["min", "max", "mean", "sum"],
        "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum"],
    },
    "v1": {
        "NUM_INSTALMENT_VERSION": ["nunique"],
        "DPD": ["max", "mean", "sum"],
        "DBD": ["max", "mean", "sum"],
        "PAYMENT_PERC": ["max", "mean", "sum", "var"],
        "PAYMENT_DIFF": ["max", "mean", "sum", "var"],
        "AMT_INSTALMENT": ["max", "mean", "sum"],
        "AMT_PAYMENT": ["min", "max", "mean", "sum"],
        "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum"],
    },
}
CC_FUNCS = {"v2": ["max", "mean", "sum", "var"], "v1": ["min", "max", "mean", "sum", "var"]}


def _categories(df: DataFrame, dictionary: CategoryDictionary | None,
                exclude: Sequence[str] = ()) -> CategoryDictionary:
    from ..functions.columns import string_columns
    if dictionary is not None:
        return dictionary
    return CategoryDictionary.discover(df, string_columns(df, exclude))


# ---------------------------------------------------------------------------
# F1 application

def median_lookup(df: DataFrame, group_col: str, value_col: str, out_col: str,
                  source: DataFrame | None = None) -> DataFrame:
    """``df[group].map(source.groupby(group)[value].median())`` (A8 + E4, J8).

    Medians are exact and skew-safe (:func:`exact_median`). The table of one row a
    category is broadcast if it has at most ``encode.BROADCAST_ROWS`` rows (one row more
    is asked for), so that a group with a large share of ``df`` is not shuffled to one
    task; a larger one is joined by key. Columns: those of ``df``, then ``out_col``.
    """
    med = exact_median(df if source is None else source, [group_col], value_col, out_col="_median") \
        .withColumnRenamed(group_col, "_median_group")
    rows = med.limit(encode.BROADCAST_ROWS + 1).collect()
    if len(rows) <= encode.BROADCAST_ROWS:
        med = F.broadcast(df.sparkSession.createDataFrame(rows, med.schema))
    joined = df.join(med, F.col(group_col) == F.col("_median_group"), "left")
    return joined.withColumnRenamed("_median", out_col).drop("_median_group")


def _application_dictionaries(df: DataFrame, order_cols: Sequence[str],
                              dictionary: CategoryDictionary | None,
                              codes: dict | None = None):
    """Both dictionaries of the application block from ONE job on the base
    rows: first-appearance codes of the binary columns (E2) and the sorted
    categories of the other string columns (E3). The feature columns are
    added later, so this job scans only the (filtered) application rows.
    Frozen dictionaries (scoring) skip the job."""
    from ..functions.columns import string_columns
    if dictionary is not None and codes is not None:
        return codes, dictionary
    strings = string_columns(df)
    order = F.struct(*[F.col(c) for c in order_cols]).alias("_ord")
    first = first_appearance_dictionary(df.select(order, *strings), strings, "_ord")
    codes = {b: first[b] for b in BINARY_FEATURES if b in first}
    if dictionary is None:
        dictionary = CategoryDictionary({c: sorted(first[c]) for c in strings
                                         if c not in BINARY_FEATURES})
    return codes, dictionary


def application_features(train: DataFrame, test: DataFrame, variant: str = "v2",
                         nan_as_category: bool | None = None,
                         dictionary: CategoryDictionary | None = None,
                         order_cols: Sequence[str] | None = None,
                         codes: dict | None = None) -> DataFrame:
    """one row per applicant of train + test.

    ``dictionary`` (one-hot categories) and ``codes`` (binary-column codes)
    freeze the encodings, e.g. those of a training run, for scoring.

    v2: union -> drop gender ``XNA`` (keeps NULL) -> DAYS_EMPLOYED sentinel ->
    ratio / row-statistic / group-median features -> first-appearance codes
    of the binary columns -> one-hot of the other string columns (no missing
    indicator by default). v1: codes and one-hot (with missing indicator)
    first, then sentinel and its four ratios; no ``XNA`` filter.

    "First appearance" is the order train-before-test, then the row number
    ``index`` in file order where both tables have it, else the key.
    """
    if order_cols is None:
        order_cols = ("_part", "index" if "index" in train.columns and "index" in test.columns else KEY)
    df = union_by_name(train.withColumn("_part", F.lit(0)), test.withColumn("_part", F.lit(1)))
    if variant == "v1":
        nan = True if nan_as_category is None else nan_as_category
        codes, cats = _application_dictionaries(df, order_cols, dictionary, codes)
        df, _ = factorize(df, list(BINARY_FEATURES), order_col="_part", dictionary=codes)
        df, _ = one_hot(df, cats, cats.columns(), nan_indicator=nan)
        df = df.withColumn("DAYS_EMPLOYED", sentinel_to_null("DAYS_EMPLOYED"))
        df = df.withColumns({
            "DAYS_EMPLOYED_PERC": safe_ratio("DAYS_EMPLOYED", "DAYS_BIRTH"),
            "INCOME_CREDIT_PERC": safe_ratio("AMT_INCOME_TOTAL", "AMT_CREDIT"),
            "INCOME_PER_PERSON": safe_ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
            "ANNUITY_INCOME_PERC": safe_ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        })
        return df.drop("_part", "index")

    nan = False if nan_as_category is None else nan_as_category
    df = df.where(null_safe_ne("CODE_GENDER", "XNA"))
    codes, cats = _application_dictionaries(df, order_cols, dictionary, codes)
    docs = columns_matching(df, contains=[DOC_PATTERN])
    live = [c for c in columns_matching(df, contains=[LIVE_PATTERN], excludes=LIVE_EXCLUDE,
                                        numeric_only=True)]
    df = df.withColumn("DAYS_EMPLOYED", sentinel_to_null("DAYS_EMPLOYED"))
    df = median_lookup(df, "ORGANIZATION_TYPE", "AMT_INCOME_TOTAL", "NEW_INC_BY_ORG")
    ext = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    df = df.withColumns({
        "NEW_CREDIT_TO_ANNUITY_RATIO": safe_ratio("AMT_CREDIT", "AMT_ANNUITY"),
        "NEW_CREDIT_TO_GOODS_RATIO": safe_ratio("AMT_CREDIT", "AMT_GOODS_PRICE"),
        "NEW_LIVE_IND_SUM": row_sum(live),
        "NEW_INC_PER_CHLD": shifted_ratio("AMT_INCOME_TOTAL", "CNT_CHILDREN"),
        "NEW_EMPLOY_TO_BIRTH_RATIO": safe_ratio("DAYS_EMPLOYED", "DAYS_BIRTH"),
        "NEW_ANNUITY_TO_INCOME_RATIO": shifted_ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "NEW_SOURCES_PROD": product(*ext),
        "NEW_CAR_TO_BIRTH_RATIO": safe_ratio("OWN_CAR_AGE", "DAYS_BIRTH"),
        "NEW_CAR_TO_EMPLOY_RATIO": safe_ratio("OWN_CAR_AGE", "DAYS_EMPLOYED"),
        # The original assigns this name twice and keeps the second;
        # the first formula is kept under a _RAW name.
        "NEW_PHONE_TO_BIRTH_RATIO_RAW": safe_ratio("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
        "NEW_PHONE_TO_BIRTH_RATIO": safe_ratio("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
        "NEW_CREDIT_TO_INCOME_RATIO": safe_ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    })
    if docs:
        df = with_row_stats(df, docs, {"kurt": "NEW_DOC_IND_KURT"})
    else:
        df = df.withColumn("NEW_DOC_IND_KURT", F.lit(None).cast("double"))
    df = with_row_stats(df, ext, {"mean": "NEW_EXT_SOURCES_MEAN", "std": "NEW_SCORES_STD"})
    df = fill_with_mean(df, ["NEW_SCORES_STD"])
    df, _ = factorize(df, list(BINARY_FEATURES), order_col="_part", dictionary=codes)
    df, _ = one_hot(df, cats, cats.columns(), nan_indicator=nan)
    return df.drop("_part", "index")


# ---------------------------------------------------------------------------
# F2 bureau + monthly balance

def bureau_and_balance(bureau: DataFrame, balance: DataFrame, variant: str = "v2",
                       nan_as_category: bool = True,
                       bureau_dictionary: CategoryDictionary | None = None,
                       balance_dictionary: CategoryDictionary | None = None) -> DataFrame:
    """loan-level aggregate of the monthly balance (min/max/size of the
    month, share of each status) joined to the loans, then ONE applicant
    aggregate holding all-loan features + category shares + Active / Closed
    views (A12, A11, A10)."""
    p = PREFIXES[variant]
    bb_cats = _categories(balance, balance_dictionary, exclude=["SK_ID_BUREAU"])
    bb_agg = agg_features(balance, "SK_ID_BUREAU", BALANCE_SPEC, categories=bb_cats,
                          nan_indicator=nan_as_category)
    b_cats = _categories(bureau, bureau_dictionary, exclude=[KEY, "SK_ID_BUREAU"])
    # loans without a key need no balance and meet no other row in the join
    loans = skew_left_join(bureau, bb_agg, "SK_ID_BUREAU").drop("SK_ID_BUREAU")
    num = BUREAU_NUM[variant]
    bb_share_cols = {}
    for c in bb_cats.columns():
        for v in bb_cats[c] + ([None] if nan_as_category else []):
            name = f"{c}_{'nan' if v is None else v}_MEAN"
            bb_share_cols[name] = ["mean"]
    spec = {**num, **bb_share_cols}
    views = [View(p["active"], F.col("CREDIT_ACTIVE").eqNullSafe("Active"), num),
             View(p["closed"], F.col("CREDIT_ACTIVE").eqNullSafe("Closed"), num)]
    return agg_features(loans, KEY, spec, prefix=p["bureau"], categories=b_cats,
                        nan_indicator=nan_as_category, views=views)


# ---------------------------------------------------------------------------
# F3 previous applications

def previous_applications(prev: DataFrame, variant: str = "v2", nan_as_category: bool = True,
                          dictionary: CategoryDictionary | None = None) -> DataFrame:
    p = PREFIXES[variant]
    cats = _categories(prev, dictionary, exclude=[KEY])
    prev = prev.withColumns({c: sentinel_to_null(c) for c in PREV_SENTINEL_COLS if c in prev.columns})
    prev = prev.withColumn("APP_CREDIT_PERC", safe_ratio("AMT_APPLICATION", "AMT_CREDIT"))
    num = PREV_NUM[variant]
    views = [View(p["approved"], F.col("NAME_CONTRACT_STATUS").eqNullSafe("Approved"), num),
             View(p["refused"], F.col("NAME_CONTRACT_STATUS").eqNullSafe("Refused"), num)]
    return agg_features(prev, KEY, num, prefix=p["prev"], categories=cats,
                        nan_indicator=nan_as_category, views=views)


# ---------------------------------------------------------------------------
# F4 POS cash

def pos_cash(pos: DataFrame, variant: str = "v2", nan_as_category: bool = True,
             dictionary: CategoryDictionary | None = None) -> DataFrame:
    p = PREFIXES[variant]
    if variant == "v1":
        pos = cast_columns(pos, {c: t for c, t in POS_CASTS.items() if c in pos.columns})
    cats = _categories(pos, dictionary, exclude=[KEY])
    return agg_features(pos, KEY, POS_SPEC, prefix=p["pos"], categories=cats,
                        nan_indicator=nan_as_category, count_name=f"{p['pos']}COUNT")


# ---------------------------------------------------------------------------
# F5 installments

def installments_payments(ins: DataFrame, variant: str = "v2", nan_as_category: bool = True,
                          dictionary: CategoryDictionary | None = None) -> DataFrame:
    p = PREFIXES[variant]
    cats = _categories(ins, dictionary, exclude=[KEY])
    ins = ins.withColumns({
        "PAYMENT_PERC": safe_ratio("AMT_PAYMENT", "AMT_INSTALMENT"),
        "PAYMENT_DIFF": difference("AMT_INSTALMENT", "AMT_PAYMENT"),
        "DPD": clamp_zero(difference("DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT")),
        "DBD": clamp_zero(difference("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT")),
    })
    return agg_features(ins, KEY, INS_SPEC[variant], prefix=p["ins"], categories=cats,
                        nan_indicator=nan_as_category, count_name=f"{p['ins']}COUNT")


# ---------------------------------------------------------------------------
# F6 credit card

def credit_card_balance(cc: DataFrame, variant: str = "v2", nan_as_category: bool = True,
                        dictionary: CategoryDictionary | None = None) -> DataFrame:
    """the same function list over every column (one-hot indicators
    included; A13). The indicators are projections fused into the partial
    aggregate, never a materialised wide table."""
    p = PREFIXES[variant]
    cc = cc.drop("SK_ID_PREV")
    cats = _categories(cc, dictionary, exclude=[KEY])
    enc, _ = one_hot(cc, cats, cats.columns(), nan_indicator=nan_as_category)
    spec = all_columns_spec(enc, CC_FUNCS[variant], exclude=[KEY])
    return agg_features(enc, KEY, spec, prefix=p["cc"], count_name=f"{p['cc']}COUNT")


# ---------------------------------------------------------------------------
# F7 bureau rates (earliest script)

def bureau_rates(applicants: DataFrame, loans: DataFrame, applicant_key: str = KEY,
                 loan_key: str = KEY, status_col: str = "CREDIT_ACTIVE",
                 type_col: str = "CREDIT_TYPE", mean_cols: Sequence[str] = (),
                 mean_std_cols: Sequence[str] = (), currency_col: str | None = None,
                 status_values: Sequence[str] | None = None,
                 type_values: Sequence[str] | None = None, fanout: bool = False,
                 suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """every applicant with loan counts, status and type rates (missing
    -> 0), means, and mean/std pairs named with the merge suffixes (J5).

    The original joins applicants to loans, re-scans the joined frame 13
    times and left-joins 13 frames (J4). Here the loans are aggregated ONCE
    per key (one shuffle, partial aggregation) and joined 1:1 onto the
    applicants: an applicant without loans counts one row (the NULL row of
    the original fan-out join), so its totals are 1 and its rates 0.

    Currency: by default a share per currency (one row per applicant, D8);
    ``fanout=True`` reproduces the original's one row per (applicant,
    currency) pair.
    """
    if status_values is None or type_values is None:
        cats = CategoryDictionary.discover(loans, [status_col, type_col])
        status_values = status_values if status_values is not None else cats[status_col]
        type_values = type_values if type_values is not None else cats[type_col]
    exprs = [F.count(F.lit(1)).alias("_n")]
    exprs += rate_exprs(status_col, status_values, "credit_rate_")
    exprs += rate_exprs(type_col, type_values, "credit_type_rate_")
    exprs += [F.avg(c).alias(c) for c in mean_cols]
    for c in mean_std_cols:
        exprs += [F.avg(c).alias(c + suffixes[0]), F.stddev_samp(c).alias(c + suffixes[1])]
    cur_names: list[str] = []
    if currency_col and not fanout:
        cur_values = CategoryDictionary.discover(loans, [currency_col])[currency_col]
        share = rate_exprs(currency_col, cur_values, f"{currency_col}_")
        exprs += share
        cur_names = [f"{currency_col}_{v}" for v in cur_values]
    per_key = agg_features(loans, loan_key, None, extra=exprs)
    if loan_key != applicant_key:
        per_key = per_key.withColumnRenamed(loan_key, applicant_key)
    base = applicants.select(applicant_key).where(F.col(applicant_key).isNotNull()).distinct()
    out = base.join(per_key, on=applicant_key, how="left")
    zero = F.lit(0.0)
    cols = [F.col(applicant_key),
            F.coalesce(F.col("_n"), F.lit(1)).cast("long").alias("total_credit_count")]
    cols += [F.coalesce(F.col(f"credit_rate_{v}"), zero).alias(f"credit_rate_{v}") for v in status_values]
    cols += [F.col(c + s) for c in mean_std_cols for s in suffixes]
    cols += [F.col(c) for c in mean_cols]
    cols += [F.coalesce(F.col(n), zero).alias(n) for n in cur_names]
    cols += [F.coalesce(F.col("_n"), F.lit(1)).cast("long").alias("total_credit_type_count")]
    cols += [F.coalesce(F.col(f"credit_type_rate_{v}"), zero).alias(f"credit_type_rate_{v}")
             for v in type_values]
    res = out.select(*cols)
    if currency_col and fanout:
        pairs = loans.select(F.col(loan_key).alias(applicant_key), currency_col).distinct()
        res = res.join(pairs, on=applicant_key, how="left")
    return res


# ---------------------------------------------------------------------------
# assembly

def credit_dictionaries(tables: dict[str, DataFrame], variant: str = "v2") -> dict:
    """All category dictionaries of the feature table, one small job per
    table (hard part 7.4.2): computed on training data and passed to
    :func:`credit_feature_table` at scoring time, they keep the schema fixed
    and give unseen categories all-zero indicators."""
    df = union_by_name(tables["application_train"].withColumn("_part", F.lit(0)),
                       tables["application_test"].withColumn("_part", F.lit(1)))
    if variant != "v1":
        df = df.where(null_safe_ne("CODE_GENDER", "XNA"))
    codes, cats = _application_dictionaries(df, ("_part", KEY), None)
    return {
        "application": cats, "application_codes": codes,
        "bureau": _categories(tables["bureau"], None, exclude=[KEY, "SK_ID_BUREAU"]),
        "bureau_balance": _categories(tables["bureau_balance"], None, exclude=["SK_ID_BUREAU"]),
        "previous_application": _categories(tables["previous_application"], None, exclude=[KEY]),
        "POS_CASH_balance": _categories(tables["POS_CASH_balance"], None, exclude=[KEY]),
        "installments_payments": _categories(tables["installments_payments"], None, exclude=[KEY]),
        "credit_card_balance": _categories(tables["credit_card_balance"].drop("SK_ID_PREV"), None,
                                           exclude=[KEY]),
    }


def credit_dictionaries_to_json(dictionaries: dict) -> str:
    import json
    return json.dumps({k: (v.categories if isinstance(v, CategoryDictionary) else v)
                       for k, v in dictionaries.items()}, sort_keys=True)


def credit_dictionaries_from_json(text: str) -> dict:
    import json
    raw = json.loads(text)
    return {k: (v if k == "application_codes" else CategoryDictionary(v)) for k, v in raw.items()}


def credit_feature_table(tables: dict[str, DataFrame], variant: str = "v2",
                         dictionaries: dict | None = None,
                         watch: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """F1 LEFT JOIN F2 ... F6 on the applicant key (J3), the input of the
    learning job (F8). ``tables`` holds the eight credit tables by name;
    ``dictionaries`` (from :func:`credit_dictionaries`) freezes every
    encoding, otherwise each block discovers its own. ``watch`` is handed every
    block and the result by name and returns them, e.g. with a row counter."""
    d = dictionaries or {}
    app = application_features(tables["application_train"], tables["application_test"], variant,
                               dictionary=d.get("application"), codes=d.get("application_codes"))
    blocks = [
        bureau_and_balance(tables["bureau"], tables["bureau_balance"], variant,
                           bureau_dictionary=d.get("bureau"),
                           balance_dictionary=d.get("bureau_balance")),
        previous_applications(tables["previous_application"], variant,
                              dictionary=d.get("previous_application")),
        pos_cash(tables["POS_CASH_balance"], variant, dictionary=d.get("POS_CASH_balance")),
        installments_payments(tables["installments_payments"], variant,
                              dictionary=d.get("installments_payments")),
        credit_card_balance(tables["credit_card_balance"], variant,
                            dictionary=d.get("credit_card_balance")),
    ]
    if watch is None:
        return left_star(app, KEY, blocks)
    names = ("bureau", "previous_applications", "pos_cash", "installments", "credit_card")
    return watch("features", left_star(watch("application", app), KEY, [watch(n, x) for n, x in zip(names, blocks)]))


def read_credit_tables(spark, input_dir: str, fmt: str = "csv",
                       num_rows: int | None = None) -> dict[str, DataFrame]:
    """Scan the eight credit tables with their explicit schemas.

    ``num_rows`` is the debug row cap (S2): the first rows of each file, as
    the original reads them. The application tables get their row number in file
    order as ``index`` (P17).
    """
    import os

    from ..sources.io import read_table
    from ..sources.schemas import CREDIT_SCHEMAS
    out = {}
    for name, schema in CREDIT_SCHEMAS.items():
        path = os.path.join(input_dir, f"{name}.{fmt}") if "://" not in input_dir \
            else f"{input_dir.rstrip('/')}/{name}.{fmt}"
        numbered = "index" if name.startswith("application") else None
        out[name] = read_table(spark, path, schema, fmt=fmt, limit=num_rows, ordinal=numbered)
    return out


def run_credit_model(spark, input_dir: str, submission_path: str | None,
                     variant: str = "v2", num_folds: int = 5, stratified: bool = False,
                     debug: bool = False, fmt: str = "csv", **boost_params):
    """End-to-end job (L10): tables -> feature table (F1 LEFT JOIN F2..F6) ->
    k-fold boosted trees -> submission table (key, TARGET) written without an
    index (L9; skipped in debug mode, like the original). Returns the
    :class:`~featureloom.learn.gbdt.KFoldResult`; its ``report`` has the rows and
    columns of every stage (S7), counted by observations while the feature table
    is written: no extra job."""
    from ..learn.gbdt import kfold_boost
    from ..operators.profile import observe_shape
    from ..sources.io import write_table
    tables = read_credit_tables(spark, input_dir, fmt, num_rows=10_000 if debug else None)
    stages: list[tuple[str, int, object]] = []

    def watch(name: str, df: DataFrame) -> DataFrame:
        df, rows = observe_shape(df, f"{name}-{uuid.uuid4().hex}")
        stages.append((name, len(df.columns), rows))
        return df

    features = credit_feature_table(tables, variant, watch=watch)
    result = kfold_boost(features, key=KEY, label="TARGET", n_folds=num_folds, seed=47,
                         stratified=stratified, **boost_params)
    result.report = [(name, rows.get["rows"], columns) for name, columns, rows in stages]
    if not debug and submission_path:
        write_table(result.submission.select(KEY, "TARGET"), submission_path, fmt="csv")
    return result


def write_credit_blocks(tables: dict[str, DataFrame], output_dir: str, variant: str = "v1",
                        fmt: str = "csv") -> dict[str, str]:
    """The earlier script's shape: every block computed independently and
    written to its own sink (one per block; D4 fixed: no block overwrites
    another). Returns block name -> path."""
    from ..sources.io import write_table
    blocks = {
        "bureau_agg": bureau_and_balance(tables["bureau"], tables["bureau_balance"], variant),
        "prev_agg": previous_applications(tables["previous_application"], variant),
        "pos_agg": pos_cash(tables["POS_CASH_balance"], variant),
        "ins_agg": installments_payments(tables["installments_payments"], variant),
        "cc_agg": credit_card_balance(tables["credit_card_balance"], variant),
    }
    paths = {}
    for name, df in blocks.items():
        path = f"{output_dir.rstrip('/')}/{name}"
        write_table(df, path, fmt=fmt)
        paths[name] = path
    return paths
