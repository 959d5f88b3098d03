"""The survey's driver queries as Spark plans + DuckDB oracles.

Role mapping of the credit data onto the driver tables:
applicant -> ``customer`` (``c_custkey``); loans at other lenders and previous
applications -> ``orders`` (``o_custkey``; views on ``o_orderstatus``);
monthly loan balance -> ``lineitem`` (``l_orderkey``); installments / POS /
cards -> ``events`` (``user_id``). The tables contain no NULL, so some
queries first derive missing values with ``nullif``.

Every query reads whole tables. Result doubles that come from aggregates are
rounded (both sides, same digits) because two engines sum in different
orders; values from a single IEEE operation are compared unrounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (clamp_zero, columns_matching, difference, null_safe_ne, safe_ratio,
                         sentinel_to_null, shifted_ratio, with_row_stats)
from ..learn.folds import kfold_column, stratified_kfold_column
from ..learn.metrics import fold_mean, roc_auc, top_importance_rows
from ..operators import (CategoryDictionary, View, agg_features, all_columns_spec,
                         category_rates, distinct_rows, fill_with_mean, head, left_join,
                         left_star, mean_by, missing_profile, one_hot, semi_join, top_k,
                         union_by_name)
from ..operators.encode import category_shares_long, factorize
from ..sources.io import cast_columns
from .credit import bureau_rates, median_lookup
from .tables import load, rnd, round_doubles

STATUS_VALUES = ["F", "O", "P"]
PRIORITY_VALUES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
RETURN_FLAGS = ["A", "N", "R"]
SPLIT_DATE = "1999-01-01 00:00:00"
N_FOLDS = 5
FOLD_SEED = 47


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


# ---------------------------------------------------------------------------
# shared derived frames (Spark) and CTEs (SQL)

def orders_nulled(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders")
    return o.select(
        "o_orderkey", "o_custkey",
        sentinel_to_null("o_orderstatus", "P").alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderpriority", "o_orderdate")


ORDERS_NULLED_SQL = """o AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS o_totalprice,
  o_orderpriority, o_orderdate FROM orders)"""


# ---------------------------------------------------------------------------
# S1 S5 P1

def scan_cast(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                           "l_linenumber", "l_quantity", "l_discount",
                                           "l_returnflag")
    return cast_columns(li, {"l_linenumber": "int16", "l_quantity": "int32",
                             "l_discount": "float16"})


SQL_SCAN_CAST = """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
  CAST(l_quantity AS INTEGER) AS l_quantity, CAST(l_discount AS FLOAT) AS l_discount, l_returnflag
FROM lineitem"""


# P5 M6
def null_safe_filter(spark, d):
    o = load(spark, d, "orders")
    st = sentinel_to_null("o_orderstatus", "P")
    # 'P' -> NULL never yields 'O', so the null-safe test runs on the stored
    # column and reaches the Parquet scan as a pushed filter
    return o.where(null_safe_ne("o_orderstatus", "O")).select(
        "o_orderkey", "o_custkey", st.alias("o_orderstatus"))


SQL_NULL_SAFE_FILTER = """SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus
FROM orders WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM 'O'"""


# P13 M1
def sentinel_ratio(spark, d):
    li = load(spark, d, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     sentinel_to_null("l_quantity", 50.0).alias("l_quantity"),
                     safe_ratio("l_tax", "l_discount").alias("tax_per_discount"))


SQL_SENTINEL_RATIO = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  nullif(l_quantity, 50.0) AS l_quantity, l_tax / nullif(l_discount, 0) AS tax_per_discount
FROM lineitem"""


# M2 M3 M4
def shifted_ratio_clamp(spark, d):
    li = load(spark, d, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     shifted_ratio("l_extendedprice", "l_quantity").alias("price_per_qty1"),
                     difference("l_tax", "l_discount").alias("tax_minus_discount"),
                     clamp_zero(difference("l_tax", "l_discount")).alias("dpd"),
                     clamp_zero(difference("l_discount", "l_tax")).alias("dbd"))


SQL_SHIFTED_RATIO_CLAMP = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  l_extendedprice / (1 + l_quantity) AS price_per_qty1,
  l_tax - l_discount AS tax_minus_discount,
  greatest(coalesce(l_tax - l_discount, 0), 0) AS dpd,
  greatest(coalesce(l_discount - l_tax, 0), 0) AS dbd
FROM lineitem"""


# A18 O1
def missing_profile_q(spark, d):
    o = orders_nulled(spark, d).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        sentinel_to_null("o_orderpriority", "1-URGENT").alias("o_orderpriority"))
    return missing_profile(o)


def _sql_missing_profile() -> str:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    parts = [f"""SELECT '{c}' AS "column", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS "Total",
  CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS "Percent" FROM p"""
             for c in cols]
    return ("WITH " + ORDERS_NULLED_SQL + """, p AS (SELECT o_orderkey, o_custkey, o_orderstatus,
  o_totalprice, nullif(o_orderpriority, '1-URGENT') AS o_orderpriority FROM o)
""" + "\nUNION ALL\n".join(parts))


# E1 E3
def one_hot_q(spark, d):
    c = load(spark, d, "customer").select(
        "c_custkey", sentinel_to_null("c_mktsegment", "HOUSEHOLD").alias("c_mktsegment"))
    out, _ = one_hot(c, CategoryDictionary.discover(c, ["c_mktsegment"]), ["c_mktsegment"])
    return out


def _sql_one_hot() -> str:
    segs = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]
    ind = ",\n  ".join(f"CAST(CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS INTEGER) AS c_mktsegment_{s}"
                       for s in segs)
    return f"""SELECT c_custkey, {ind},
  CAST(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS INTEGER) AS c_mktsegment_nan
FROM customer"""


# E2
def factorize_q(spark, d):
    c = load(spark, d, "customer").select(
        "c_custkey", sentinel_to_null("c_mktsegment", "FURNITURE").alias("c_mktsegment"))
    out, _ = factorize(c, ["c_mktsegment"], order_col="c_custkey")
    return out.withColumnRenamed("c_mktsegment", "c_mktsegment_code")


SQL_FACTORIZE = """WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'FURNITURE') AS seg FROM customer),
d AS (SELECT seg, CAST(row_number() OVER (ORDER BY min(c_custkey)) - 1 AS INTEGER) AS code
      FROM c WHERE seg IS NOT NULL GROUP BY seg)
SELECT c.c_custkey, CAST(coalesce(d.code, -1) AS INTEGER) AS c_mktsegment_code
FROM c LEFT JOIN d ON c.seg = d.seg"""


# A1-A7
GROUP_SPEC = {"o_totalprice": ["min", "max", "mean", "sum", "var", "std", "size"]}


def group_spec_agg(spark, d):
    out = agg_features(orders_nulled(spark, d), "o_custkey", GROUP_SPEC, prefix="ORD_")
    rounded = round_doubles(out, 6, exclude=("ORD_o_totalprice_STD", "ORD_o_totalprice_VAR"))
    return rounded.withColumns({
        "ORD_o_totalprice_STD": rnd("ORD_o_totalprice_STD", 4),
        "ORD_o_totalprice_VAR": rnd("ORD_o_totalprice_VAR", -2)})


SQL_GROUP_SPEC_AGG = "WITH " + ORDERS_NULLED_SQL + """
SELECT o_custkey,
  round(min(o_totalprice), 6) AS ORD_o_totalprice_MIN,
  round(max(o_totalprice), 6) AS ORD_o_totalprice_MAX,
  round(avg(o_totalprice), 6) AS ORD_o_totalprice_MEAN,
  round(coalesce(sum(o_totalprice), 0), 6) AS ORD_o_totalprice_SUM,
  round(var_samp(o_totalprice), -2) AS ORD_o_totalprice_VAR,
  round(stddev_samp(o_totalprice), 4) AS ORD_o_totalprice_STD,
  count(*) AS ORD_o_totalprice_SIZE
FROM o GROUP BY o_custkey"""


# A9
def distinct_count(spark, d):
    li = load(spark, d, "lineitem")
    return agg_features(li, "l_orderkey", {"l_partkey": ["nunique", "size"]}, prefix="LINE_")


SQL_DISTINCT_COUNT = """SELECT l_orderkey, count(DISTINCT l_partkey) AS LINE_l_partkey_NUNIQUE,
  count(*) AS LINE_l_partkey_SIZE FROM lineitem GROUP BY l_orderkey"""


# A11
def category_share(spark, d):
    o = orders_nulled(spark, d)
    cats = CategoryDictionary.discover(o, ["o_orderstatus", "o_orderpriority"])
    return agg_features(o, "o_custkey", categories=cats, prefix="SHARE_")


def _share_sql(col: str, values, prefix: str, src_cond: str | None = None) -> list[str]:
    out = []
    for v in list(values) + [None]:
        test = f"{col} IS NULL" if v is None else f"{col} = '{v}'"
        label = f"{prefix}{col}_{'nan' if v is None else v}_MEAN"
        if src_cond:
            expr = f"avg(CASE WHEN {src_cond} THEN (CASE WHEN {test} THEN 1.0 ELSE 0.0 END) END)"
        else:
            expr = f"avg(CASE WHEN {test} THEN 1.0 ELSE 0.0 END)"
        out.append(f"{expr} AS {_q(label)}")
    return out


def _sql_category_share() -> str:
    cols = _share_sql("o_orderstatus", ["F", "O"], "SHARE_") + \
        _share_sql("o_orderpriority", PRIORITY_VALUES, "SHARE_")
    return "WITH " + ORDERS_NULLED_SQL + "\nSELECT o_custkey,\n  " + ",\n  ".join(cols) + \
        "\nFROM o GROUP BY o_custkey"


# A14 J2 P14
def category_rate(spark, d):
    ev = load(spark, d, "events")
    cust = load(spark, d, "customer")
    return category_rates(ev, "user_id", "event_type", None, "event_rate_",
                          "total_event_count", base=cust, base_key="c_custkey")


def _sql_category_rate() -> str:
    cnt = ",\n    ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in EVENT_TYPES)
    rates = ",\n  ".join(f"coalesce(CAST(e.n_{t} AS DOUBLE) / CAST(e.n AS DOUBLE), 0.0) AS event_rate_{t}"
                         for t in EVENT_TYPES)
    return f"""WITH e AS (SELECT user_id, count(*) AS n,
    {cnt}
  FROM events GROUP BY user_id)
SELECT c.c_custkey, CAST(coalesce(e.n, 1) AS BIGINT) AS total_event_count,
  {rates}
FROM customer c LEFT JOIN e ON c.c_custkey = e.user_id"""


# A10 J1 N1 N2 -- fused (one aggregate) and joined (the original's shape)
VIEW_SPEC = {"o_totalprice": ["mean", "sum", "max"], "o_orderkey": ["size"]}


def _order_views():
    return [View("OPEN_", F.col("o_orderstatus").eqNullSafe("O"), VIEW_SPEC),
            View("DONE_", F.col("o_orderstatus").eqNullSafe("F"), VIEW_SPEC)]


def order_view_block(o: DataFrame, cats: CategoryDictionary | None = None) -> DataFrame:
    cats = cats or CategoryDictionary.discover(o, ["o_orderpriority"])
    return agg_features(o, "o_custkey", VIEW_SPEC, prefix="ORD_", categories=cats,
                        views=_order_views())


def subset_views(spark, d):
    o = orders_nulled(spark, d)
    block = order_view_block(o).withColumnRenamed("o_custkey", "c_custkey")
    cust = load(spark, d, "customer").select("c_custkey")
    return round_doubles(left_join(cust, block, "c_custkey"), 6)


def subset_views_joined(spark, d):
    """Same result as :func:`subset_views`, built the way the original does
    it: one filter + group-by per view, then left joins (bench baseline)."""
    o = orders_nulled(spark, d)
    cats = CategoryDictionary.discover(o, ["o_orderpriority"])
    base = agg_features(o, "o_custkey", VIEW_SPEC, prefix="ORD_", categories=cats)
    blocks = [agg_features(o.where(v.condition), "o_custkey", v.spec, prefix=v.prefix)
              for v in _order_views()]
    feats = left_star(base, "o_custkey", blocks).withColumnRenamed("o_custkey", "c_custkey")
    cust = load(spark, d, "customer").select("c_custkey")
    return round_doubles(left_join(cust, feats, "c_custkey"), 6)


def _view_sql(prefix: str, where: str | None) -> str:
    w = f" WHERE {where}" if where else ""
    return f"""SELECT o_custkey, avg(o_totalprice) AS {prefix}o_totalprice_MEAN,
    coalesce(sum(o_totalprice), 0) AS {prefix}o_totalprice_SUM, max(o_totalprice) AS {prefix}o_totalprice_MAX,
    count(*) AS {prefix}o_orderkey_SIZE{{extra}} FROM o{w} GROUP BY o_custkey"""


def _sql_subset_views_ctes() -> str:
    shares = ",\n    ".join(_share_sql("o_orderpriority", PRIORITY_VALUES, "ORD_"))
    a = _view_sql("ORD_", None).replace("{extra}", ",\n    " + shares)
    v1 = _view_sql("OPEN_", "o_orderstatus = 'O'").replace("{extra}", "")
    v2 = _view_sql("DONE_", "o_orderstatus = 'F'").replace("{extra}", "")
    return f"{ORDERS_NULLED_SQL},\nva AS ({a}),\nv1 AS ({v1}),\nv2 AS ({v2})"


SUBSET_VIEW_COLS = (
    ["ORD_o_totalprice_MEAN", "ORD_o_totalprice_SUM", "ORD_o_totalprice_MAX", "ORD_o_orderkey_SIZE"]
    + [f"ORD_o_orderpriority_{v}_MEAN" for v in PRIORITY_VALUES + ["nan"]]
    + [f"{p}{c}" for p in ("OPEN_", "DONE_") for c in
       ("o_totalprice_MEAN", "o_totalprice_SUM", "o_totalprice_MAX", "o_orderkey_SIZE")])


def _rounded_select(cols, digits=6, ints=("SIZE",)) -> str:
    out = []
    for c in cols:
        if any(c.endswith(s) for s in ints):
            out.append(_q(c))
        else:
            out.append(f"round({_q(c)}, {digits}) AS {_q(c)}")
    return ", ".join(out)


def _sql_subset_views() -> str:
    return ("WITH " + _sql_subset_views_ctes() + "\nSELECT c.c_custkey, " + _rounded_select(SUBSET_VIEW_COLS)
            + """
FROM customer c LEFT JOIN va ON c.c_custkey = va.o_custkey
  LEFT JOIN v1 ON c.c_custkey = v1.o_custkey LEFT JOIN v2 ON c.c_custkey = v2.o_custkey""")


# A12
LINE_SPEC = {"l_quantity": ["min", "max", "size"]}
ORDER_LEVEL_SPEC = {"l_quantity_MIN": ["min"], "l_quantity_MAX": ["max"],
                    "l_quantity_SIZE": ["mean", "sum"]}


def lineitem_two_level_block(li: DataFrame, orders: DataFrame) -> DataFrame:
    cats = CategoryDictionary.discover(li, ["l_returnflag"])
    child = agg_features(li, "l_orderkey", LINE_SPEC, categories=cats)
    spec = dict(ORDER_LEVEL_SPEC)
    spec.update({f"l_returnflag_{v}_MEAN": ["mean"] for v in cats["l_returnflag"] + ["nan"]})
    joined = orders.select("o_orderkey", "o_custkey").join(
        child.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    return agg_features(joined.drop("o_orderkey"), "o_custkey", spec, prefix="CUST_")


def two_level_agg(spark, d):
    out = lineitem_two_level_block(load(spark, d, "lineitem"), load(spark, d, "orders"))
    return round_doubles(out, 6)


TWO_LEVEL_COLS = (["CUST_l_quantity_MIN_MIN", "CUST_l_quantity_MAX_MAX", "CUST_l_quantity_SIZE_MEAN",
                   "CUST_l_quantity_SIZE_SUM"]
                  + [f"CUST_l_returnflag_{v}_MEAN_MEAN" for v in RETURN_FLAGS + ["nan"]])


def _sql_two_level_ctes() -> str:
    shares = ",\n    ".join(_share_sql("l_returnflag", RETURN_FLAGS, "")).replace("_MEAN\"", "_MEAN\"")
    lvl = ",\n  ".join(
        [f"avg({_q(f'l_returnflag_{v}_MEAN')}) AS {_q(f'CUST_l_returnflag_{v}_MEAN_MEAN')}"
         for v in RETURN_FLAGS + ["nan"]])
    return f"""lc AS (SELECT l_orderkey, min(l_quantity) AS l_quantity_MIN, max(l_quantity) AS l_quantity_MAX,
    count(*) AS l_quantity_SIZE,
    {shares}
  FROM lineitem GROUP BY l_orderkey),
lj AS (SELECT o.o_custkey, lc.* FROM orders o LEFT JOIN lc ON o.o_orderkey = lc.l_orderkey),
tl AS (SELECT o_custkey, min(l_quantity_MIN) AS CUST_l_quantity_MIN_MIN,
  max(l_quantity_MAX) AS CUST_l_quantity_MAX_MAX, avg(l_quantity_SIZE) AS CUST_l_quantity_SIZE_MEAN,
  CAST(coalesce(sum(l_quantity_SIZE), 0) AS BIGINT) AS CUST_l_quantity_SIZE_SUM,
  {lvl}
  FROM lj GROUP BY o_custkey)"""


def _sql_two_level_agg() -> str:
    return ("WITH " + _sql_two_level_ctes() + "\nSELECT o_custkey, "
            + _rounded_select(TWO_LEVEL_COLS, 6, ints=("_SUM",)) + " FROM tl")


# A13
def agg_all_columns(spark, d):
    ev = load(spark, d, "events").select("user_id", "event_type", "value")
    enc, _ = one_hot(ev, CategoryDictionary.discover(ev, ["event_type"]), ["event_type"])
    spec = all_columns_spec(enc, ["max", "mean", "sum", "var"], exclude=["user_id"])
    out = agg_features(enc, "user_id", spec, prefix="EV_", count_name="EV_COUNT")
    return round_doubles(out, 6)


def _sql_agg_all_columns() -> str:
    cols = [("value", "value")] + [
        (f"event_type_{t}", f"CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END") for t in EVENT_TYPES] + [
        ("event_type_nan", "CASE WHEN event_type IS NULL THEN 1 ELSE 0 END")]
    parts = []
    for name, expr in cols:
        is_ind = name != "value"
        mx = f"max({expr})" if not is_ind else f"CAST(max({expr}) AS INTEGER)"
        sm = f"round(coalesce(sum({expr}), 0), 6)" if not is_ind else f"CAST(coalesce(sum({expr}), 0) AS BIGINT)"
        parts += [f"{mx} AS EV_{name}_MAX", f"round(avg({expr}), 6) AS EV_{name}_MEAN",
                  f"{sm} AS EV_{name}_SUM", f"round(var_samp({expr}), 6) AS EV_{name}_VAR"]
    return ("SELECT user_id, " + ",\n  ".join(parts)
            + ",\n  count(*) AS EV_COUNT FROM events GROUP BY user_id")


# A8 E4 J8
def group_median_lookup(spark, d):
    c = load(spark, d, "customer")
    out = median_lookup(c, "c_mktsegment", "c_acctbal", "SEG_MEDIAN_ACCTBAL")
    return round_doubles(out.select("c_custkey", "c_mktsegment", "SEG_MEDIAN_ACCTBAL"), 6)


SQL_GROUP_MEDIAN_LOOKUP = """WITH m AS (SELECT c_mktsegment, median(c_acctbal) AS med FROM customer GROUP BY c_mktsegment)
SELECT c.c_custkey, c.c_mktsegment, round(m.med, 6) AS SEG_MEDIAN_ACCTBAL
FROM customer c LEFT JOIN m ON c.c_mktsegment = m.c_mktsegment"""


# A8 on three groups holding about a third of lineitem each
def median_hot_groups(spark, d):
    from ..operators import exact_median
    li = load(spark, d, "lineitem")
    med = exact_median(li, ["l_returnflag"], "l_extendedprice", out_col="median_price")
    return round_doubles(med, 6)


SQL_MEDIAN_HOT_GROUPS = """SELECT l_returnflag, round(median(l_extendedprice), 6) AS median_price
FROM lineitem GROUP BY l_returnflag"""


# P15 A16
def fill_global_mean(spark, d):
    o = orders_nulled(spark, d).select("o_orderkey", "o_totalprice")
    return round_doubles(fill_with_mean(o, ["o_totalprice"]), 6)


SQL_FILL_GLOBAL_MEAN = "WITH " + ORDERS_NULLED_SQL + """
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM o)), 6) AS o_totalprice FROM o"""


# R2-R5 P8
def _lineitem_with_gaps(spark, d):
    li = load(spark, d, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     sentinel_to_null("l_quantity", 50.0).alias("l_quantity"),
                     "l_extendedprice",
                     sentinel_to_null("l_discount", 0.0).alias("l_discount"),
                     sentinel_to_null("l_tax", 0.0).alias("l_tax"))


GAPS_SQL = """g AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, nullif(l_quantity, 50.0) AS l_quantity,
  l_extendedprice, nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax FROM lineitem)"""


def row_sum_mean_std_prod(spark, d):
    g = _lineitem_with_gaps(spark, d)
    cols = columns_matching(g, contains=["l_"], excludes=["key", "number"], numeric_only=True)
    out = with_row_stats(g, cols, {"sum": "ROW_SUM", "mean": "ROW_MEAN", "std": "ROW_STD",
                                   "prod": "ROW_PROD"})
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "ROW_SUM",
                      "ROW_MEAN", rnd("ROW_STD", 6).alias("ROW_STD"), "ROW_PROD")


def _sql_row_stats() -> str:
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    s = " + ".join(f"coalesce({c}, 0.0)" for c in cols)
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    return "WITH " + GAPS_SQL + f""",
r AS (SELECT *, {s} AS s, {n} AS n FROM g)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, s AS ROW_SUM,
  CASE WHEN n > 0 THEN s / n END AS ROW_MEAN,
  round(CASE WHEN n > 1 THEN sqrt(({' + '.join(f'coalesce(({c} - s / n) * ({c} - s / n), 0.0)' for c in cols)}) / (n - 1)) END, 6) AS ROW_STD,
  {' * '.join(cols)} AS ROW_PROD
FROM r"""


# R1
def row_kurtosis_q(spark, d):
    li = load(spark, d, "lineitem")
    k = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                  sentinel_to_null("l_quantity", 50.0).alias("k_quantity"),
                  F.col("l_linenumber").cast("double").alias("k_linenumber"),
                  (F.col("l_discount") * 100).alias("k_discount"),
                  (F.col("l_tax") * 100).alias("k_tax"))
    cols = columns_matching(k, contains=["k_"], numeric_only=True)
    return with_row_stats(k, cols, {"kurt": "ROW_KURT"}).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", rnd("ROW_KURT", 6).alias("ROW_KURT"))


SQL_ROW_KURTOSIS = """WITH k AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  list_filter([nullif(l_quantity, 50.0), CAST(l_linenumber AS DOUBLE), l_discount * 100, l_tax * 100],
              lambda x: x IS NOT NULL) AS v FROM lineitem),
m AS (SELECT *, CAST(len(v) AS DOUBLE) AS n, list_sum(v) / len(v) AS mu FROM k),
c AS (SELECT *, list_sum(list_transform(v, lambda x: (x - mu) * (x - mu))) AS m2,
  list_sum(list_transform(v, lambda x: ((x - mu) * (x - mu)) * ((x - mu) * (x - mu)))) AS m4 FROM m),
r AS (SELECT *, (n - 2) * (n - 3) * m2 * m2 AS den FROM c)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  round(CASE WHEN n < 4 THEN NULL WHEN abs(den) < 1e-14 THEN 0.0
        ELSE n * (n + 1) * (n - 1) * m4 / den - 3.0 * (n - 1) * (n - 1) / ((n - 2) * (n - 3)) END, 6) AS ROW_KURT
FROM r"""


# U1 P6 P16
def union_by_name_split(spark, d):
    o = load(spark, d, "orders")
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")   # no time-zone conversion involved
    train = o.where(F.col("o_orderdate") < cut).select(
        "o_orderkey", "o_custkey", "o_totalprice",
        (F.col("o_orderstatus") == "F").cast("int").alias("TARGET"))
    test = o.where(F.col("o_orderdate") >= cut).select("o_orderkey", "o_custkey", "o_totalprice")
    u = union_by_name(train, test)
    return u.withColumn("split", F.when(F.col("TARGET").isNotNull(), F.lit("train"))
                        .otherwise(F.lit("test")))


SQL_UNION_BY_NAME_SPLIT = """WITH u AS (
  SELECT o_orderkey, o_custkey, o_totalprice, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS TARGET
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
  UNION ALL BY NAME
  SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
SELECT o_orderkey, o_custkey, o_totalprice, TARGET,
  CASE WHEN TARGET IS NOT NULL THEN 'train' ELSE 'test' END AS split FROM u"""


# A15
def distinct_pairs(spark, d):
    return distinct_rows(load(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


SQL_DISTINCT_PAIRS = "SELECT DISTINCT o_custkey, o_orderstatus FROM orders"


# A17 O2 J7
TOP_K = 40


def semi_top_k(spark, d):
    li = load(spark, d, "lineitem")
    means = mean_by(li, "l_partkey", "l_quantity", "mean_quantity")
    top = top_k(means, TOP_K, "mean_quantity", tie_cols=["l_partkey"]).select("l_partkey")
    return semi_join(li, top, "l_partkey", max_broadcast_rows=TOP_K).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


SQL_SEMI_TOP_K = f"""WITH m AS (SELECT l_partkey, avg(l_quantity) AS mq FROM lineitem GROUP BY l_partkey),
t AS (SELECT l_partkey FROM m ORDER BY mq DESC, l_partkey LIMIT {TOP_K})
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
WHERE l_partkey IN (SELECT l_partkey FROM t)"""


# J3 J6
EVENT_SPEC = {"value": ["mean", "max", "sum"]}


def event_block(ev: DataFrame) -> DataFrame:
    cats = CategoryDictionary.discover(ev, ["event_type"])
    return agg_features(ev, "user_id", EVENT_SPEC, prefix="EV_", categories=cats,
                        count_name="EV_COUNT")


def star_assembly(spark, d):
    cust = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    o = orders_nulled(spark, d)
    blocks = [
        order_view_block(o).withColumnRenamed("o_custkey", "c_custkey"),
        lineitem_two_level_block(load(spark, d, "lineitem"), load(spark, d, "orders"))
        .withColumnRenamed("o_custkey", "c_custkey"),
        event_block(load(spark, d, "events")).withColumnRenamed("user_id", "c_custkey"),
    ]
    return round_doubles(left_star(cust, "c_custkey", blocks), 6)


EVENT_COLS = (["EV_value_MEAN", "EV_value_MAX", "EV_value_SUM"]
              + [f"EV_event_type_{t}_MEAN" for t in EVENT_TYPES + ["nan"]] + ["EV_COUNT"])


def _sql_star_assembly() -> str:
    ev_shares = ",\n    ".join(_share_sql("event_type", EVENT_TYPES, "EV_"))
    ctes = (_sql_subset_views_ctes() + ",\n" + _sql_two_level_ctes() + f""",
ev AS (SELECT user_id, avg(value) AS EV_value_MEAN, max(value) AS EV_value_MAX,
    coalesce(sum(value), 0) AS EV_value_SUM,
    {ev_shares},
    count(*) AS EV_COUNT FROM events GROUP BY user_id)""")
    sel = ", ".join([_rounded_select(SUBSET_VIEW_COLS), _rounded_select(TWO_LEVEL_COLS, 6, ints=("_SUM",)),
                     _rounded_select(EVENT_COLS, 6, ints=("COUNT",))])
    return ("WITH " + ctes + "\nSELECT c.c_custkey, c.c_nationkey, round(c.c_acctbal, 6) AS c_acctbal, " + sel
            + """
FROM customer c LEFT JOIN va ON c.c_custkey = va.o_custkey
  LEFT JOIN v1 ON c.c_custkey = v1.o_custkey LEFT JOIN v2 ON c.c_custkey = v2.o_custkey
  LEFT JOIN tl ON c.c_custkey = tl.o_custkey LEFT JOIN ev ON c.c_custkey = ev.user_id""")


# F7 J4 J5
def bureau_rates_q(spark, d):
    out = bureau_rates(load(spark, d, "customer"), load(spark, d, "orders"),
                       applicant_key="c_custkey", loan_key="o_custkey",
                       status_col="o_orderstatus", type_col="o_orderpriority",
                       mean_std_cols=["o_totalprice"])
    return round_doubles(out, 6, exclude=("o_totalprice_y",)).withColumn(
        "o_totalprice_y", rnd("o_totalprice_y", 4))


def _sql_bureau_rates() -> str:
    cnt = ",\n    ".join(
        [f"count(*) FILTER (WHERE o_orderstatus = '{v}') AS s_{i}" for i, v in enumerate(STATUS_VALUES)]
        + [f"count(*) FILTER (WHERE o_orderpriority = '{v}') AS t_{i}" for i, v in enumerate(PRIORITY_VALUES)])
    rates = ",\n  ".join(
        [f"round(coalesce(CAST(a.s_{i} AS DOUBLE) / CAST(a.n AS DOUBLE), 0.0), 6) AS credit_rate_{v}"
         for i, v in enumerate(STATUS_VALUES)])
    trates = ",\n  ".join(
        [f"round(coalesce(CAST(a.t_{i} AS DOUBLE) / CAST(a.n AS DOUBLE), 0.0), 6) AS {_q('credit_type_rate_' + v)}"
         for i, v in enumerate(PRIORITY_VALUES)])
    return f"""WITH a AS (SELECT o_custkey, count(*) AS n,
    {cnt},
    avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s
  FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, CAST(coalesce(a.n, 1) AS BIGINT) AS total_credit_count,
  {rates},
  round(a.m, 6) AS o_totalprice_x, round(a.s, 4) AS o_totalprice_y,
  CAST(coalesce(a.n, 1) AS BIGINT) AS total_credit_type_count,
  {trates}
FROM customer c LEFT JOIN a ON c.c_custkey = a.o_custkey"""


# F7 with means and currency shares (the priority plays the currency)
def bureau_rates_full(spark, d):
    loans = load(spark, d, "orders").withColumn("o_year", F.year("o_orderdate").cast("double"))
    out = bureau_rates(load(spark, d, "customer"), loans, applicant_key="c_custkey", loan_key="o_custkey",
                       status_col="o_orderstatus", type_col="o_orderstatus", mean_cols=["o_year"],
                       mean_std_cols=["o_totalprice", "o_orderkey"], currency_col="o_orderpriority")
    return round_doubles(out.drop("o_totalprice_y", "o_orderkey_y"), 6)


def _sql_bureau_rates_full() -> str:
    rate = lambda col, v: f"count(*) FILTER (WHERE {col} = '{v}') / CAST(count(*) AS DOUBLE)"
    parts = [f"{rate('o_orderstatus', v)} AS {_q(p + v)}" for p in ("credit_rate_", "credit_type_rate_") for v in STATUS_VALUES]
    parts += [f"{rate('o_orderpriority', v)} AS {_q('o_orderpriority_' + v)}" for v in PRIORITY_VALUES]
    names = [_q(p + v) for p in ("credit_rate_", "credit_type_rate_") for v in STATUS_VALUES] \
        + [_q("o_orderpriority_" + v) for v in PRIORITY_VALUES]
    return ("WITH a AS (SELECT o_custkey, count(*) AS n, avg(year(o_orderdate)) AS y, avg(o_totalprice) AS p, avg(o_orderkey) AS k,\n  "
            + ",\n  ".join(parts) + " FROM orders GROUP BY o_custkey)\n"
            "SELECT c_custkey, CAST(coalesce(n, 1) AS BIGINT) AS total_credit_count, CAST(coalesce(n, 1) AS BIGINT) AS "
            "total_credit_type_count, round(y, 6) AS o_year, round(p, 6) AS o_totalprice_x, round(k, 6) AS o_orderkey_x,\n  "
            + ",\n  ".join(f"round(coalesce({x}, 0.0), 6) AS {x}" for x in names)
            + "\nFROM customer LEFT JOIN a ON c_custkey = o_custkey")


# One row for each (applicant, currency)
def bureau_rates_fanout(spark, d):
    out = bureau_rates(load(spark, d, "customer"), load(spark, d, "orders"), applicant_key="c_custkey", loan_key="o_custkey",
                       status_col="o_orderstatus", type_col="o_orderstatus", currency_col="o_orderpriority", fanout=True)
    return out.select("c_custkey", "total_credit_count", "o_orderpriority")


SQL_BUREAU_RATES_FANOUT = """WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
p AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)
SELECT c_custkey, CAST(coalesce(n, 1) AS BIGINT) AS total_credit_count, o_orderpriority
FROM customer LEFT JOIN a ON c_custkey = a.o_custkey LEFT JOIN p ON c_custkey = p.o_custkey"""


# A11 without a pivot
def category_share_long(spark, d):
    return round_doubles(category_shares_long(load(spark, d, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"]), 6)


SQL_CATEGORY_SHARE_LONG = """WITH t AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
p AS (SELECT o_custkey, 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
      UNION ALL SELECT o_custkey, 'o_orderpriority', o_orderpriority FROM orders)
SELECT o_custkey, "column", value, round(count(*) / CAST(max(t.n) AS DOUBLE), 6) AS share
FROM p JOIN t USING (o_custkey) GROUP BY o_custkey, "column", value"""


# A table written as CSV and read back, one column declared, the others found
def csv_roundtrip(spark, d):
    import uuid

    from ..session import checkpoint_path
    from ..sources.io import read_table, write_table
    path = checkpoint_path(spark, f"csv-{uuid.uuid4().hex}")
    cust = load(spark, d, "customer").withColumn("c_mktsegment", F.when(F.col("c_mktsegment") == "HOUSEHOLD", "NA")
                                                 .otherwise(F.col("c_mktsegment")))
    write_table(cust, path, fmt="csv")
    return read_table(spark, path, "c_nationkey int", fmt="csv")


SQL_CSV_ROUNDTRIP = """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS c_mktsegment FROM customer"""


# Cells with separators, quotes, line ends, backslashes and outer spaces
def awkward_customers(spark, d):
    tail = F.element_at(F.array(*map(F.lit, AWKWARD)), (F.col("c_custkey") % len(AWKWARD) + 1).cast("int"))
    return load(spark, d, "customer").select("c_custkey", F.concat("c_name", tail).alias("c_name"), "c_acctbal")


AWKWARD = [', "quoted"', "\nnext line", "\\", " ", '"', ",", "\r\n\\\"x"]


def csv_dialect_roundtrip(spark, d):
    import uuid

    from ..session import checkpoint_path
    from ..sources.io import read_table, write_table
    path = checkpoint_path(spark, f"csv-{uuid.uuid4().hex}")
    write_table(awkward_customers(spark, d), path, fmt="csv", max_rows_per_file=100_000)
    return read_table(spark, path, fmt="csv", schema="c_name string")


def _sql_csv_dialect_roundtrip() -> str:
    code = " || ".join
    tails = ", ".join(code(f"chr({ord(ch)})" for ch in t) for t in AWKWARD)
    return f"SELECT c_custkey, c_name || list_extract([{tails}], c_custkey % {len(AWKWARD)} + 1) AS c_name, c_acctbal FROM customer"


# Rows with too many cells are set aside, rows with too few are filled
def csv_quarantine(spark, d):
    import uuid

    from ..session import checkpoint_path
    from ..sources.io import read_table
    path, aside = (checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}") for name in ("csv", "aside"))
    key = F.col("c_custkey")
    line = F.concat_ws(",", key, F.concat(F.lit('"'), "c_name", F.lit(', x"')), F.when(key % 5 != 0, F.col("c_nationkey")),
                       F.when(key % 7 == 0, F.lit("surplus,cells")))
    first = F.monotonically_increasing_id() % (1 << 33) == 0  # every file starts with the header
    load(spark, d, "customer").select(F.when(first, F.concat(F.lit("c_custkey,c_name,c_nationkey\n"), line)).otherwise(line)) \
        .write.text(path)
    good = read_table(spark, path, "c_custkey bigint, c_name string, c_nationkey int", fmt="csv", bad_rows="aside", bad_rows_path=aside)
    bad = spark.read.parquet(aside).select(F.col("cells")[0].cast("bigint").alias("c_custkey"), F.col("cells")[1].alias("c_name"),
                                           F.lit(None).cast("int").alias("c_nationkey"), F.lit(True).alias("aside"))
    return good.withColumn("aside", F.lit(False)).unionByName(bad)


SQL_CSV_QUARANTINE = """SELECT c_custkey, c_name || ', x' AS c_name,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN CAST(c_nationkey AS INTEGER) END AS c_nationkey,
  c_custkey % 7 = 0 AS aside FROM customer"""


# Row numbers and first-appearance codes in the order of files that are not sorted by key
def file_order_codes(spark, d):
    import uuid

    from ..session import checkpoint_path
    from ..sources.io import read_table, write_table
    base = checkpoint_path(spark, f"ordered-{uuid.uuid4().hex}")
    cust = load(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment").orderBy("c_acctbal", "c_custkey")
    write_table(cust, f"{base}/parquet", max_rows_per_file=2_000)
    write_table(cust, f"{base}/csv", fmt="csv")
    rows = read_table(spark, f"{base}/parquet", ordinal="ordinal")
    coded, _ = factorize(rows, ["c_mktsegment"], order_col="ordinal")
    from_csv = read_table(spark, f"{base}/csv", "c_custkey bigint", fmt="csv", ordinal="csv_ordinal").select("c_custkey", "csv_ordinal")
    return coded.withColumnRenamed("c_mktsegment", "code").join(from_csv, "c_custkey").select("c_custkey", "ordinal", "csv_ordinal", "code")


SQL_FILE_ORDER_CODES = """WITH c AS (
  SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS ordinal FROM customer),
d AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY min(ordinal)) - 1 AS INTEGER) AS code FROM c GROUP BY c_mktsegment)
SELECT c_custkey, ordinal, ordinal AS csv_ordinal, code FROM c JOIN d USING (c_mktsegment)"""


# Half of the keys missing, one key with a third of the others
def skew_join(spark, d):
    from ..operators.skew import heavy_keys, skew_left_join
    n = F.col("event_id")
    ev = load(spark, d, "events").select("event_id", F.when(n % 2 == 0, F.when(n % 3 == 0, F.lit(1)).otherwise(F.col("user_id")))
                                         .cast("bigint").alias("c_custkey"))
    totals = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"))
    return skew_left_join(ev, totals, "c_custkey", heavy_keys(ev, "c_custkey", 0.05))


SQL_SKEW_JOIN = """WITH e AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END END AS c_custkey FROM events),
o AS (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey)
SELECT event_id, CAST(c_custkey AS BIGINT) AS c_custkey, orders FROM e LEFT JOIN o ON c_custkey = o_custkey"""


# Categories as rows of an index, sparse counts a key
def sparse_category_counts(spark, d):
    from ..operators.sparse import category_index, sparse_counts
    orders = load(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority", "o_orderstatus")
    columns = ["day", "o_orderpriority", "o_orderstatus"]
    got = sparse_counts(orders, "o_custkey", columns, category_index(orders, columns))
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return got.select("o_custkey", F.col("rows").alias("n_rows"), text("positions"), text("counts"))


SQL_SPARSE_CATEGORY_COUNTS = """WITH p AS (
  SELECT o_custkey, unnest(['day', 'o_orderpriority', 'o_orderstatus']) AS name,
         unnest([CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CAST(o_orderpriority AS VARCHAR), CAST(o_orderstatus AS VARCHAR)]) AS value FROM orders),
i AS (
  SELECT name, value, row_number() OVER (ORDER BY name, value NULLS FIRST) - 1 AS position FROM (
    SELECT DISTINCT name, value FROM p UNION SELECT DISTINCT name, NULL FROM p)),
c AS (
  SELECT o_custkey, p.name, position, count(*) AS n FROM p JOIN i ON p.name = i.name AND p.value IS NOT DISTINCT FROM i.value
  WHERE o_custkey IS NOT NULL GROUP BY o_custkey, p.name, position)
SELECT o_custkey, CAST(sum(n) FILTER (WHERE name = 'day') AS BIGINT) AS n_rows,
       string_agg(CAST(position AS VARCHAR), ',' ORDER BY position) AS positions, string_agg(CAST(n AS VARCHAR), ',' ORDER BY position) AS counts
FROM c GROUP BY o_custkey"""


# Blocks stored bucketed by the key, joined without an exchange
def bucketed_star(spark, d, buckets: int = 16):
    import uuid

    from ..session import checkpoint_path
    from ..sources.bucketed import write_bucketed
    run = uuid.uuid4().hex
    base = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    orders = order_view_block(orders_nulled(spark, d)).withColumnRenamed("o_custkey", "c_custkey")
    lines = lineitem_two_level_block(load(spark, d, "lineitem"), load(spark, d, "orders")).withColumnRenamed("o_custkey", "c_custkey")
    events = event_block(load(spark, d, "events")).withColumnRenamed("user_id", "c_custkey")
    stored = [write_bucketed(df, f"star_{name}_{run}", "c_custkey", buckets, checkpoint_path(spark, f"star-{name}-{run}"))
              for name, df in (("base", base), ("orders", orders), ("lines", lines), ("events", events))]
    return round_doubles(left_star(stored[0], "c_custkey", stored[1:]), 6)


# A8 A9, opt-in: stored sketches, merged, held against the exact values
def sketch_profile(spark, d):
    import uuid

    from ..operators.sketches import RANK_ERROR, distinct_count, merge_sketches, quantile, sketch_groups
    from ..session import checkpoint_path
    lines = load(spark, d, "lineitem")
    path = checkpoint_path(spark, f"sketches-{uuid.uuid4().hex}")
    sketch_groups(lines, ["l_returnflag", "l_linestatus"], ["l_extendedprice"], ["l_partkey"]).write.parquet(path)
    merged = merge_sketches(spark.read.parquet(path), ["l_returnflag"]).select(
        "l_returnflag", "rows", quantile("l_extendedprice", 0.5).alias("median"), distinct_count("l_partkey").alias("parts"))
    below = F.count_if(F.col("l_extendedprice") < F.col("median")) / F.count(F.lit(1))
    upto = F.count_if(F.col("l_extendedprice") <= F.col("median")) / F.count(F.lit(1))
    off = 2 * RANK_ERROR[200]
    exact = lines.select("l_returnflag", "l_partkey", "l_extendedprice").join(F.broadcast(merged), "l_returnflag")  # a row a flag
    return exact.groupBy("l_returnflag", "rows", "parts").agg(
        ((below <= 0.5 + off) & (upto >= 0.5 - off)).alias("median_within"), F.count_distinct("l_partkey").alias("exact")) \
        .select("l_returnflag", "rows", "median_within", (F.abs(F.col("parts") - F.col("exact")) <= 0.05 * F.col("exact")).alias("parts_within"))


SQL_SKETCH_PROFILE = """SELECT l_returnflag, count(*) AS "rows", true AS median_within, true AS parts_within
FROM lineitem GROUP BY l_returnflag"""


# S2 S4 O3
HEAD_N = 100


def head_limit(spark, d):
    return head(load(spark, d, "orders"), HEAD_N, ["o_orderkey"])


SQL_HEAD_LIMIT = f"SELECT * FROM orders ORDER BY o_orderkey LIMIT {HEAD_N}"


# L1
def kfold_assign(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    o = o.withColumn("fold", kfold_column("o_orderkey", N_FOLDS, FOLD_SEED))
    o = stratified_kfold_column(o, "o_orderkey", (F.col("o_orderstatus") == "F"), N_FOLDS,
                                FOLD_SEED, out_col="sfold")
    return o.select("o_orderkey", "fold", "sfold")


SQL_KFOLD_ASSIGN = f"""SELECT o_orderkey,
  CAST(CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '#{FOLD_SEED}'), 1, 8)) AS BIGINT) % {N_FOLDS} AS INTEGER) AS fold,
  CAST((row_number() OVER (PARTITION BY o_orderstatus = 'F'
        ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '#{FOLD_SEED}'), o_orderkey) - 1) % {N_FOLDS} AS INTEGER) AS sfold
FROM orders"""


# L5
def roc_auc_q(spark, d):
    o = load(spark, d, "orders").select(
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.col("o_totalprice").alias("score"))
    return round_doubles(roc_auc(o, "score", "label"), 9)


# L5 per fold
def roc_auc_by_fold(spark, d):
    o = load(spark, d, "orders").select(
        (F.col("o_orderkey") % 5).alias("fold"), (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.col("o_totalprice").alias("score"))
    return round_doubles(roc_auc(o, "score", "label", group_cols=["fold"]), 9)


SQL_ROC_AUC = """WITH s AS (SELECT o_totalprice AS score,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) AS DOUBLE) AS neg
  FROM orders GROUP BY 1),
c AS (SELECT score, pos, neg,
    coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS neg_below
  FROM s)
SELECT round(sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * sum(neg)), 9) AS auc,
  CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c"""

SQL_ROC_AUC_BY_FOLD = """WITH s AS (SELECT o_orderkey % 5 AS fold, o_totalprice AS score,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) AS DOUBLE) AS neg
  FROM orders GROUP BY 1, 2),
c AS (SELECT fold, pos, neg, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS neg_below FROM s)
SELECT fold, round(sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * sum(neg)), 9) AS auc,
  CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c GROUP BY fold"""


# L6 U2
def fold_mean_score(spark, d):
    """Test score = mean of the k fold models' scores (L6) by the learner's own
    helper, over five given score columns."""
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    scores = [F.col("o_totalprice") / (F.col("o_totalprice") + F.lit(10000.0 * (f + 1))) for f in range(N_FOLDS)]
    return o.select("o_orderkey", rnd(fold_mean(scores), 6).alias("TARGET"))


# Importance rows of the ten best features, over a given importance table
def top_importances(spark, d):
    part = load(spark, d, "part").select(F.col("p_brand").alias("feature"), F.col("p_retailprice").alias("importance"),
                                         (F.col("p_partkey") % N_FOLDS).cast("int").alias("fold"))
    per_fold = part.groupBy("feature", "fold").agg(rnd(F.avg("importance"), 6).alias("importance"))
    return top_importance_rows(per_fold, 10).select("feature", "importance", "fold")


SQL_TOP_IMPORTANCES = f"""WITH i AS (SELECT p_brand AS feature, CAST(p_partkey % {N_FOLDS} AS INTEGER) AS fold,
    round(avg(p_retailprice), 6) AS importance FROM part GROUP BY 1, 2),
t AS (SELECT feature FROM i GROUP BY feature ORDER BY avg(importance) DESC, feature LIMIT 10)
SELECT feature, importance, fold FROM i WHERE feature IN (SELECT feature FROM t)"""


def _sql_fold_mean_score() -> str:
    parts = [f"SELECT o_orderkey, o_totalprice / (o_totalprice + {10000.0 * (f + 1)}) AS score FROM orders"
             for f in range(N_FOLDS)]
    return ("WITH u AS (" + "\n  UNION ALL ".join(parts)
            + ")\nSELECT o_orderkey, round(avg(score), 6) AS TARGET FROM u GROUP BY o_orderkey")


# L2-L4 L7-L10 (no SQL oracle: a learned model)
def customer_training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver-table stand-in for the credit feature table: customer LEFT
    JOIN the order-view, two-level lineitem and event blocks. Label: a
    negative account balance; customers of the HOUSEHOLD segment play the
    unlabelled scoring rows (TARGET NULL). The balance itself is not a
    feature."""
    cust = load(spark, sf_dir, "customer")
    base = cust.select(
        "c_custkey", "c_nationkey",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("int"))
         .otherwise((F.col("c_acctbal") < 0).cast("int")).alias("TARGET"))
    blocks = [
        order_view_block(orders_nulled(spark, sf_dir)).withColumnRenamed("o_custkey", "c_custkey"),
        lineitem_two_level_block(load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders"))
        .withColumnRenamed("o_custkey", "c_custkey"),
        event_block(load(spark, sf_dir, "events")).withColumnRenamed("user_id", "c_custkey"),
    ]
    return left_star(base, "c_custkey", blocks)


def gbdt_kfold(spark, d):
    from ..learn.gbdt import kfold_boost
    frame = customer_training_frame(spark, d)
    return kfold_boost(frame, key="c_custkey", label="TARGET", n_folds=N_FOLDS, seed=FOLD_SEED).submission


# F2 (the credit bureau block itself) on role-mapped driver tables:
# loans <- orders, monthly balance <- lineitem. Credit columns without a
# counterpart stay NULL (their sums come out 0, their means NULL: N1).
# Mapped money columns stay on the cent grid (no division), so the 6-digit
# rounding used for the cross-engine comparison meets no exact ties.
REF_DATE = "2002-01-01"


def bureau_tables_from_orders(spark, d):
    o = load(spark, d, "orders")
    days = F.datediff(F.col("o_orderdate"), F.lit(REF_DATE).cast("date"))
    n_int, n_dbl = F.lit(None).cast("int"), F.lit(None).cast("double")
    bureau = o.select(
        F.col("o_custkey").alias("SK_ID_CURR"), F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.when(F.col("o_orderstatus") == "O", F.lit("Active"))
         .when(F.col("o_orderstatus") == "F", F.lit("Closed")).alias("CREDIT_ACTIVE"),
        F.lit(None).cast("string").alias("CREDIT_CURRENCY"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
        days.alias("DAYS_CREDIT"), (days + 30).alias("DAYS_CREDIT_UPDATE"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(10)).otherwise(F.lit(0))
         .alias("CREDIT_DAY_OVERDUE"),
        n_int.alias("CNT_CREDIT_PROLONG"),
        (days + F.lit(365.0)).alias("DAYS_CREDIT_ENDDATE"), n_dbl.alias("DAYS_ENDDATE_FACT"),
        n_dbl.alias("AMT_CREDIT_MAX_OVERDUE"), F.col("o_totalprice").alias("AMT_CREDIT_SUM"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") - F.lit(1000.0))
         .otherwise(F.lit(0.0)).alias("AMT_CREDIT_SUM_DEBT"),
        F.lit(0.0).alias("AMT_CREDIT_SUM_OVERDUE"), n_dbl.alias("AMT_CREDIT_SUM_LIMIT"),
        (F.col("o_totalprice") - F.lit(500.0)).alias("AMT_ANNUITY"))
    balance = load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"), (-F.col("l_linenumber")).alias("MONTHS_BALANCE"),
        F.col("l_returnflag").alias("STATUS"))
    return bureau, balance


def credit_bureau_block(spark, d, variant: str = "v2"):
    from .credit import bureau_and_balance
    bureau, balance = bureau_tables_from_orders(spark, d)
    return round_doubles(bureau_and_balance(bureau, balance, variant), 6)


def _sql_spec(spec, prefix, cond=None) -> list[tuple[str, str, str, str]]:
    """(name, SQL aggregate, column, function) for a spec, with the
    library's null contract: sum of only-missing = 0, a view without rows
    gives NULL for every feature."""
    out = []
    guard = None if cond is None else f"count(*) FILTER (WHERE {cond}) > 0"
    for col, funcs in spec.items():
        x = col if cond is None else f"CASE WHEN {cond} THEN {col} END"
        for f in funcs:
            if f == "sum":
                e = f"coalesce(sum({x}), 0)"
            elif f == "size":
                e = "count(*)" if cond is None else f"count(*) FILTER (WHERE {cond})"
            elif f == "nunique":
                e = f"count(DISTINCT {x})"
            else:
                e = {"mean": "avg", "var": "var_samp", "std": "stddev_samp", "min": "min",
                     "max": "max", "count": "count"}[f] + f"({x})"
            if guard and f in ("sum", "size", "nunique", "count"):
                e = f"CASE WHEN {guard} THEN {e} END"
            out.append((f"{prefix}{col}_{f.upper()}", e, col, f))
    return out


def _sql_block(src: str, key: str, spec, prefix: str, shares=(), extra=(), views=(),
               count_name: str | None = None, int_cols=frozenset(), ctes: str = "") -> str:
    """DuckDB query for one feature block: spec + category shares + extra
    aggregates + subset views + row count, grouped by the key. Doubles are
    rounded to 6 digits; sums of integer columns are BIGINT as in Spark."""
    cols = _sql_spec(spec, prefix)
    for c, vals in shares:
        for v in list(vals) + [None]:
            test = f"{c} IS NULL" if v is None else f"{c} = '{v}'"
            cols.append((f"{prefix}{c}_{'nan' if v is None else v}_MEAN",
                         f"avg(CASE WHEN {test} THEN 1.0 ELSE 0.0 END)", c, "share"))
    cols += list(extra)
    for vp, cond, vspec in views:
        cols += _sql_spec(vspec, vp, cond)
    if count_name:
        cols.append((count_name, "count(*)", key, "size"))

    def final(name, e, col, func):
        if func in ("size", "nunique", "count"):
            return f"{e} AS {_q(name)}"
        if col in int_cols and func in ("sum", "min", "max"):
            return f"CAST({e} AS BIGINT) AS {_q(name)}" if func == "sum" else f"{e} AS {_q(name)}"
        return f"round({e}, 6) AS {_q(name)}"
    sel = ",\n  ".join(final(*c) for c in cols)
    return (f"WITH {ctes}src AS ({src})\nSELECT {key},\n  {sel}\n"
            f"FROM src WHERE {key} IS NOT NULL GROUP BY {key}")


def _sql_credit_bureau_block(variant: str = "v2") -> str:
    from .credit import BUREAU_NUM, PREFIXES
    num, pre = BUREAU_NUM[variant], PREFIXES[variant]
    statuses = ["A", "N", "R"]
    bb_shares = ",\n    ".join(_share_sql("STATUS", statuses, ""))
    ctes = f"""bureau AS (SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
    CASE WHEN o_orderstatus = 'O' THEN 'Active' WHEN o_orderstatus = 'F' THEN 'Closed' END AS CREDIT_ACTIVE,
    CAST(NULL AS VARCHAR) AS CREDIT_CURRENCY, o_orderpriority AS CREDIT_TYPE,
    CAST(datediff('day', DATE '{REF_DATE}', o_orderdate) AS INTEGER) AS DAYS_CREDIT,
    CAST(datediff('day', DATE '{REF_DATE}', o_orderdate) + 30 AS INTEGER) AS DAYS_CREDIT_UPDATE,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE 0 END AS CREDIT_DAY_OVERDUE,
    CAST(NULL AS INTEGER) AS CNT_CREDIT_PROLONG,
    datediff('day', DATE '{REF_DATE}', o_orderdate) + 365.0 AS DAYS_CREDIT_ENDDATE,
    CAST(NULL AS DOUBLE) AS DAYS_ENDDATE_FACT, CAST(NULL AS DOUBLE) AS AMT_CREDIT_MAX_OVERDUE,
    o_totalprice AS AMT_CREDIT_SUM,
    CASE WHEN o_orderstatus = 'O' THEN o_totalprice - 1000.0 ELSE 0.0 END AS AMT_CREDIT_SUM_DEBT,
    0.0 AS AMT_CREDIT_SUM_OVERDUE, CAST(NULL AS DOUBLE) AS AMT_CREDIT_SUM_LIMIT,
    o_totalprice - 500.0 AS AMT_ANNUITY FROM orders),
bb AS (SELECT l_orderkey AS SK_ID_BUREAU, -l_linenumber AS MONTHS_BALANCE, l_returnflag AS STATUS FROM lineitem),
bba AS (SELECT SK_ID_BUREAU, min(MONTHS_BALANCE) AS MONTHS_BALANCE_MIN, max(MONTHS_BALANCE) AS MONTHS_BALANCE_MAX,
    count(*) AS MONTHS_BALANCE_SIZE,
    {bb_shares}
  FROM bb GROUP BY SK_ID_BUREAU),
"""
    src = ("SELECT b.*, bba.* EXCLUDE (SK_ID_BUREAU) FROM bureau b "
           "LEFT JOIN bba ON b.SK_ID_BUREAU = bba.SK_ID_BUREAU")
    extra = [(f"BURO_STATUS_{v}_MEAN_MEAN", f"avg({_q(f'STATUS_{v}_MEAN')})", "", "share")
             for v in statuses + ["nan"]]
    ints = {"DAYS_CREDIT", "DAYS_CREDIT_UPDATE", "CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG",
            "MONTHS_BALANCE_MIN", "MONTHS_BALANCE_MAX", "MONTHS_BALANCE_SIZE"}
    return _sql_block(src, "SK_ID_CURR", num, "BURO_",
                      shares=[("CREDIT_ACTIVE", ["Active", "Closed"]), ("CREDIT_CURRENCY", []),
                              ("CREDIT_TYPE", PRIORITY_VALUES)],
                      extra=extra,
                      views=[(pre["active"], "CREDIT_ACTIVE = 'Active'", num),
                             (pre["closed"], "CREDIT_ACTIVE = 'Closed'", num)],
                      int_cols=ints, ctes=ctes)


# F3 previous applications <- orders
CONTRACT_STATUS = {"F": "Approved", "O": "Refused", "P": "Canceled"}


def previous_from_orders(spark, d):
    o = load(spark, d, "orders")
    days = F.datediff(F.col("o_orderdate"), F.lit(REF_DATE).cast("date"))
    status = F.when(F.col("o_orderstatus") == "F", F.lit("Approved")) \
        .when(F.col("o_orderstatus") == "O", F.lit("Refused")) \
        .when(F.col("o_orderstatus") == "P", F.lit("Canceled"))
    sentinel_or_days = F.when(F.col("o_orderstatus") == "P", F.lit(365243.0)) \
        .otherwise(days.cast("double"))
    n_dbl = F.lit(None).cast("double")
    return o.select(
        F.col("o_custkey").alias("SK_ID_CURR"), status.alias("NAME_CONTRACT_STATUS"),
        F.col("o_orderpriority").alias("NAME_CLIENT_TYPE"),
        (F.col("o_totalprice") - F.lit(500.0)).alias("AMT_ANNUITY"),
        F.col("o_totalprice").alias("AMT_APPLICATION"),
        (F.col("o_totalprice") - F.lit(100.0)).alias("AMT_CREDIT"),
        n_dbl.alias("AMT_DOWN_PAYMENT"), F.col("o_totalprice").alias("AMT_GOODS_PRICE"),
        n_dbl.alias("RATE_DOWN_PAYMENT"),
        (F.year("o_orderdate") - 1994).cast("double").alias("CNT_PAYMENT"),
        F.month("o_orderdate").alias("HOUR_APPR_PROCESS_START"), days.alias("DAYS_DECISION"),
        sentinel_or_days.alias("DAYS_FIRST_DRAWING"), sentinel_or_days.alias("DAYS_FIRST_DUE"),
        n_dbl.alias("DAYS_LAST_DUE_1ST_VERSION"), n_dbl.alias("DAYS_LAST_DUE"),
        sentinel_or_days.alias("DAYS_TERMINATION"))


def credit_previous_block(spark, d, variant: str = "v2"):
    from .credit import previous_applications
    return round_doubles(previous_applications(previous_from_orders(spark, d), variant), 6)


def _sql_credit_previous_block(variant: str = "v2") -> str:
    from .credit import PREFIXES, PREV_NUM
    num, pre = PREV_NUM[variant], PREFIXES[variant]
    src = f"""SELECT o_custkey AS SK_ID_CURR,
    CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' WHEN 'P' THEN 'Canceled' END AS NAME_CONTRACT_STATUS,
    o_orderpriority AS NAME_CLIENT_TYPE, o_totalprice - 500.0 AS AMT_ANNUITY, o_totalprice AS AMT_APPLICATION,
    o_totalprice - 100.0 AS AMT_CREDIT, CAST(NULL AS DOUBLE) AS AMT_DOWN_PAYMENT,
    o_totalprice AS AMT_GOODS_PRICE, CAST(NULL AS DOUBLE) AS RATE_DOWN_PAYMENT,
    CAST(year(o_orderdate) - 1994 AS DOUBLE) AS CNT_PAYMENT,
    CAST(month(o_orderdate) AS INTEGER) AS HOUR_APPR_PROCESS_START,
    CAST(datediff('day', DATE '{REF_DATE}', o_orderdate) AS INTEGER) AS DAYS_DECISION,
    o_totalprice / nullif(o_totalprice - 100.0, 0) AS APP_CREDIT_PERC
  FROM orders"""
    return _sql_block(src, "SK_ID_CURR", num, "PREV_",
                      shares=[("NAME_CONTRACT_STATUS", ["Approved", "Canceled", "Refused"]),
                              ("NAME_CLIENT_TYPE", PRIORITY_VALUES)],
                      views=[(pre["approved"], "NAME_CONTRACT_STATUS = 'Approved'", num),
                             (pre["refused"], "NAME_CONTRACT_STATUS = 'Refused'", num)],
                      int_cols={"HOUR_APPR_PROCESS_START", "DAYS_DECISION"})


# F4 POS cash <- events
def pos_from_events(spark, d):
    ev = load(spark, d, "events")
    err = F.col("event_type") == "error"
    return ev.select(
        F.col("user_id").alias("SK_ID_CURR"), (-F.month("ts")).alias("MONTHS_BALANCE"),
        F.col("value").alias("CNT_INSTALMENT"), F.lit(None).cast("double").alias("CNT_INSTALMENT_FUTURE"),
        F.when(err, F.lit(1)).otherwise(F.lit(0)).alias("SK_DPD"),
        F.when(err & (F.col("value") > 100), F.lit(1)).otherwise(F.lit(0)).alias("SK_DPD_DEF"),
        F.col("event_type").alias("STATUS_NAME"))


def credit_pos_block(spark, d, variant: str = "v2"):
    from .credit import pos_cash
    return round_doubles(pos_cash(pos_from_events(spark, d), variant), 6)


def _sql_credit_pos_block(variant: str = "v2") -> str:
    from .credit import POS_SPEC
    months_type = "SMALLINT" if variant == "v1" else "INTEGER"   # v1 down-casts (S5)
    src = f"""SELECT user_id AS SK_ID_CURR, CAST(-month(ts) AS {months_type}) AS MONTHS_BALANCE,
    value AS CNT_INSTALMENT, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS SK_DPD,
    CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END AS SK_DPD_DEF,
    event_type AS STATUS_NAME FROM events"""
    return _sql_block(src, "SK_ID_CURR", POS_SPEC, "POS_", shares=[("STATUS_NAME", EVENT_TYPES)],
                      count_name="POS_COUNT", int_cols={"MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"})


# F5 installments <- events
def installments_from_events(spark, d):
    ev = load(spark, d, "events")
    t = F.col("event_type")
    day = F.dayofyear("ts").cast("double")
    return ev.select(
        F.col("user_id").alias("SK_ID_CURR"),
        F.when(t == "purchase", F.lit(2.0)).when(t == "view", F.lit(1.0))
         .when(t == "signup", F.lit(None).cast("double")).otherwise(F.lit(0.0))
         .alias("NUM_INSTALMENT_VERSION"),
        day.alias("DAYS_INSTALMENT"),
        F.when(t == "error", F.lit(None).cast("double"))
         .otherwise(day + F.floor(F.col("value") / 50) - 3).alias("DAYS_ENTRY_PAYMENT"),
        F.col("value").alias("AMT_INSTALMENT"),
        F.when(t == "click", F.lit(0.0)).otherwise(F.col("value")).alias("AMT_PAYMENT"))


def credit_installments_block(spark, d, variant: str = "v2"):
    from .credit import installments_payments
    return round_doubles(installments_payments(installments_from_events(spark, d), variant), 6)


def _sql_credit_installments_block(variant: str = "v2") -> str:
    from .credit import INS_SPEC, PREFIXES
    pre = PREFIXES[variant]["ins"]
    src = """SELECT *, AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) AS PAYMENT_PERC,
    AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF,
    greatest(coalesce(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT, 0), 0) AS DPD,
    greatest(coalesce(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT, 0), 0) AS DBD
  FROM (SELECT user_id AS SK_ID_CURR,
    CASE event_type WHEN 'purchase' THEN 2.0 WHEN 'view' THEN 1.0 WHEN 'signup' THEN NULL ELSE 0.0 END
      AS NUM_INSTALMENT_VERSION,
    CAST(dayofyear(ts) AS DOUBLE) AS DAYS_INSTALMENT,
    CASE WHEN event_type = 'error' THEN NULL ELSE CAST(dayofyear(ts) AS DOUBLE) + floor(value / 50) - 3 END
      AS DAYS_ENTRY_PAYMENT,
    value AS AMT_INSTALMENT, CASE WHEN event_type = 'click' THEN 0.0 ELSE value END AS AMT_PAYMENT
  FROM events)"""
    return _sql_block(src, "SK_ID_CURR", INS_SPEC[variant], pre, count_name=f"{pre}COUNT")


# F6 credit card balance <- events (same function list over every column)
def card_from_events(spark, d):
    ev = load(spark, d, "events")
    return ev.select(
        F.col("event_id").alias("SK_ID_PREV"), F.col("user_id").alias("SK_ID_CURR"),
        F.col("value").alias("NUM_A"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("NUM_B"),
        F.col("event_type").alias("CAT_A"))


def credit_card_block(spark, d, variant: str = "v2"):
    from .credit import credit_card_balance
    return round_doubles(credit_card_balance(card_from_events(spark, d), variant), 6)


def _sql_credit_card_block(variant: str = "v2") -> str:
    from .credit import CC_FUNCS
    funcs = CC_FUNCS[variant]
    inds = [(f"CAT_A_{t}", f"CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END") for t in EVENT_TYPES] + \
        [("CAT_A_nan", "CASE WHEN event_type IS NULL THEN 1 ELSE 0 END")]
    src = ("SELECT user_id AS SK_ID_CURR, value AS NUM_A, "
           "CASE WHEN event_type = 'purchase' THEN value END AS NUM_B, "
           + ", ".join(f"{e} AS {n}" for n, e in inds) + " FROM events")
    spec = {"NUM_A": funcs, "NUM_B": funcs, **{n: funcs for n, _ in inds}}
    return _sql_block(src, "SK_ID_CURR", spec, "CC_", count_name="CC_COUNT",
                      int_cols={n for n, _ in inds})


# F1 application <- customer JOIN nation (organisation = nation name);
# HOUSEHOLD customers are the unlabelled test rows. Label: the customer has
# an urgent order above 250,000 (related to, not copied into, the features).
N_NATIONS = 25
LABEL_PRIORITY, LABEL_PRICE = "1-URGENT", 250000.0


def application_from_customer(spark, d):
    c = load(spark, d, "customer")
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    # nation is a fixed 25-row dimension at every scale: a proven broadcast bound
    c = c.join(F.broadcast(nation), on="c_nationkey", how="left")
    # one row per labelled customer, aggregated before the join (1:1 join)
    positives = (load(spark, d, "orders")
                 .where((F.col("o_orderpriority") == LABEL_PRIORITY) & (F.col("o_totalprice") > LABEL_PRICE))
                 .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.lit(1).alias("_pos")))
    c = c.join(positives, on="c_custkey", how="left")
    seg, bal, nk, key = F.col("c_mktsegment"), F.col("c_acctbal"), F.col("c_nationkey"), F.col("c_custkey")
    n_str, n_dbl, n_int = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("int")
    base = c.select(
        key.alias("SK_ID_CURR"),
        F.when(seg == "HOUSEHOLD", n_int).otherwise(F.col("_pos").isNotNull().cast("int")).alias("TARGET"),
        F.when(bal > 9900, F.lit("XNA")).when(seg.isin("AUTOMOBILE", "MACHINERY"), F.lit("M"))
         .when(seg == "FURNITURE", n_str).otherwise(F.lit("F")).alias("CODE_GENDER"),
        F.when(bal > 5000, F.lit("Y")).otherwise(F.lit("N")).alias("FLAG_OWN_CAR"),
        F.when(nk < 12, F.lit("Y")).when(nk < 20, F.lit("N")).alias("FLAG_OWN_REALTY"),
        F.col("n_name").alias("ORGANIZATION_TYPE"),
        (bal + F.lit(1000.0)).alias("AMT_INCOME_TOTAL"), (bal + F.lit(3000.0)).alias("AMT_CREDIT"),
        F.when(nk == 0, F.lit(0.0)).otherwise(bal + F.lit(2000.0)).alias("AMT_ANNUITY"),
        (bal + F.lit(1500.0)).alias("AMT_GOODS_PRICE"), nk.alias("CNT_CHILDREN"),
        F.when(nk == 3, F.lit(0.0)).otherwise(nk.cast("double") + 1.0).alias("CNT_FAM_MEMBERS"),
        F.when(seg == "BUILDING", F.lit(365243)).otherwise(-key).cast("int").alias("DAYS_EMPLOYED"),
        (-(key + 10000)).cast("int").alias("DAYS_BIRTH"),
        (F.lit(0.0) - nk.cast("double") * 10.0).alias("DAYS_LAST_PHONE_CHANGE"),
        F.when(bal > 5000, nk.cast("double") + 1.0).alias("OWN_CAR_AGE"),
        # scores in [0, 1]; odd divisors keep them off the decimal grid, so the
        # 6-digit rounding of their means meets no exact ties
        F.when(nk < 5, n_dbl).otherwise(nk.cast("double") / 27.0).alias("EXT_SOURCE_1"),
        F.when(bal < 0, n_dbl).otherwise(bal / 10007.0).alias("EXT_SOURCE_2"),
        F.when(seg == "MACHINERY", n_dbl).otherwise((nk.cast("double") + 5.0) / 31.0).alias("EXT_SOURCE_3"),
        (bal > 0).cast("int").alias("FLAG_DOC_A"), (nk > 10).cast("int").alias("FLAG_DOC_B"),
        (seg == "BUILDING").cast("int").alias("FLAG_DOC_C"),
        F.when(nk > 20, n_int).otherwise((bal > 5000).cast("int")).alias("FLAG_DOC_D"),
        F.lit(1).alias("FLAG_PHONE_X"), (nk < 10).cast("int").alias("FLAG_MAIL_X"),
        F.lit(1).alias("REG_FLAG_X"), seg.alias("_seg"))
    train = base.where(F.col("_seg") != "HOUSEHOLD").drop("_seg")
    test = base.where(F.col("_seg") == "HOUSEHOLD").drop("_seg", "TARGET")
    return train, test


def credit_application_block(spark, d, variant: str = "v2"):
    from .credit import application_features
    train, test = application_from_customer(spark, d)
    return round_doubles(application_features(train, test, variant), 6)


def _sql_credit_application_block_v1() -> str:
    """v1: codes and one-hot (with missing indicator) on all applicants (no
    XNA filter), then the sentinel and four ratios."""
    full = _sql_credit_application_block()
    head = full[:full.index("f AS (SELECT * REPLACE")]
    codes = ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"]
    dict_ctes = ",\n".join(
        f"""d_{c} AS (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY min(part * 1000000000000 + SK_ID_CURR)) - 1 AS INTEGER) AS code
  FROM g WHERE {c} IS NOT NULL GROUP BY {c})""" for c in codes)
    onehot = ",\n  ".join(
        [f"CAST(CASE WHEN g.ORGANIZATION_TYPE = 'NATION_{k}' THEN 1 ELSE 0 END AS INTEGER) AS \"ORGANIZATION_TYPE_NATION_{k}\""
         for k in range(N_NATIONS)]
        + ["CAST(CASE WHEN g.ORGANIZATION_TYPE IS NULL THEN 1 ELSE 0 END AS INTEGER) AS \"ORGANIZATION_TYPE_nan\""])
    r6 = lambda e, n: f"round({e}, 6) + 0.0 AS {n}"
    return head + f"""g AS (SELECT * REPLACE (CASE WHEN DAYS_EMPLOYED = 365243 THEN NULL ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED)
  FROM app),
{dict_ctes}
SELECT g.SK_ID_CURR, g.TARGET,
  coalesce(d_CODE_GENDER.code, -1) AS CODE_GENDER, coalesce(d_FLAG_OWN_CAR.code, -1) AS FLAG_OWN_CAR,
  coalesce(d_FLAG_OWN_REALTY.code, -1) AS FLAG_OWN_REALTY,
  {r6('g.AMT_INCOME_TOTAL', 'AMT_INCOME_TOTAL')}, {r6('g.AMT_CREDIT', 'AMT_CREDIT')},
  {r6('g.AMT_ANNUITY', 'AMT_ANNUITY')}, {r6('g.AMT_GOODS_PRICE', 'AMT_GOODS_PRICE')},
  g.CNT_CHILDREN, {r6('g.CNT_FAM_MEMBERS', 'CNT_FAM_MEMBERS')}, g.DAYS_EMPLOYED, g.DAYS_BIRTH,
  {r6('g.DAYS_LAST_PHONE_CHANGE', 'DAYS_LAST_PHONE_CHANGE')}, {r6('g.OWN_CAR_AGE', 'OWN_CAR_AGE')},
  {r6('g.EXT_SOURCE_1', 'EXT_SOURCE_1')}, {r6('g.EXT_SOURCE_2', 'EXT_SOURCE_2')},
  {r6('g.EXT_SOURCE_3', 'EXT_SOURCE_3')},
  g.FLAG_DOC_A, g.FLAG_DOC_B, g.FLAG_DOC_C, g.FLAG_DOC_D, g.FLAG_PHONE_X, g.FLAG_MAIL_X, g.REG_FLAG_X,
  {onehot},
  {r6('CAST(g.DAYS_EMPLOYED AS DOUBLE) / nullif(CAST(g.DAYS_BIRTH AS DOUBLE), 0)', 'DAYS_EMPLOYED_PERC')},
  {r6('g.AMT_INCOME_TOTAL / nullif(g.AMT_CREDIT, 0)', 'INCOME_CREDIT_PERC')},
  {r6('g.AMT_INCOME_TOTAL / nullif(g.CNT_FAM_MEMBERS, 0)', 'INCOME_PER_PERSON')},
  {r6('g.AMT_ANNUITY / nullif(g.AMT_INCOME_TOTAL, 0)', 'ANNUITY_INCOME_PERC')}
FROM g LEFT JOIN d_CODE_GENDER ON g.CODE_GENDER = d_CODE_GENDER.v
  LEFT JOIN d_FLAG_OWN_CAR ON g.FLAG_OWN_CAR = d_FLAG_OWN_CAR.v
  LEFT JOIN d_FLAG_OWN_REALTY ON g.FLAG_OWN_REALTY = d_FLAG_OWN_REALTY.v"""


def _sql_credit_application_block() -> str:
    docs = ["FLAG_DOC_A", "FLAG_DOC_B", "FLAG_DOC_C", "FLAG_DOC_D"]
    ext = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    codes = ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"]

    def lst(cols):
        return "list_filter([" + ", ".join(f"CAST({c} AS DOUBLE)" for c in cols) + "], lambda x: x IS NOT NULL)"
    dict_ctes = ",\n".join(
        f"""d_{c} AS (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY min(part * 1000000000000 + SK_ID_CURR)) - 1 AS INTEGER) AS code
  FROM g WHERE {c} IS NOT NULL GROUP BY {c})""" for c in codes)
    onehot = ",\n  ".join(
        f"CAST(CASE WHEN g.ORGANIZATION_TYPE = 'NATION_{k}' THEN 1 ELSE 0 END AS INTEGER) AS \"ORGANIZATION_TYPE_NATION_{k}\""
        for k in range(N_NATIONS))
    # "+ 0.0" turns -0.0 (0 / negative) into 0.0, as Spark's decimal round does
    r6 = lambda e, n: f"round({e}, 6) + 0.0 AS {n}"
    return f"""WITH cn AS (SELECT c.*, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
app AS (SELECT c_custkey AS SK_ID_CURR,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE CAST(c_custkey IN (SELECT o_custkey FROM orders
      WHERE o_orderpriority = '{LABEL_PRIORITY}' AND o_totalprice > {LABEL_PRICE}) AS INTEGER) END AS TARGET,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS part,
    CASE WHEN c_acctbal > 9900 THEN 'XNA' WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'M'
         WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE 'F' END AS CODE_GENDER,
    CASE WHEN c_acctbal > 5000 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
    CASE WHEN c_nationkey < 12 THEN 'Y' WHEN c_nationkey < 20 THEN 'N' END AS FLAG_OWN_REALTY,
    n_name AS ORGANIZATION_TYPE,
    c_acctbal + 1000.0 AS AMT_INCOME_TOTAL, c_acctbal + 3000.0 AS AMT_CREDIT,
    CASE WHEN c_nationkey = 0 THEN 0.0 ELSE c_acctbal + 2000.0 END AS AMT_ANNUITY,
    c_acctbal + 1500.0 AS AMT_GOODS_PRICE, c_nationkey AS CNT_CHILDREN,
    CASE WHEN c_nationkey = 3 THEN 0.0 ELSE CAST(c_nationkey AS DOUBLE) + 1.0 END AS CNT_FAM_MEMBERS,
    CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 365243 ELSE -c_custkey END AS INTEGER) AS DAYS_EMPLOYED,
    CAST(-(c_custkey + 10000) AS INTEGER) AS DAYS_BIRTH,
    0.0 - CAST(c_nationkey AS DOUBLE) * 10.0 AS DAYS_LAST_PHONE_CHANGE,
    CASE WHEN c_acctbal > 5000 THEN CAST(c_nationkey AS DOUBLE) + 1.0 END AS OWN_CAR_AGE,
    CASE WHEN c_nationkey < 5 THEN NULL ELSE CAST(c_nationkey AS DOUBLE) / 27.0 END AS EXT_SOURCE_1,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal / 10007.0 END AS EXT_SOURCE_2,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE (CAST(c_nationkey AS DOUBLE) + 5.0) / 31.0 END AS EXT_SOURCE_3,
    CAST(c_acctbal > 0 AS INTEGER) AS FLAG_DOC_A, CAST(c_nationkey > 10 AS INTEGER) AS FLAG_DOC_B,
    CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS FLAG_DOC_C,
    CASE WHEN c_nationkey > 20 THEN NULL ELSE CAST(c_acctbal > 5000 AS INTEGER) END AS FLAG_DOC_D,
    1 AS FLAG_PHONE_X, CAST(c_nationkey < 10 AS INTEGER) AS FLAG_MAIL_X, 1 AS REG_FLAG_X
  FROM cn),
f AS (SELECT * REPLACE (CASE WHEN DAYS_EMPLOYED = 365243 THEN NULL ELSE DAYS_EMPLOYED END AS DAYS_EMPLOYED)
  FROM app WHERE CODE_GENDER IS DISTINCT FROM 'XNA'),
med AS (SELECT ORGANIZATION_TYPE AS org, median(AMT_INCOME_TOTAL) AS m FROM f GROUP BY 1),
lv AS (SELECT f.*, med.m AS NEW_INC_BY_ORG, {lst(docs)} AS dv, {lst(ext)} AS ev
  FROM f LEFT JOIN med ON f.ORGANIZATION_TYPE = med.org),
mo AS (SELECT *, CAST(len(dv) AS DOUBLE) AS dn, list_sum(dv) / len(dv) AS dmu,
    CAST(len(ev) AS DOUBLE) AS en, CASE WHEN len(ev) > 0 THEN list_sum(ev) / len(ev) END AS emu FROM lv),
mm AS (SELECT *, list_sum(list_transform(dv, lambda x: (x - dmu) * (x - dmu))) AS dm2,
    list_sum(list_transform(dv, lambda x: ((x - dmu) * (x - dmu)) * ((x - dmu) * (x - dmu)))) AS dm4,
    coalesce(list_sum(list_transform(ev, lambda x: (x - emu) * (x - emu))), 0.0) AS em2 FROM mo),
g AS (SELECT *,
    CASE WHEN dn < 4 THEN NULL WHEN abs((dn - 2) * (dn - 3) * dm2 * dm2) < 1e-14 THEN 0.0
         ELSE dn * (dn + 1) * (dn - 1) * dm4 / ((dn - 2) * (dn - 3) * dm2 * dm2) - 3.0 * (dn - 1) * (dn - 1) / ((dn - 2) * (dn - 3)) END AS kurt,
    CASE WHEN en > 1 THEN sqrt(em2 / (en - 1.0)) END AS sstd
  FROM mm),
{dict_ctes}
SELECT g.SK_ID_CURR, g.TARGET,
  coalesce(d_CODE_GENDER.code, -1) AS CODE_GENDER, coalesce(d_FLAG_OWN_CAR.code, -1) AS FLAG_OWN_CAR,
  coalesce(d_FLAG_OWN_REALTY.code, -1) AS FLAG_OWN_REALTY,
  {r6('g.AMT_INCOME_TOTAL', 'AMT_INCOME_TOTAL')}, {r6('g.AMT_CREDIT', 'AMT_CREDIT')},
  {r6('g.AMT_ANNUITY', 'AMT_ANNUITY')}, {r6('g.AMT_GOODS_PRICE', 'AMT_GOODS_PRICE')},
  g.CNT_CHILDREN, {r6('g.CNT_FAM_MEMBERS', 'CNT_FAM_MEMBERS')}, g.DAYS_EMPLOYED, g.DAYS_BIRTH,
  {r6('g.DAYS_LAST_PHONE_CHANGE', 'DAYS_LAST_PHONE_CHANGE')}, {r6('g.OWN_CAR_AGE', 'OWN_CAR_AGE')},
  {r6('g.EXT_SOURCE_1', 'EXT_SOURCE_1')}, {r6('g.EXT_SOURCE_2', 'EXT_SOURCE_2')},
  {r6('g.EXT_SOURCE_3', 'EXT_SOURCE_3')},
  g.FLAG_DOC_A, g.FLAG_DOC_B, g.FLAG_DOC_C, g.FLAG_DOC_D, g.FLAG_PHONE_X, g.FLAG_MAIL_X, g.REG_FLAG_X,
  {r6('g.AMT_CREDIT / nullif(g.AMT_ANNUITY, 0)', 'NEW_CREDIT_TO_ANNUITY_RATIO')},
  {r6('g.AMT_CREDIT / nullif(g.AMT_GOODS_PRICE, 0)', 'NEW_CREDIT_TO_GOODS_RATIO')},
  {r6('g.kurt', 'NEW_DOC_IND_KURT')},
  {r6('CAST(coalesce(g.FLAG_PHONE_X, 0) AS DOUBLE) + CAST(coalesce(g.FLAG_MAIL_X, 0) AS DOUBLE)', 'NEW_LIVE_IND_SUM')},
  {r6('g.AMT_INCOME_TOTAL / nullif(1.0 + g.CNT_CHILDREN, 0)', 'NEW_INC_PER_CHLD')},
  {r6('g.NEW_INC_BY_ORG', 'NEW_INC_BY_ORG')},
  {r6('CAST(g.DAYS_EMPLOYED AS DOUBLE) / nullif(CAST(g.DAYS_BIRTH AS DOUBLE), 0)', 'NEW_EMPLOY_TO_BIRTH_RATIO')},
  {r6('g.AMT_ANNUITY / nullif(1.0 + g.AMT_INCOME_TOTAL, 0)', 'NEW_ANNUITY_TO_INCOME_RATIO')},
  {r6('g.EXT_SOURCE_1 * g.EXT_SOURCE_2 * g.EXT_SOURCE_3', 'NEW_SOURCES_PROD')},
  {r6('CASE WHEN g.en > 0 THEN g.emu END', 'NEW_EXT_SOURCES_MEAN')},
  {r6('coalesce(g.sstd, avg(g.sstd) OVER ())', 'NEW_SCORES_STD')},
  {r6('g.OWN_CAR_AGE / nullif(CAST(g.DAYS_BIRTH AS DOUBLE), 0)', 'NEW_CAR_TO_BIRTH_RATIO')},
  {r6('g.OWN_CAR_AGE / nullif(CAST(g.DAYS_EMPLOYED AS DOUBLE), 0)', 'NEW_CAR_TO_EMPLOY_RATIO')},
  {r6('g.DAYS_LAST_PHONE_CHANGE / nullif(CAST(g.DAYS_BIRTH AS DOUBLE), 0)', 'NEW_PHONE_TO_BIRTH_RATIO_RAW')},
  {r6('g.DAYS_LAST_PHONE_CHANGE / nullif(CAST(g.DAYS_EMPLOYED AS DOUBLE), 0)', 'NEW_PHONE_TO_BIRTH_RATIO')},
  {r6('g.AMT_CREDIT / nullif(g.AMT_INCOME_TOTAL, 0)', 'NEW_CREDIT_TO_INCOME_RATIO')},
  {onehot}
FROM g LEFT JOIN d_CODE_GENDER ON g.CODE_GENDER = d_CODE_GENDER.v
  LEFT JOIN d_FLAG_OWN_CAR ON g.FLAG_OWN_CAR = d_FLAG_OWN_CAR.v
  LEFT JOIN d_FLAG_OWN_REALTY ON g.FLAG_OWN_REALTY = d_FLAG_OWN_REALTY.v"""


# F1 LEFT JOIN F2 ... F6: the full credit feature table on the mapped tables
def credit_tables_from_driver(spark, d) -> dict:
    train, test = application_from_customer(spark, d)
    bureau, balance = bureau_tables_from_orders(spark, d)
    return {"application_train": train, "application_test": test, "bureau": bureau,
            "bureau_balance": balance, "previous_application": previous_from_orders(spark, d),
            "POS_CASH_balance": pos_from_events(spark, d),
            "installments_payments": installments_from_events(spark, d),
            "credit_card_balance": card_from_events(spark, d)}


def credit_model(spark, d):
    """F8: the k-fold boosted-tree job on the assembled credit feature table
    (rows-only check: a learned model has no SQL oracle)."""
    from ..learn.gbdt import kfold_boost
    from .credit import credit_feature_table
    feats = credit_feature_table(credit_tables_from_driver(spark, d), "v2")
    return kfold_boost(feats, key="SK_ID_CURR", label="TARGET", n_folds=N_FOLDS, seed=FOLD_SEED).submission


def credit_feature_table_q(spark, d):
    from .credit import credit_feature_table
    return round_doubles(credit_feature_table(credit_tables_from_driver(spark, d), "v2"), 6)


def _sql_credit_feature_table() -> str:
    parts = [_sql_credit_application_block(), _sql_credit_bureau_block(),
             _sql_credit_previous_block(), _sql_credit_pos_block(),
             _sql_credit_installments_block(), _sql_credit_card_block()]
    sql = f"SELECT * FROM ({parts[0]}) AS b0"
    for i, p in enumerate(parts[1:], 1):
        sql += f"\nLEFT JOIN ({p}) AS b{i} USING (SK_ID_CURR)"
    return sql


QUERIES = {
    "scan_cast": scan_cast,
    "null_safe_filter": null_safe_filter,
    "sentinel_ratio": sentinel_ratio,
    "shifted_ratio_clamp": shifted_ratio_clamp,
    "missing_profile": missing_profile_q,
    "one_hot": one_hot_q,
    "factorize": factorize_q,
    "group_spec_agg": group_spec_agg,
    "distinct_count": distinct_count,
    "category_share": category_share,
    "category_rate": category_rate,
    "subset_views": subset_views,
    "subset_views_joined": subset_views_joined,
    "two_level_agg": two_level_agg,
    "agg_all_columns": agg_all_columns,
    "group_median_lookup": group_median_lookup,
    "median_hot_groups": median_hot_groups,
    "fill_global_mean": fill_global_mean,
    "row_sum_mean_std_prod": row_sum_mean_std_prod,
    "row_kurtosis": row_kurtosis_q,
    "union_by_name_split": union_by_name_split,
    "distinct_pairs": distinct_pairs,
    "semi_top_k": semi_top_k,
    "star_assembly": star_assembly,
    "bureau_rates": bureau_rates_q,
    "bureau_rates_full": bureau_rates_full,
    "bureau_rates_fanout": bureau_rates_fanout,
    "category_share_long": category_share_long,
    "csv_roundtrip": csv_roundtrip,
    "csv_dialect_roundtrip": csv_dialect_roundtrip,
    "csv_quarantine": csv_quarantine,
    "file_order_codes": file_order_codes,
    "skew_join": skew_join,
    "sparse_category_counts": sparse_category_counts,
    "bucketed_star": bucketed_star,
    "sketch_profile": sketch_profile,
    "head_limit": head_limit,
    "kfold_assign": kfold_assign,
    "roc_auc": roc_auc_q,
    "roc_auc_by_fold": roc_auc_by_fold,
    "fold_mean_score": fold_mean_score,
    "top_importances": top_importances,
    "credit_application_block": credit_application_block,
    "credit_bureau_block": credit_bureau_block,
    "credit_previous_block": credit_previous_block,
    "credit_pos_block": credit_pos_block,
    "credit_installments_block": credit_installments_block,
    "credit_card_block": credit_card_block,
    "credit_application_block_v1": lambda spark, d: credit_application_block(spark, d, "v1"),
    "credit_bureau_block_v1": lambda spark, d: credit_bureau_block(spark, d, "v1"),
    "credit_pos_block_v1": lambda spark, d: credit_pos_block(spark, d, "v1"),
    "credit_previous_block_v1": lambda spark, d: credit_previous_block(spark, d, "v1"),
    "credit_installments_block_v1": lambda spark, d: credit_installments_block(spark, d, "v1"),
    "credit_card_block_v1": lambda spark, d: credit_card_block(spark, d, "v1"),
    "credit_feature_table": credit_feature_table_q,
    "gbdt_kfold": gbdt_kfold,
    "credit_model": credit_model,
}

ORACLE_SQL = {
    "scan_cast": SQL_SCAN_CAST,
    "null_safe_filter": SQL_NULL_SAFE_FILTER,
    "sentinel_ratio": SQL_SENTINEL_RATIO,
    "shifted_ratio_clamp": SQL_SHIFTED_RATIO_CLAMP,
    "missing_profile": _sql_missing_profile(),
    "one_hot": _sql_one_hot(),
    "factorize": SQL_FACTORIZE,
    "group_spec_agg": SQL_GROUP_SPEC_AGG,
    "distinct_count": SQL_DISTINCT_COUNT,
    "category_share": _sql_category_share(),
    "category_rate": _sql_category_rate(),
    "subset_views": _sql_subset_views(),
    "subset_views_joined": _sql_subset_views(),
    "two_level_agg": _sql_two_level_agg(),
    "agg_all_columns": _sql_agg_all_columns(),
    "group_median_lookup": SQL_GROUP_MEDIAN_LOOKUP,
    "median_hot_groups": SQL_MEDIAN_HOT_GROUPS,
    "fill_global_mean": SQL_FILL_GLOBAL_MEAN,
    "row_sum_mean_std_prod": _sql_row_stats(),
    "row_kurtosis": SQL_ROW_KURTOSIS,
    "union_by_name_split": SQL_UNION_BY_NAME_SPLIT,
    "distinct_pairs": SQL_DISTINCT_PAIRS,
    "semi_top_k": SQL_SEMI_TOP_K,
    "star_assembly": _sql_star_assembly(),
    "bureau_rates": _sql_bureau_rates(),
    "bureau_rates_full": _sql_bureau_rates_full(),
    "bureau_rates_fanout": SQL_BUREAU_RATES_FANOUT,
    "category_share_long": SQL_CATEGORY_SHARE_LONG,
    "csv_roundtrip": SQL_CSV_ROUNDTRIP,
    "csv_dialect_roundtrip": _sql_csv_dialect_roundtrip(),
    "csv_quarantine": SQL_CSV_QUARANTINE,
    "file_order_codes": SQL_FILE_ORDER_CODES,
    "skew_join": SQL_SKEW_JOIN,
    "sparse_category_counts": SQL_SPARSE_CATEGORY_COUNTS,
    "bucketed_star": _sql_star_assembly(),
    "sketch_profile": SQL_SKETCH_PROFILE,
    "head_limit": SQL_HEAD_LIMIT,
    "kfold_assign": SQL_KFOLD_ASSIGN,
    "roc_auc": SQL_ROC_AUC,
    "roc_auc_by_fold": SQL_ROC_AUC_BY_FOLD,
    "fold_mean_score": _sql_fold_mean_score(),
    "top_importances": SQL_TOP_IMPORTANCES,
    "credit_application_block": _sql_credit_application_block(),
    "credit_bureau_block": _sql_credit_bureau_block(),
    "credit_previous_block": _sql_credit_previous_block(),
    "credit_pos_block": _sql_credit_pos_block(),
    "credit_installments_block": _sql_credit_installments_block(),
    "credit_card_block": _sql_credit_card_block(),
    "credit_application_block_v1": _sql_credit_application_block_v1(),
    "credit_bureau_block_v1": _sql_credit_bureau_block("v1"),
    "credit_pos_block_v1": _sql_credit_pos_block("v1"),
    "credit_previous_block_v1": _sql_credit_previous_block("v1"),
    "credit_installments_block_v1": _sql_credit_installments_block("v1"),
    "credit_card_block_v1": _sql_credit_card_block("v1"),
    "credit_feature_table": _sql_credit_feature_table(),
}
