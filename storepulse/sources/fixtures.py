"""Derive the two report inputs from the TPC-H-like test tables.

The report job reads ``daily_report_base`` (one row per store and day, 38
additive measures) and ``store_lookup``.  The test data has neither, so a
nation plays the store and an order date plays the business day:

    lineitem -> orders -> customer -> nation -> region,  lineitem -> part

Plan shape (chosen for large inputs, see README "Scale"):

1. line level: lineitem joined to orders (on order key) and part (on part key);
   all line measures are computed here as exact decimals;
2. order level: ``groupBy(order)`` - partial aggregation collapses lines of
   one order map-side, so the shuffle carries order-level rows;
3. customer-day level: ``groupBy(date, nation, customer)`` turns the distinct
   customer counts into plain counts without Spark's Expand-based
   multi-distinct aggregation;
4. store-day level: ``groupBy(date, nation)``, then the tiny nation/region
   dimension adds names.

A hot nation or day only meets partial aggregation before a shuffle; lines are
dealt by order, which has a handful of them.  The exchanges of lines and orders
have as many partitions as their tables' rows need (``TASK_ROWS`` each) where the
session has fewer, so what a task holds does not grow with the input.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import metrics as M
from .. import schemas
from ..operators.lookup import fits
from .tables import read_table

# Fixed values of the fixture mapping (how test tables stand in for stores).
ONLINE_NATION = 23
OMNI_NATION = 24
MISSING_LOOKUP_NATION = 8
FINANCED_PRIORITIES = ("1-URGENT", "2-HIGH")
APPLICATION_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")
FURNITURE_TYPES = ("STANDARD", "LARGE")
BEDDING_TYPES = ("SMALL", "MEDIUM")
PROTECTION_TYPE = "PROMO"
DELIVERY_TYPE = "ECONOMY"
EXCLUDED_TYPES = ("PROMO", "ECONOMY")
COST_RATE = "0.60"
FINANCING_RATE = "0.03"
FINANCED_SHARE = "0.80"

TASK_ROWS = 400_000  # rows of lineitem, orders and customer a task of the derivation, on average
PARTS_IN_MEMORY = 500_000  # rows of part up to which every executor gets them all
FIRST_OPEN_DATE = "1995-01-01"
OPEN_DATE_STEP_DAYS = 100


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _dec(text: str) -> str:
    """A decimal literal of exactly the digits written (never a double)."""
    d = Decimal(text)
    digits, scale = len(d.as_tuple().digits), -d.as_tuple().exponent
    return f"CAST({text} AS DECIMAL({max(digits, scale) + 1},{scale}))"


def _sum_if(cond: str, value: str, nullable: bool = False) -> str:
    """``sum(CASE WHEN cond THEN value ELSE 0 END)``, or without the ELSE, adding up nothing but the values that count."""
    total = f"sum({value}) FILTER (WHERE {cond})"
    return total if nullable else f"coalesce({total}, CASE WHEN NOT bool_and(coalesce({cond}, false)) THEN 0 END)"


def _profit_center(k: str) -> str:
    return (f"CASE WHEN {k} = {ONLINE_NATION} THEN '{M.ONLINE_PROFIT_CENTER}' "
            f"WHEN {k} = {OMNI_NATION} THEN '{M.OMNI_PROFIT_CENTER}' "
            f"ELSE CAST({k} + 100 AS STRING) END")


def dealt(df: DataFrame, key: str, tasks: int) -> DataFrame:
    """``df`` in partitions by ``key``: as many as adaptive execution finds right, or ``tasks`` if the session allows fewer.

    So a task of a session with few shuffle partitions holds no more as the input grows.
    """
    few = tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(key) if few else df.repartition(tasks, key)


def met(left: DataFrame, key: str, right: DataFrame, right_key: str, tasks: int) -> DataFrame:
    """Inner join, dealt by the keys: the right side's rows are looked up in memory, neither side's are sorted."""
    return dealt(left, key, tasks).join(
        dealt(right, right_key, tasks).hint("shuffle_hash"), F.col(key) == F.col(right_key))


def _order_level(spark: SparkSession, root: str, tasks: int) -> DataFrame:
    li = read_table(spark, root, "lineitem", [
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ])
    od = read_table(spark, root, "orders", [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
    ])
    pt = read_table(spark, root, "part", ["p_partkey", "p_type"])

    # Lines meet their part, then are dealt by order key: the orders join and the
    # per-order aggregation below need no further exchange of lines, and the
    # decimal-heavy aggregation runs on every core even where the scan has few
    # splits.  An order has a handful of lines, so the key is not hot.
    lines = li.join(F.broadcast(pt), li.l_partkey == pt.p_partkey) if fits(pt, PARTS_IN_MEMORY) else met(
        li, "l_partkey", pt, "p_partkey", tasks)
    lines = met(lines, "l_orderkey", od, "o_orderkey", tasks)
    e = "CAST(l_extendedprice AS DECIMAL(15,2))"
    net = f"{e} * (1 - CAST(l_discount AS DECIMAL(4,2)))"
    odate = "CAST(o_orderdate AS DATE)"
    lines = lines.selectExpr(
        "l_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", f"{odate} AS odate",
        f"{e} AS e",
        f"{net} AS net",
        f"{e} * {_dec(COST_RATE)} AS cost",
        "CAST(l_quantity AS DECIMAL(15,2)) AS qty",
        f"abs(datediff(CAST(l_shipdate AS DATE), {odate})) AS days",
        f"{net} * CAST(l_tax AS DECIMAL(4,2)) AS tax",
        f"p_type IN ({_in(FURNITURE_TYPES)}) AS fur",
        f"p_type IN ({_in(BEDDING_TYPES)}) AS bed",
        f"p_type = '{PROTECTION_TYPE}' AS promo",
        f"p_type = '{DELIVERY_TYPE}' AS econ",
        f"NOT (p_type IN ({_in(EXCLUDED_TYPES)})) AS inc",
        "l_linestatus = 'F' AS dlv",
        "l_returnflag = 'R' AS ret",
        "l_discount > 0 AS disc",
    )
    sums = {
        "s_net": "sum(net)",
        "s_cost": "sum(cost)",
        "s_tax": "sum(tax)",
        "s_fur": _sum_if("fur", "net"),
        "s_bed": _sum_if("bed", "net", nullable=True),
        "s_promo": _sum_if("promo", "net"),
        "s_econ": _sum_if("econ", "net"),
        "c_fur": _sum_if("fur", "cost"),
        "c_bed": _sum_if("bed", "cost", nullable=True),
        "s_ret": _sum_if("ret", "net"),
        "inc_net": _sum_if("inc", "net"),
        "inc_cost": _sum_if("inc", "cost"),
        "inc_e": _sum_if("inc", "e"),
        "inc_net_kept": _sum_if("inc AND NOT ret", "net"),
        "inc_qty_kept": _sum_if("inc AND NOT ret", "qty"),
        "dlv_net": _sum_if("dlv", "net"),
        "dlv_cost": _sum_if("dlv", "cost"),
        "dlv_qty": _sum_if("dlv", "qty"),
        "dlv_wdays": _sum_if("dlv", "qty * days"),
        "dlv_bed_net": _sum_if("dlv AND bed", "net"),
        "any_disc": "max(CAST(disc AS INT))",
        "any_inc": "max(CAST(inc AS INT))",
    }
    return lines.groupBy("l_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "odate").agg(
        *[F.expr(v).alias(k) for k, v in sums.items()]
    )


_CUSTOMER_SUMS = (
    "s_net", "s_cost", "s_tax", "s_fur", "s_bed", "s_promo", "s_econ", "c_fur", "c_bed", "s_ret",
    "inc_net", "inc_cost", "inc_e", "inc_net_kept", "inc_qty_kept", "dlv_net", "dlv_cost",
    "dlv_qty", "dlv_wdays", "dlv_bed_net", "deposit", "fin_cost", "fin_fur", "fin_bed",
    "fin_sales", "fin_amt",
)

# Column of the base -> SQL over the store-day aggregate (k = nation key).
_BASE_VALUES = {
    "report_date": "odate",
    "ly_date": f"date_sub(odate, {M.LY_SHIFT_DAYS})",
    "app_key": "k",
    "profit_center": _profit_center("k"),
    "custom_key": "concat_ws(';', odate, n_name)",
    "filter_level": "'Store'",
    "segment": "n_name",
    "store_name": "n_name",
    "region": "r_name",
    "market": "CASE WHEN k % 7 = 6 THEN 'n/a' ELSE concat('M', CAST(k % 7 AS STRING)) END",
    "traffic": "CASE WHEN is_store THEN carts * 3 ELSE 0 END",
    "total_sales_amt": "s_net",
    "stores_sales_amt": "CASE WHEN is_store THEN s_net ELSE 0 END",
    "online_sales_amt": f"CASE WHEN k = {ONLINE_NATION} THEN s_net ELSE 0 END",
    "omni_sales_amt": f"CASE WHEN k = {OMNI_NATION} THEN s_net ELSE 0 END",
    "total_cogs": "s_cost",
    "total_cogs_stores": "CASE WHEN is_store THEN s_cost ELSE 0 END",
    "total_tax_amt": "s_tax",
    "total_deposit_amt": "deposit",
    "carts_count": "carts",
    "applications_count": "apps",
    "paid_hours": "CASE WHEN is_store THEN customers * 8 ELSE 0 END",
    "bedding_sales_amt": "s_bed",
    "protection_sales_amt": "s_promo",
    "furniture_sales_amt": "s_fur",
    "furniture_cogs": "c_fur",
    "bedding_cogs": "c_bed",
    "furniture_financing_cost": "fin_fur",
    "bedding_financing_cost": "fin_bed",
    "delivery_sales_amt": "s_econ",
    "cancelled_sales_amt": "s_ret",
    "sales_financed": "fin_sales",
    "customers_financed": "fin_customers",
    "total_financed_amt": "fin_amt",
    "total_financing_cost": "fin_cost",
    "unique_cust_count": "customers",
    "discounted_cust_count": "disc_customers",
    "all_sales_exc_ctgs": "inc_net",
    "all_cogs_exc_ctgs": "inc_cost",
    "all_promo_exc_ctgs": "inc_e",
    "cust_count_exc_ctgs": "inc_customers",
    "sales_exc_ctgs": "inc_net_kept",
    "qty_exc_ctgs": "inc_qty_kept",
    "sales_delivered": "dlv_net",
    "cogs_delivered": "dlv_cost",
    "qty_delivered": "dlv_qty",
    "weighted_days": "dlv_wdays",
    "bedding_sales_delivered": "dlv_bed_net",
}


def derive_report_base(spark: SparkSession, root: str) -> DataFrame:
    """``daily_report_base`` built from the test tables (schema ``REPORT_BASE``)."""
    # What a task holds is set by the tables' rows, not by the session's number of shuffle partitions.
    rows = sum(read_table(spark, root, t).count() for t in ("lineitem", "orders", "customer"))
    tasks = -(-rows // TASK_ROWS)
    orders = _order_level(spark, root, tasks)
    cu = read_table(spark, root, "customer", ["c_custkey", "c_nationkey"])
    na = read_table(spark, root, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    rg = read_table(spark, root, "region", ["r_regionkey", "r_name"])

    fin = f"o_orderpriority IN ({_in(FINANCED_PRIORITIES)})"
    rate = _dec(FINANCING_RATE)
    orders = orders.selectExpr(
        "*",
        "CASE WHEN o_orderstatus = 'P' THEN s_net ELSE 0 END AS deposit",
        f"CASE WHEN {fin} THEN {rate} * s_net ELSE 0 END AS fin_cost",
        f"CASE WHEN {fin} THEN {rate} * s_fur ELSE 0 END AS fin_fur",
        f"CASE WHEN {fin} THEN {rate} * coalesce(s_bed, 0) ELSE 0 END AS fin_bed",
        f"CASE WHEN {fin} THEN s_net ELSE 0 END AS fin_sales",
        f"CASE WHEN {fin} THEN s_net * {_dec(FINANCED_SHARE)} ELSE 0 END AS fin_amt",
        f"CAST({fin} AS INT) AS is_fin",
        f"CAST(o_orderpriority IN ({_in(APPLICATION_PRIORITIES)}) AS INT) AS is_app",
    )

    per_customer = (
        met(orders, "o_custkey", cu, "c_custkey", tasks)
        .groupBy("odate", "c_nationkey", "o_custkey")
        .agg(
            *[F.expr(f"sum({c})").alias(c) for c in _CUSTOMER_SUMS],
            F.expr("count(1)").alias("n_orders"),
            F.expr("sum(is_app)").alias("n_apps"),
            F.expr("max(is_fin)").alias("fin_any"),
            F.expr("max(any_disc)").alias("disc_any"),
            F.expr("max(any_inc)").alias("inc_any"),
        )
    )
    per_store = per_customer.groupBy("odate", "c_nationkey").agg(
        *[F.expr(f"sum({c})").alias(c) for c in _CUSTOMER_SUMS],
        F.expr("sum(n_orders)").alias("carts"),
        F.expr("sum(n_apps)").alias("apps"),
        F.expr("count(1)").alias("customers"),
        F.expr("sum(fin_any)").alias("fin_customers"),
        F.expr("sum(disc_any)").alias("disc_customers"),
        F.expr("sum(inc_any)").alias("inc_customers"),
    )
    geo = na.join(rg, na.n_regionkey == rg.r_regionkey).select("n_nationkey", "n_name", "r_name")
    df = per_store.join(geo, per_store.c_nationkey == geo.n_nationkey).selectExpr(
        "*", "CAST(c_nationkey AS BIGINT) AS k",
        f"NOT (c_nationkey IN ({ONLINE_NATION}, {OMNI_NATION})) AS is_store",
    )
    return df.selectExpr(*[
        f"CAST({_BASE_VALUES[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schemas.REPORT_BASE.fields
    ])


def derive_store_lookup(spark: SparkSession, root: str) -> DataFrame:
    """``store_lookup`` built from ``nation``: one row per nation except one
    (a lookup miss), some opening dates unknown (null)."""
    na = read_table(spark, root, "nation", ["n_nationkey"])
    k = "n_nationkey"
    return na.filter(f"{k} <> {MISSING_LOOKUP_NATION}").selectExpr(
        f"CAST({k} AS BIGINT) AS app_key",
        f"CAST({_profit_center(k)} AS INT) AS pft_ctr",
        f"CASE WHEN {k} % 9 = 4 THEN CAST(NULL AS DATE) "
        f"ELSE date_add(DATE'{FIRST_OPEN_DATE}', {k} * {OPEN_DATE_STEP_DAYS}) END AS grand_open_date",
    )
