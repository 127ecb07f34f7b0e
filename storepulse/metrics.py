"""Declarative metric tables of the retail KPI report.

Everything in the "fixed values" blocks must equal the business definitions the
reports were specified with: column names, the order of the 48 compared
measures, metric labels, their display order and color codes.  The rest of the
package builds Spark expressions *from* these tables; no operator hard-codes a
metric name.
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# Column names of the store-by-day fact table.
# --------------------------------------------------------------------------

KEY_COLUMNS = (
    "report_date", "ly_date", "app_key", "profit_center", "custom_key",
    "filter_level", "segment", "store_name", "region", "market",
)

# The nine keys kept by the year-over-year comparison (ly_date is dropped).
COMPARE_KEY_COLUMNS = (
    "report_date", "app_key", "profit_center", "custom_key", "filter_level",
    "segment", "store_name", "region", "market",
)

# The 38 additive measures, in their defined order.
ADDITIVE_MEASURES = (
    "traffic", "total_sales_amt", "stores_sales_amt", "online_sales_amt", "omni_sales_amt",
    "total_cogs", "total_cogs_stores", "total_tax_amt", "total_deposit_amt", "carts_count",
    "applications_count", "paid_hours", "bedding_sales_amt", "protection_sales_amt",
    "furniture_sales_amt", "furniture_cogs", "bedding_cogs", "furniture_financing_cost",
    "bedding_financing_cost", "delivery_sales_amt", "cancelled_sales_amt", "sales_financed",
    "customers_financed", "total_financed_amt", "total_financing_cost", "unique_cust_count",
    "discounted_cust_count", "all_sales_exc_ctgs", "all_cogs_exc_ctgs", "all_promo_exc_ctgs",
    "cust_count_exc_ctgs", "sales_exc_ctgs", "qty_exc_ctgs", "sales_delivered",
    "cogs_delivered", "qty_delivered", "weighted_days", "bedding_sales_delivered",
)

# The additive measures that are whole counts (bigint); the other
# 31 additive measures are amounts, decimal(15,2).
COUNT_MEASURES = (
    "traffic", "carts_count", "applications_count", "customers_financed",
    "cust_count_exc_ctgs", "discounted_cust_count", "unique_cust_count",
)


@dataclass(frozen=True)
class Kpi:
    """A derived KPI: ``round((sum(plus) - sum(minus)) [* 100] / per, 2)``.

    * ``per`` is the denominator and the zero guard: a zero denominator gives 0,
      a null one gives null.  ``per=None`` means no division (a plain difference).
    * ``pct`` multiplies the numerator by 100.
    * ``double`` marks the four count ratios that are defined with a floating
      point ``100.00``: they are computed in double precision, like the source
      definitions, instead of exact decimals.
    """

    name: str
    plus: tuple[str, ...]
    minus: tuple[str, ...] = ()
    per: str | None = None
    pct: bool = False
    double: bool = False


# The 33 derived KPIs, in their defined order.
KPIS = (
    Kpi("gross_margin_pct", ("total_sales_amt",), ("total_cogs",), "total_sales_amt", pct=True),
    Kpi("stores_gross_margin_amt", ("stores_sales_amt",), ("total_cogs_stores",)),
    Kpi("stores_gross_margin_pct", ("stores_sales_amt",), ("total_cogs_stores",), "stores_sales_amt", pct=True),
    Kpi("initial_markup_pct", ("all_promo_exc_ctgs",), ("all_cogs_exc_ctgs",), "all_promo_exc_ctgs", pct=True),
    Kpi("item_discount_pct", ("all_promo_exc_ctgs",), ("all_sales_exc_ctgs",), "all_promo_exc_ctgs", pct=True),
    Kpi("orders_with_discount_pct", ("discounted_cust_count",), (), "unique_cust_count", pct=True, double=True),
    Kpi("effective_margin_pct", ("total_sales_amt",), ("total_cogs", "total_financing_cost"), "total_sales_amt", pct=True),
    Kpi("financing_cost_pct", ("total_financing_cost",), (), "total_sales_amt", pct=True),
    Kpi("sales_per_guest", ("total_sales_amt",), (), "traffic"),
    Kpi("close_rate_pct", ("cust_count_exc_ctgs",), (), "traffic", pct=True, double=True),
    Kpi("avg_ticket_amt", ("sales_exc_ctgs",), (), "cust_count_exc_ctgs"),
    Kpi("items_per_ticket", ("qty_exc_ctgs",), (), "cust_count_exc_ctgs"),
    Kpi("avg_sales_price", ("sales_exc_ctgs",), (), "qty_exc_ctgs"),
    Kpi("carts_built_pct", ("carts_count",), (), "traffic", pct=True, double=True),
    Kpi("sales_per_hour", ("total_sales_amt",), (), "paid_hours"),
    Kpi("financed_sales_pct", ("total_financed_amt",), (), "total_sales_amt", pct=True),
    Kpi("avg_financed_ticket_amt", ("sales_financed",), (), "customers_financed"),
    Kpi("finance_application_pct", ("applications_count",), (), "traffic", pct=True, double=True),
    Kpi("furniture_spg", ("furniture_sales_amt",), (), "traffic"),
    Kpi("furniture_sph", ("furniture_sales_amt",), (), "paid_hours"),
    Kpi("furniture_sales_pct", ("furniture_sales_amt",), (), "total_sales_amt", pct=True),
    Kpi("furniture_gross_margin_pct", ("furniture_sales_amt",), ("furniture_cogs",), "furniture_sales_amt", pct=True),
    Kpi("bedding_spg", ("bedding_sales_amt",), (), "traffic"),
    Kpi("bedding_sph", ("bedding_sales_amt",), (), "paid_hours"),
    Kpi("bedding_sales_pct", ("bedding_sales_amt",), (), "total_sales_amt", pct=True),
    Kpi("bedding_gross_margin_pct", ("bedding_sales_amt",), ("bedding_cogs",), "bedding_sales_amt", pct=True),
    Kpi("protection_spg", ("protection_sales_amt",), (), "traffic"),
    Kpi("protection_sph", ("protection_sales_amt",), (), "paid_hours"),
    Kpi("protection_sales_pct", ("protection_sales_amt",), (), "total_sales_amt", pct=True),
    Kpi("delivery_spg", ("delivery_sales_amt",), (), "traffic"),
    Kpi("delivery_sales_pct", ("delivery_sales_amt",), (), "total_sales_amt", pct=True),
    Kpi("delivered_gross_margin_pct", ("sales_delivered",), ("cogs_delivered",), "sales_delivered", pct=True),
    Kpi("avg_days_to_deliver", ("weighted_days",), (), "qty_delivered"),
)

KPI_NAMES = tuple(k.name for k in KPIS)

# The KPIs stored as decimal(10,2) in the this-year contract (all
# other KPIs and all amounts are decimal(15,2)).
NARROW_KPIS = (
    "bedding_gross_margin_pct", "bedding_sales_pct", "carts_built_pct", "close_rate_pct",
    "delivered_gross_margin_pct", "delivery_sales_pct", "effective_margin_pct",
    "finance_application_pct", "financed_sales_pct", "financing_cost_pct",
    "furniture_gross_margin_pct", "furniture_sales_pct", "gross_margin_pct",
    "initial_markup_pct", "item_discount_pct", "orders_with_discount_pct",
    "protection_sales_pct", "stores_gross_margin_pct",
)

# The 48 measures compared with last year, in their defined order.
COMPARED_MEASURES = (
    "traffic", "total_sales_amt", "stores_sales_amt", "online_sales_amt", "omni_sales_amt",
    "cancelled_sales_amt", "gross_margin_pct", "stores_gross_margin_amt", "stores_gross_margin_pct",
    "initial_markup_pct", "item_discount_pct", "orders_with_discount_pct",
    "effective_margin_pct", "financing_cost_pct", "avg_ticket_amt", "items_per_ticket",
    "avg_sales_price", "close_rate_pct", "carts_built_pct", "sales_per_guest", "total_financed_amt",
    "financed_sales_pct", "avg_financed_ticket_amt", "finance_application_pct", "sales_per_hour",
    "bedding_sales_amt", "bedding_spg", "bedding_sph", "bedding_sales_pct", "bedding_gross_margin_pct",
    "bedding_financing_cost", "furniture_sales_amt", "furniture_spg", "furniture_sph",
    "furniture_sales_pct", "furniture_gross_margin_pct", "furniture_financing_cost",
    "protection_sales_amt", "protection_spg", "protection_sph", "protection_sales_pct",
    "delivery_sales_amt", "delivery_spg", "delivery_sales_pct", "sales_delivered",
    "avg_days_to_deliver", "delivered_gross_margin_pct", "bedding_sales_delivered",
)

# The metric catalogue of the transposed report as
# (label, source column, display order, color code).
CATALOGUE = (
    ("Total Sales (inc. Ecom and Omni)", "total_sales_amt", 1, "1"),
    ("Sales (Stores)", "stores_sales_amt", 2, "2"),
    ("Sales (Ecom)", "online_sales_amt", 3, "3"),
    ("Sales (Omni)", "omni_sales_amt", 4, "2"),
    ("Cancellations (inc. Ecom and Omni)", "cancelled_sales_amt", 5, "3"),
    ("Gross Margin % (inc. Ecom and Omni)", "gross_margin_pct", 6, "1"),
    ("Gross Margin (Stores)", "stores_gross_margin_amt", 7, "2"),
    ("Gross Margin % (Stores)", "stores_gross_margin_pct", 8, "3"),
    ("IMU", "initial_markup_pct", 9, "2"),
    ("Item Discount %", "item_discount_pct", 10, "3"),
    ("% Orders with Discount", "orders_with_discount_pct", 11, "2"),
    ("Effective Margin %", "effective_margin_pct", 12, "3"),
    ("Cost of Financing", "financing_cost_pct", 13, "2"),
    ("Sales per Guest", "sales_per_guest", 14, "1"),
    ("Traffic", "traffic", 15, "2"),
    ("Close Rate", "close_rate_pct", 16, "3"),
    ("Average Ticket", "avg_ticket_amt", 17, "2"),
    ("Items per Ticket", "items_per_ticket", 18, "3"),
    ("Average Selling Price", "avg_sales_price", 19, "2"),
    ("Carts Built", "carts_built_pct", 20, "3"),
    ("Sales per Hour", "sales_per_hour", 21, "2"),
    ("Financed Sales $", "total_financed_amt", 22, "1"),
    ("Finance % of Sales", "financed_sales_pct", 23, "2"),
    ("Finance Average Ticket", "avg_financed_ticket_amt", 24, "3"),
    ("Finance Apps to Traffic", "finance_application_pct", 25, "2"),
    ("Furniture Sales $", "furniture_sales_amt", 26, "1"),
    ("Furniture SPG", "furniture_spg", 27, "2"),
    ("Furniture % of sales", "furniture_sales_pct", 28, "3"),
    ("Furniture SPH", "furniture_sph", 29, "2"),
    ("Furniture GM %", "furniture_gross_margin_pct", 30, "3"),
    ("Furniture COF", "furniture_financing_cost", 31, "2"),
    ("Bedding Sales $", "bedding_sales_amt", 32, "1"),
    ("Bedding SPG", "bedding_spg", 33, "2"),
    ("Bedding % of Sales", "bedding_sales_pct", 34, "3"),
    ("Bedding SPH", "bedding_sph", 35, "2"),
    ("Bedding GM %", "bedding_gross_margin_pct", 36, "3"),
    ("Bedding COF", "bedding_financing_cost", 37, "2"),
    ("Protection Sales $", "protection_sales_amt", 38, "1"),
    ("Protection SPG", "protection_spg", 39, "2"),
    ("Protection % of Sales", "protection_sales_pct", 40, "3"),
    ("Protection SPH", "protection_sph", 41, "2"),
    ("Delivery Sales $", "delivery_sales_amt", 42, "1"),
    ("Delivery SPG", "delivery_spg", 43, "2"),
    ("Delivery % of sales", "delivery_sales_pct", 44, "3"),
    ("Total Sales Delivered", "sales_delivered", 45, "1"),
    ("Bedding Sales Delivered", "bedding_sales_delivered", 46, "2"),
    ("Gross Margin Delivered %", "delivered_gross_margin_pct", 47, "3"),
    ("Average Days to Deliver", "avg_days_to_deliver", 48, "2"),
)

# Profit-center codes of the two non-store channels.
ONLINE_PROFIT_CENTER = "444"
OMNI_PROFIT_CENTER = "445"

# Segment texts that mean "no region/market" (compared after trim).
BLANK_SEGMENTS = ("", "n/a")

# Calendar constants.  364 days keeps the weekday; the prior-year
# slice ends 365 days before the report date; the transposed report keeps 91 days.
LY_SHIFT_DAYS = 364
PAST_YEAR_CUTOFF_DAYS = 365
ROLLING_WINDOW_DAYS = 91

# Opening date assumed for a store with no known opening date.
DEFAULT_OPEN_DATE = "2020-01-01"

# The clamp applied to year-over-year percent changes.
GROWTH_LIMIT = 1000

PERIODS = ("daily", "week", "month", "year")
# Short name of each period as used in report table names.
PERIOD_TAG = {"daily": "daily", "week": "wtd", "month": "mtd", "year": "ytd"}


def period_column(period: str) -> str | None:
    """Name of the period-start column a period adds to its rows (None for daily)."""
    return None if period == "daily" else f"{period}_start"


def ty_measure_columns() -> tuple[str, ...]:
    """The 71 measure columns of a this-year frame: 38 additive + 33 KPIs."""
    return ADDITIVE_MEASURES + KPI_NAMES


def _check() -> None:
    assert len(ADDITIVE_MEASURES) == len(set(ADDITIVE_MEASURES)) == 38
    assert len(KPIS) == len(set(KPI_NAMES)) == 33
    assert len(COMPARED_MEASURES) == len(set(COMPARED_MEASURES)) == 48
    assert set(COMPARED_MEASURES) == {c for _, c, _, _ in CATALOGUE}
    assert set(COMPARED_MEASURES) <= set(ty_measure_columns())
    assert [o for _, _, o, _ in CATALOGUE] == list(range(1, 49))
    assert set(NARROW_KPIS) <= set(KPI_NAMES)
    assert set(COUNT_MEASURES) <= set(ADDITIVE_MEASURES)


_check()
