"""One store-day worked out by hand: all 33 KPIs and all 48 changes, written without the metric tables."""

from decimal import Decimal

from conftest import base_row
from storepulse.functions import with_kpis
from storepulse.operators import full_union
from storepulse.operators.compare import compare_last_year

AMOUNTS = dict(
    total_sales_amt=1000, stores_sales_amt=800, online_sales_amt=150, omni_sales_amt=50, total_cogs=600, total_cogs_stores=500,
    bedding_sales_amt=200, protection_sales_amt=50, furniture_sales_amt=300, furniture_cogs=180, bedding_cogs=90,
    furniture_financing_cost=12, bedding_financing_cost=8, delivery_sales_amt=60, cancelled_sales_amt=20, sales_financed=400,
    total_financed_amt=240, total_financing_cost=30, all_sales_exc_ctgs=900, all_cogs_exc_ctgs=700, all_promo_exc_ctgs=1250,
    sales_exc_ctgs=910, sales_delivered=700, cogs_delivered=420, bedding_sales_delivered=90)
OTHERS = dict(
    traffic=8, carts_count=5, applications_count=2, paid_hours=40, customers_financed=3, unique_cust_count=16,
    discounted_cust_count=6, cust_count_exc_ctgs=7, qty_exc_ctgs=13, qty_delivered=9, weighted_days=40)

KPIS = {
    "gross_margin_pct": "40", "stores_gross_margin_amt": "300", "stores_gross_margin_pct": "37.5", "initial_markup_pct": "44",
    "item_discount_pct": "28", "orders_with_discount_pct": "37.5", "effective_margin_pct": "37", "financing_cost_pct": "3",
    "sales_per_guest": "125", "close_rate_pct": "87.5", "avg_ticket_amt": "130", "items_per_ticket": "1.86",
    "avg_sales_price": "70", "carts_built_pct": "62.5", "sales_per_hour": "25", "financed_sales_pct": "24",
    "avg_financed_ticket_amt": "133.33", "finance_application_pct": "25", "furniture_spg": "37.5", "furniture_sph": "7.5",
    "furniture_sales_pct": "30", "furniture_gross_margin_pct": "40", "bedding_spg": "25", "bedding_sph": "5",
    "bedding_sales_pct": "20", "bedding_gross_margin_pct": "55", "protection_spg": "6.25", "protection_sph": "1.25",
    "protection_sales_pct": "5", "delivery_spg": "7.5", "delivery_sales_pct": "6", "delivered_gross_margin_pct": "40",
    "avg_days_to_deliver": "4.44",
}

# Against a year with half the amounts and all else equal.  Half of 6.25 is 3.13 and of 1.25 is 0.63
# after rounding, and 400 / 3 against 200 / 3 is 133.33 against 66.67.
CHANGES = {
    "traffic": "0", "total_sales_amt": "100", "stores_sales_amt": "100", "online_sales_amt": "100", "omni_sales_amt": "100",
    "cancelled_sales_amt": "100", "gross_margin_pct": "0", "stores_gross_margin_amt": "100", "stores_gross_margin_pct": "0",
    "initial_markup_pct": "0", "item_discount_pct": "0", "orders_with_discount_pct": "0", "effective_margin_pct": "0",
    "financing_cost_pct": "0", "avg_ticket_amt": "100", "items_per_ticket": "0", "avg_sales_price": "100", "close_rate_pct": "0",
    "carts_built_pct": "0", "sales_per_guest": "100", "total_financed_amt": "100", "financed_sales_pct": "0",
    "avg_financed_ticket_amt": "99.99", "finance_application_pct": "0", "sales_per_hour": "100", "bedding_sales_amt": "100",
    "bedding_spg": "100", "bedding_sph": "100", "bedding_sales_pct": "0", "bedding_gross_margin_pct": "0",
    "bedding_financing_cost": "100", "furniture_sales_amt": "100", "furniture_spg": "100", "furniture_sph": "100",
    "furniture_sales_pct": "0", "furniture_gross_margin_pct": "0", "furniture_financing_cost": "100", "protection_sales_amt": "100",
    "protection_spg": "99.68", "protection_sph": "98.41", "protection_sales_pct": "0", "delivery_sales_amt": "100",
    "delivery_spg": "100", "delivery_sales_pct": "0", "sales_delivered": "100", "avg_days_to_deliver": "0",
    "delivered_gross_margin_pct": "0", "bedding_sales_delivered": "100",
}


def test_33_kpis(make_base):
    row = with_kpis(make_base([base_row("2024-03-04", **AMOUNTS, **OTHERS)])).collect()[0]
    assert len(KPIS) == 33
    assert {k: Decimal(str(row[k])) for k in KPIS} == {k: Decimal(v) for k, v in KPIS.items()}


def test_48_changes(make_base):
    half = {k: Decimal(v) / 2 for k, v in AMOUNTS.items()}
    base = make_base([base_row("2024-03-04", **AMOUNTS, **OTHERS), base_row("2023-03-06", **half, **OTHERS)])
    rows = compare_last_year(full_union(base, "daily")).where("segment = 'S1' AND report_date = '2024-03-04'").collect()
    assert len(rows) == 1 and len(CHANGES) == 48
    assert {k: Decimal(str(rows[0][k])) for k in CHANGES} == {k: Decimal(v) for k, v in CHANGES.items()}
