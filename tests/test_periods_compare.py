"""Period-to-date windows (W1-W5), shifted slice (S4), comparisons."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import base_row
from storepulse import metrics as M
from storepulse.operators import compare_last_year, full_union, past_year_slice, period_to_date
from storepulse.plans import Reports, date_literal


def test_running_sum_skips_nulls(make_base):
    rows = [base_row("2024-03-04", bedding_sales_amt=None), base_row("2024-03-05", bedding_sales_amt=2),
            base_row("2024-03-06", bedding_sales_amt=None)]
    out = period_to_date(make_base(rows), "month").orderBy("report_date").collect()
    assert [r.bedding_sales_amt for r in out] == [None, Decimal("2.00"), Decimal("2.00")]


def test_week_starts_monday(make_base):
    rows = [base_row("2024-03-03"), base_row("2024-03-04")]
    out = period_to_date(make_base(rows), "week").orderBy("report_date").collect()
    assert [r.week_start for r in out] == [dt.date(2024, 2, 26), dt.date(2024, 3, 4)]


def test_running_sum_resets_each_period(make_base):
    rows = [base_row("2024-01-30", total_sales_amt=1), base_row("2024-01-31", total_sales_amt=2),
            base_row("2024-02-01", total_sales_amt=4)]
    out = period_to_date(make_base(rows), "month").orderBy("report_date").collect()
    assert [r.total_sales_amt for r in out] == [Decimal("1.00"), Decimal("3.00"), Decimal("4.00")]


def test_gap_drops_store_from_total(make_base):
    rows = [base_row("2024-03-04", "S1", total_sales_amt=1), base_row("2024-03-04", "S2", total_sales_amt=2),
            base_row("2024-03-05", "S1", total_sales_amt=4)]
    out = full_union(period_to_date(make_base(rows), "month"), "month")
    totals = {r.report_date: r.total_sales_amt for r in out.filter(F.col("segment") == "Total").collect()}
    # S2 has no row on the 5th, so its month-to-date sum is not in the 5th's Total
    assert totals == {dt.date(2024, 3, 4): Decimal("3.00"), dt.date(2024, 3, 5): Decimal("5.00")}


def test_shifted_month_uses_ny_date(make_base):
    # 2023-03-01 + 364 = 2024-02-28 (February), 2023-03-02 + 364 = 2024-02-29
    rows = [base_row("2023-03-01", total_sales_amt=1), base_row("2023-03-02", total_sales_amt=2)]
    sliced = past_year_slice(make_base(rows), date_literal("2024-03-10"))
    out = period_to_date(sliced, "month", "ny_date").orderBy("report_date").collect()
    assert [r.month_start for r in out] == [dt.date(2024, 2, 1)] * 2
    assert [r.total_sales_amt for r in out] == [Decimal("1.00"), Decimal("3.00")]


def test_past_year_cutoff(make_base):
    # 2024-03-10 - 365 days = 2023-03-11 (2024 is a leap year)
    rows = [base_row("2023-03-11"), base_row("2023-03-12")]
    out = past_year_slice(make_base(rows), date_literal("2024-03-10")).collect()
    assert [r.report_date for r in out] == [dt.date(2023, 3, 11)]
    assert out[0].ny_date == dt.date(2024, 3, 9)


def test_self_match_on_ly_date(make_base):
    rows = [base_row("2023-03-06", traffic=10, total_sales_amt=100),
            base_row("2024-03-04", traffic=15, total_sales_amt=50)]
    out = compare_last_year(full_union(make_base(rows), "daily"))
    assert out.columns == list(M.COMPARE_KEY_COLUMNS) + list(M.COMPARED_MEASURES)
    store = [r for r in out.collect() if r.segment == "S1" and r.report_date == dt.date(2024, 3, 4)][0]
    assert store.traffic == 50.0 and store.total_sales_amt == Decimal("-50.00")
    old = [r for r in out.collect() if r.segment == "S1" and r.report_date == dt.date(2023, 3, 6)][0]
    assert old.traffic is None  # no row a year before: left join keeps the row


def test_same_name_on_two_levels_matches_across(make_base):
    rows = [base_row("2023-03-06", region="East", market="East", total_sales_amt=1),
            base_row("2024-03-04", region="East", market="East", total_sales_amt=2)]
    out = compare_last_year(full_union(make_base(rows), "daily"))
    east = [r for r in out.collect() if r.segment == "East" and r.report_date == dt.date(2024, 3, 4)]
    assert len(east) == 4  # each of the two rows meets both last-year rows


def test_comp_store_rows_equal_ly(make_base, make_lookup):
    lk = make_lookup([(1, 101, dt.date(2024, 1, 1))])  # opened after the last-year date
    rows = [base_row("2023-03-06", total_sales_amt=100), base_row("2024-03-04", total_sales_amt=50)]
    r = Reports(make_base(rows), lk, date_literal("2024-03-10"))
    ly = {(x.report_date, x.segment): x.total_sales_amt for x in r.ly("daily").collect()}
    comp = {(x.report_date, x.segment): x.total_sales_amt for x in r.comp("daily").collect()}
    key = (dt.date(2024, 3, 4), "S1")
    assert ly[key] == comp[key] == Decimal("-50.00")
    # the Total rollup is masked in comp: the store was not open on ly_date
    assert comp[(dt.date(2024, 3, 4), "Total")] is None  # masked sums are 0 -> LY 0 -> null
