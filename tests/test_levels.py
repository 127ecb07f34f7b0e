"""Level rollups (A1-A10), filters (F1-F4) and the seven-level stack."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import base_row
from storepulse import metrics as M
from storepulse.operators import full_union, rollup_levels, with_open_date


def seg(df, segment):
    return [r for r in df.collect() if r.segment == segment]


def test_null_profit_center_only_in_total(make_base):
    rows = [base_row("2024-03-04", "S1", profit_center=None, total_sales_amt=7),
            base_row("2024-03-04", "S2", total_sales_amt=3)]
    out = rollup_levels(make_base(rows), "daily")
    assert seg(out, "Total")[0].total_sales_amt == Decimal("10.00")
    assert seg(out, "Stores")[0].total_sales_amt == Decimal("3.00")
    assert not seg(out, "Online") and not seg(out, "Omni")


def test_channels(make_base):
    rows = [base_row("2024-03-04", "S1", total_sales_amt=1),
            base_row("2024-03-04", "W", profit_center=M.ONLINE_PROFIT_CENTER, total_sales_amt=2),
            base_row("2024-03-04", "O", profit_center=M.OMNI_PROFIT_CENTER, total_sales_amt=4)]
    out = rollup_levels(make_base(rows), "daily")
    got = {r.segment: r.total_sales_amt for r in out.filter(F.col("filter_level") == "Aggregated").collect()}
    assert got == {"Total": Decimal("7.00"), "Stores": Decimal("1.00"),
                   "Online": Decimal("2.00"), "Omni": Decimal("4.00")}


def test_region_text_rules(make_base):
    names = ["East", "East ", "N/A", "n/a", " ", None]
    rows = [base_row("2024-03-04", f"S{i}", region=r, total_sales_amt=1) for i, r in enumerate(names)]
    out = rollup_levels(make_base(rows), "daily").filter(F.col("filter_level") == "Region")
    got = sorted(r.segment for r in out.collect())
    assert got == ["East", "East ", "N/A"]
    row = seg(out, "East")[0]
    assert row.region == "East" and row.market is None and row.custom_key == "2024-03-04;East"


def test_labels(make_base):
    out = rollup_levels(make_base([base_row("2024-03-04")]), "daily")
    total = seg(out, "Total")[0]
    assert (total.filter_level, total.custom_key, total.app_key, total.store_name) == \
        ("Aggregated", "2024-03-04;total", None, None)
    market = [r for r in out.collect() if r.filter_level == "Market"][0]
    assert market.segment == "M1" and market.market == "M1" and market.region is None


def test_comp_mask_zero_and_null(make_base, make_lookup):
    closed = dt.date(2030, 1, 1)
    lk = make_lookup([(1, 101, closed), (2, 102, None)])
    rows = [base_row("2024-03-04", "S1", total_sales_amt=5, bedding_sales_amt=None)]
    out = rollup_levels(with_open_date(make_base(rows), lk), "daily", comp=True)
    total = seg(out, "Total")[0]
    assert total.total_sales_amt == Decimal("0.00")  # all rows masked -> 0
    # an open store whose values are all null keeps null
    rows = [base_row("2024-03-04", "S1", app_key=2, profit_center="102", bedding_sales_amt=None)]
    lk2 = make_lookup([(2, 102, dt.date(2000, 1, 1))])
    out = rollup_levels(with_open_date(make_base(rows), lk2), "daily", comp=True)
    assert seg(out, "Total")[0].bedding_sales_amt is None


def test_lookup_miss_and_non_numeric(make_base, make_lookup):
    lk = make_lookup([(1, 101, dt.date(2001, 1, 1))])
    rows = [base_row("2024-03-04", "S1"),
            base_row("2024-03-04", "S2", app_key=9, profit_center="109"),
            base_row("2024-03-04", "S3", profit_center="N/A")]
    got = {r.store_name: r.store_open_date for r in with_open_date(make_base(rows), lk).collect()}
    assert got == {"S1": dt.date(2001, 1, 1), "S2": dt.date(2020, 1, 1), "S3": dt.date(2020, 1, 1)}


def test_full_union_shape(make_base):
    rows = [base_row("2024-03-04", "S1", total_sales_amt=1), base_row("2024-03-05", "S1", total_sales_amt=2)]
    out = full_union(make_base(rows), "daily")
    assert out.columns == list(M.KEY_COLUMNS) + list(M.ADDITIVE_MEASURES) + list(M.KPI_NAMES)
    # per date: 1 store row + Total + Stores + Region + Market
    assert out.count() == 2 * 5


def test_one_pass_equals_branch_per_level(spark):
    """The explode-based rollup equals one filtered groupBy per level."""
    from storepulse.sources import derive_report_base
    base = derive_report_base(spark, "/root/testdata/sf0.001")
    one_pass = rollup_levels(base, "daily").select("report_date", "filter_level", "segment", "total_sales_amt")
    keys = ["report_date", "ly_date"]
    branches = []
    for name, cond in [("Total", F.lit(True)), ("Stores", ~F.col("profit_center").isin("444", "445")),
                       ("Online", F.col("profit_center") == "444"), ("Omni", F.col("profit_center") == "445")]:
        branches.append(base.filter(cond).groupBy(*keys).agg(F.sum("total_sales_amt").alias("total_sales_amt"))
                        .select("report_date", F.lit("Aggregated").alias("filter_level"),
                                F.lit(name).alias("segment"), "total_sales_amt"))
    for col in ("region", "market"):
        branches.append(base.filter(~F.trim(col).isin("", "n/a")).groupBy(*keys, col)
                        .agg(F.sum("total_sales_amt").alias("total_sales_amt"))
                        .select("report_date", F.lit(col.title()).alias("filter_level"),
                                F.col(col).alias("segment"), "total_sales_amt"))
    union = branches[0]
    for b in branches[1:]:
        union = union.unionByName(b)
    assert one_pass.exceptAll(union).count() == 0
    assert union.exceptAll(one_pass).count() == 0
