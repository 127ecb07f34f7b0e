"""Golden rows for the KPI (P1, M1-M33) and growth (G1-G2) rules."""

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import base_row
from storepulse import metrics as M
from storepulse.functions import growth, with_kpis


def kpis_of(make_base, **values):
    df = with_kpis(make_base([base_row("2024-03-04", **values)]))
    return df.collect()[0]


def test_zero_denominator_gives_zero(make_base):
    r = kpis_of(make_base, total_sales_amt=0, total_cogs=5)
    assert r.gross_margin_pct == 0


def test_null_denominator_gives_null(make_base):
    r = kpis_of(make_base, traffic=None, total_sales_amt=10)
    assert r.sales_per_guest is None
    assert r.close_rate_pct is None


def test_tie_rounds_half_up(make_base):
    # 10.70 / 4 = 2.675 exactly -> 2.68
    r = kpis_of(make_base, traffic=4, total_sales_amt="10.70")
    assert r.sales_per_guest == Decimal("2.68")
    # negative tie rounds away from zero
    r = kpis_of(make_base, traffic=4, total_sales_amt="-10.70")
    assert r.sales_per_guest == Decimal("-2.68")


def test_margin_and_difference(make_base):
    r = kpis_of(make_base, total_sales_amt="200.00", total_cogs="150.00", total_financing_cost="5.00",
                stores_sales_amt="10.00", total_cogs_stores="12.50")
    assert r.gross_margin_pct == Decimal("25.00")
    assert r.effective_margin_pct == Decimal("22.50")
    assert r.stores_gross_margin_amt == Decimal("-2.50")


def test_count_ratios_are_doubles(make_base):
    df = with_kpis(make_base([base_row("2024-03-04", traffic=3, cust_count_exc_ctgs=1)]))
    types = dict(df.dtypes)
    for k in M.KPIS:
        if k.double:
            assert types[k.name] == "double"
    assert df.collect()[0].close_rate_pct == 33.33


def _growth(spark, pairs, dtype=T.DecimalType(15, 2)):
    schema = T.StructType([T.StructField("a", dtype), T.StructField("b", dtype)])
    df = spark.createDataFrame(pairs, schema)
    return [r[0] for r in df.select(growth("a", "b", dtype)).collect()]


def test_growth_null_cases(spark):
    D = Decimal
    assert _growth(spark, [(D("5"), D("0")), (D("5"), None), (None, D("5"))]) == [None, None, None]


def test_growth_clamp_and_sign(spark):
    D = Decimal
    out = _growth(spark, [(D("99999"), D("1")), (D("10"), D("-5")), (D("-99999"), D("1")), (D("11"), D("10"))])
    assert out == [D("1000.00"), D("-300.00"), D("-1000.00"), D("10.00")]


def test_growth_on_counts_is_double(spark):
    out = _growth(spark, [(3, 2), (1, 3)], T.LongType())
    assert out == [50.0, -66.67]


def test_kpi_is_ratio_of_sums(make_base):
    from storepulse.operators import rollup_levels
    rows = [base_row("2024-03-04", "S1", traffic=1, total_sales_amt="10.00"),
            base_row("2024-03-04", "S2", traffic=3, total_sales_amt="2.00")]
    total = with_kpis(rollup_levels(make_base(rows), "daily").filter(F.col("segment") == "Total"))
    # (10 + 2) / (1 + 3) = 3.00, not the mean of 10.00 and 0.67
    assert total.collect()[0].sales_per_guest == Decimal("3.00")
