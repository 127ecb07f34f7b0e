"""T1-T3 and J4, the end-to-end job, and the driver entry points."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import base_row
from storepulse import metrics as M
from storepulse import registry, schemas
from storepulse.operators import combine, full_union, transpose
from storepulse.plans import Reports, date_literal, run_job

SMOKE = "/root/testdata/sf0.001"


def test_transpose_keeps_nulls_and_window(make_base):
    rows = [base_row("2024-03-04", bedding_sales_amt=None), base_row("2023-01-01")]
    wide = full_union(make_base(rows), "daily")
    long = transpose(wide, "daily_ty", date_literal("2024-03-10"))
    assert long.filter(F.col("report_date") < "2023-12-10").count() == 0
    store = long.filter(F.col("segment") == "S1")
    assert store.count() == 48
    bedding = store.filter(F.col("metric") == "Bedding Sales $").collect()[0]
    assert bedding.daily_ty is None and bedding.column_order == 32 and bedding.color == "1"
    assert dict(long.dtypes)["daily_ty"] == "decimal(21,2)"


def test_combine_null_segment_stays_apart(make_base):
    wide = full_union(make_base([base_row("2024-03-04", segment=None)]), "daily")
    frames = {"daily_ty": wide, "wtd_ty": wide}
    out = combine(frames, date_literal("2024-03-10"))
    nulls = out.filter(F.col("segment").isNull() & (F.col("metric") == "Traffic")).collect()
    # like a full outer join, a null key matches nothing: one row per frame
    assert len(nulls) == 2
    assert sorted((r.daily_ty is None, r.wtd_ty is None) for r in nulls) == [(False, True), (True, False)]


def test_combine_equals_full_join_chain(spark):
    r = Reports(*_inputs(spark), date_literal("2001-08-01"))
    frames = {f"{M.PERIOD_TAG[p]}_{v}": r.report(p, v) for p in ("daily", "week") for v in ("ty", "ly")}
    got = combine(frames, r.as_of)
    keys = ["report_date", "filter_level", "segment", "metric", "column_order", "color"]
    chain = None
    for name, df in frames.items():
        t = transpose(df, name, r.as_of)
        chain = t if chain is None else chain.join(t, keys, "full")
    cols = keys + list(frames)
    assert got.select(*cols).exceptAll(chain.select(*cols)).count() == 0
    assert chain.select(*cols).exceptAll(got.select(*cols)).count() == 0


def _full_joins(frames, as_of):
    """The twelve-way definition, literally: full joins on the six long keys."""
    keys = ["report_date", "filter_level", "segment", "metric", "column_order", "color"]
    chain = None
    for name, df in frames.items():
        t = transpose(df, name, as_of)
        chain = t if chain is None else chain.join(t, keys, "full")
    return chain.select(*keys, *frames)


def _same_rows(got, want):
    got = got.select(*want.columns)
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_combine_keeps_rows_that_repeat_a_key(make_base):
    day = date_literal("2024-03-10")
    two = make_base([base_row("2024-03-04", "A", segment="Retail", total_sales_amt=5),
                     base_row("2024-03-04", "B", segment="Retail", total_sales_amt=9),
                     base_row("2024-03-05", "C", total_sales_amt=3)])
    one = make_base([base_row("2024-03-04", "A", segment="Retail", total_sales_amt=7)])
    wide, other = full_union(two, "daily"), full_union(one, "daily")
    frames = {"daily_ty": wide, "wtd_ty": other, "mtd_ty": wide}
    got = combine(frames, day)
    sales = got.filter((F.col("segment") == "Retail") & (F.col("metric") == "Sales") & (F.col("filter_level") == "Store"))
    if sales.count():
        assert sales.count() == 4  # two rows by one row by two rows
    assert _same_rows(got, _full_joins(frames, day))


def test_combine_keeps_a_name_used_at_two_levels(make_base):
    """A region and a market both called East: two rows of one key where levels share their label."""
    base = make_base([base_row("2024-03-04", "A", region="East", market="East", total_sales_amt=5),
                      base_row("2023-03-06", "A", region="East", market="East", total_sales_amt=4)])
    wide = full_union(base, "daily")
    wide = wide.withColumn("filter_level", F.when(F.col("filter_level").isin("Region", "Market"), "Area").otherwise(F.col("filter_level")))
    frames = {"daily_ty": wide, "wtd_ty": wide}
    got = combine(frames, date_literal("2024-03-10"))
    east = got.filter((F.col("segment") == "East") & (F.col("metric") == "Traffic"))
    assert east.count() == 4
    assert _same_rows(got, _full_joins(frames, date_literal("2024-03-10")))


def test_combine_repeats_with_null_keys(make_base):
    base = make_base([base_row("2024-03-04", "A", segment=None), base_row("2024-03-04", "B", segment=None),
                      base_row("2024-03-04", "C", segment="x"), base_row("2024-03-04", "D", segment="x")])
    wide = full_union(base, "daily")
    frames = {"daily_ty": wide, "wtd_ty": wide}
    assert _same_rows(combine(frames, date_literal("2024-03-10")), _full_joins(frames, date_literal("2024-03-10")))


def _inputs(spark):
    from storepulse.sources import derive_report_base, derive_store_lookup
    return derive_report_base(spark, SMOKE).checkpoint(), derive_store_lookup(spark, SMOKE).checkpoint()


def test_run_job_writes_all_tables(spark):
    base, lookup = _inputs(spark)
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    timings = {}
    paths = run_job(spark, base, lookup, out, as_of="2001-08-01", timings=timings)
    assert len(paths) == 13 and set(paths) == set(timings)
    for name, path in paths.items():
        df = spark.read.parquet(path)
        if name.startswith(("ly_", "comp_")):
            assert df.schema == schemas.COMPARISON
        elif name == "combined_transposed_report":
            assert df.schema == schemas.TRANSPOSED
        else:
            period = {"daily": "daily", "wtd": "week", "mtd": "month", "ytd": "year"}[name.split("_")[0]]
            assert df.schema == schemas.ty_contract(period)
    # every written table equals the report built directly from the inputs
    direct = Reports(base, lookup, date_literal("2001-08-01"))
    for p in M.PERIODS:
        for v in ("ty", "ly", "comp"):
            written = spark.read.parquet(paths[f"{v}_{M.PERIOD_TAG[p]}_report" if v != "ty"
                                               else f"{M.PERIOD_TAG[p]}_report"])
            want = direct.conformed(p, v)
            assert written.exceptAll(want).count() == 0 and want.exceptAll(written).count() == 0, (p, v)
    written = spark.read.parquet(paths["combined_transposed_report"])
    want = direct.combined()
    assert written.exceptAll(want).count() == 0 and want.exceptAll(written).count() == 0
    assert os.path.isdir(out)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.COMPARISON]
    assert df.count() > 0
    assert set(registry.QUERIES) <= set(E.queries()) and set(registry.QUERIES) <= set(E.oracle_sql())


def test_tiny_values_round_trip(make_base):
    from storepulse.functions import with_kpis
    r = with_kpis(make_base([base_row("2024-03-04", traffic=3, total_sales_amt="0.01")])).collect()[0]
    assert r.sales_per_guest == Decimal("0.00")
    assert dt.date(2024, 3, 4) == r.report_date


def test_wide_report_keys_are_unique(spark):
    """The union-based long table relies on unique (date, level, segment)."""
    from storepulse.checks import duplicate_keys, ly_date_offsets
    base, lookup = _inputs(spark)
    assert ly_date_offsets(base) == 0
    r = Reports(base, lookup, date_literal("2001-08-01"))
    for p in ("daily", "month"):
        for v in ("ty", "comp"):
            assert duplicate_keys(r.report(p, v), ["report_date", "filter_level", "segment"]) == 0, (p, v)
