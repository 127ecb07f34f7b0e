"""What keeps a refresh safe and a hot key, level or folder from becoming one task's work."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import base_row
from storepulse import schemas
from storepulse.checks import has_nameless
from storepulse.operators.levels import full_union, rollup_levels
from storepulse.operators.periods import PARTS, period_to_date
from storepulse.operators.transpose import combine, combine_packed, combine_unique, pack
from storepulse.plans.reports import date_literal
from storepulse.sinks import write_report
from storepulse.sources import read_report_base, read_store_lookup


# ---- K1, K7

@pytest.fixture
def refresh(spark, make_lookup, tmp_path):
    """(write rows, read rows) for a folder and a table; a null opening date makes the write fail in a task."""
    contract = T.StructType([*schemas.STORE_LOOKUP.fields, T.StructField("report_date", T.DateType())])

    def writer(**where):
        def write(rows, fail=False):
            df = make_lookup(rows).withColumn("report_date", F.lit("2024-03-04").cast("date"))
            if fail:
                df = df.withColumn("app_key", F.raise_error(F.lit("lost")).cast("long"))
            write_report(df, contract, **where)
        return write

    return writer, str(tmp_path)


def test_a_failed_refresh_leaves_the_folder(spark, refresh, tmp_path):
    writer, root = refresh
    write = writer(path=f"{root}/t")
    write([(1, 2, None)])
    with pytest.raises(Exception, match="lost"):
        write([(9, 9, None)], fail=True)
    assert [r.app_key for r in spark.read.parquet(f"{root}/t").collect()] == [1]
    write([(3, 4, None), (5, 6, None)])
    assert sorted(r.app_key for r in spark.read.parquet(f"{root}/t").collect()) == [3, 5]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]  # nothing is left aside


def test_a_failed_switch_is_undone(spark, refresh, tmp_path, monkeypatch):
    from storepulse.sinks import writer as w
    writer, root = refresh
    write = writer(path=f"{root}/t")
    write([(1, 2, None)])
    real = w._rename
    monkeypatch.setattr(w, "_rename", lambda s, a, b: (_ for _ in ()).throw(OSError("no")) if "__new_" in a else real(s, a, b))
    with pytest.raises(OSError, match="no"):
        write([(9, 9, None)])
    assert [r.app_key for r in spark.read.parquet(f"{root}/t").collect()] == [1]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_failed_refresh_leaves_the_table(spark, refresh):
    spark.sql("CREATE DATABASE IF NOT EXISTS refreshed")
    write = refresh[0](table="refreshed.t")
    write([(1, 2, None)])
    with pytest.raises(Exception, match="lost"):
        write([(9, 9, None)], fail=True)
    assert [r.app_key for r in spark.table("refreshed.t").collect()] == [1]
    write([(3, 4, None)])
    assert [r.app_key for r in spark.table("refreshed.t").collect()] == [3]
    assert [t.name for t in spark.catalog.listTables("refreshed")] == ["t"]


# ---- S2, S3

def test_a_folder_of_mixed_files_is_refused(spark, make_lookup, make_base, tmp_path):
    lookup = make_lookup([(1, 101, None)])
    lookup.write.parquet(f"{tmp_path}/l")
    lookup.coalesce(1).write.mode("append").parquet(f"{tmp_path}/l")
    assert read_store_lookup(spark, f"{tmp_path}/l").count() == 2
    lookup.drop("grand_open_date").write.mode("append").parquet(f"{tmp_path}/l")
    with pytest.raises(ValueError, match="store lookup: .*grand_open_date.*no such column"):
        read_store_lookup(spark, f"{tmp_path}/l")
    base = make_base([base_row("2024-03-04")])
    base.write.parquet(f"{tmp_path}/a b=%/base")  # a path that is written otherwise in a URI
    assert read_report_base(spark, f"{tmp_path}/a b=%/base").count() == 1
    base.withColumn("app_key", F.col("app_key").cast("int")).write.mode("append").parquet(f"{tmp_path}/a b=%/base")
    with pytest.raises(ValueError, match="app_key"):
        read_report_base(spark, f"{tmp_path}/a b=%/base")


def test_a_task_of_the_derivation_holds_no_more_as_tables_grow(spark, monkeypatch):
    """Lines and orders are dealt by what their tables hold, not by the session's few shuffle partitions."""
    import re

    from storepulse.sources import fixtures
    few = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        want = fixtures.derive_report_base(spark, "/root/testdata/sf0.001")
        rows = want.collect()
        monkeypatch.setattr(fixtures, "TASK_ROWS", 500)
        for in_memory in (fixtures.PARTS_IN_MEMORY, 10):  # part is broadcast, or dealt like the lines
            monkeypatch.setattr(fixtures, "PARTS_IN_MEMORY", in_memory)
            got = fixtures.derive_report_base(spark, "/root/testdata/sf0.001")
            plan = got._jdf.queryExecution().executedPlan().toString()
            for key in ["l_orderkey", "o_orderkey", "o_custkey", "c_custkey"] + ["l_partkey", "p_partkey"] * (in_memory == 10):
                tasks = [int(n) for n in re.findall(rf"Exchange hashpartitioning\({key}#\d+L, (\d+)\)", plan)]
                assert tasks and min(tasks) >= 12, (key, plan)
            assert sorted(map(str, got.collect())) == sorted(map(str, rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)


def test_conditional_sums_add_up_only_what_counts(spark):
    """0 where nothing counts, null where all rows count and have no value; rows that don't count are not added."""
    from storepulse.sources.fixtures import _sum_if
    rows = [(g, c, None if v is None else Decimal(v)) for g, of in enumerate([
        [(True, 5), (False, 7), (None, 9)], [(False, 5), (None, None)], [(True, None), (True, None)],
        [(True, None), (False, 3)], [(True, None), (None, 3)], [(None, None)], [(True, 2), (True, None)]]) for c, v in of]
    df = spark.createDataFrame(rows, "g int, c boolean, v decimal(21,4)")
    got = df.groupBy("g").agg(F.expr(_sum_if("c", "v")).alias("a"), F.expr(_sum_if("c", "v", nullable=True)).alias("b"))
    want = df.groupBy("g").agg(F.expr("sum(CASE WHEN c THEN v ELSE 0 END)").alias("a"), F.expr("sum(CASE WHEN c THEN v END)").alias("b"))
    assert got.dtypes == want.dtypes and sorted(got.collect()) == sorted(want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FILTER (WHERE c#") >= 2 and "ELSE 0.0000" not in plan


# ---- W1-W5

def test_rows_without_a_name_are_summed_in_many_tasks(spark, make_base):
    day = lambda k: str(dt.date(2024, 3, 1) + dt.timedelta(days=k % 12))
    rows = [base_row(day(k), None, total_sales_amt=k + 1, traffic=None if k < 24 else 1) for k in range(300)]
    rows += [base_row(day(k), "A", total_sales_amt=2) for k in range(12)]
    base = make_base(rows)
    assert has_nameless(base) and not has_nameless(base.where("store_name IS NOT NULL"))
    out = period_to_date(base, "month")
    got = defaultdict(list)
    for r in out.where("store_name IS NULL").collect():
        got[r.report_date].append(r)
    total, traffic = Decimal(0), 0
    for when in sorted(got):
        own = [r["total_sales_amt"] for r in rows if r["store_name"] is None and r["report_date"] == when]
        # the running sums of a date end at the sum of all rows so far, and each step is one of its rows
        values = sorted(r["total_sales_amt"] for r in got[when])
        assert sorted(b - a for a, b in zip([total, *values], values)) == sorted(own)
        total += sum(own)
        traffic += sum(r["traffic"] or 0 for r in rows if r["store_name"] is None and r["report_date"] == when)
        assert values[-1] == total and max(r["traffic"] or 0 for r in got[when]) == traffic
    named = out.where("store_name = 'A'").orderBy("report_date").collect()
    assert [int(r["total_sales_amt"]) for r in named] == [2 * k for k in range(1, 13)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = out.where("store_name IS NULL").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert PARTS > 8 and tasks > 4


# ---- A1

def test_levels_are_tagged_after_a_first_sum(spark, make_base):
    """What is exploded are the groups of (channel, region, market), not the store rows."""
    rows = [base_row("2024-03-04", f"S{k}", region=f"R{k % 2}", market=f"M{k % 4}", profit_center=str(100 + k), total_sales_amt=k)
            for k in range(200)]
    out = rollup_levels(make_base(rows), "daily")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("Aggregate")  # an aggregation below the explode, as plans print upside down
    assert {r.segment: int(r.total_sales_amt) for r in out.where("filter_level = 'Market'").collect()} == {
        f"M{m}": sum(k for k in range(200) if k % 4 == m) for m in range(4)}
    out.write.format("noop").mode("overwrite").save()
    grouped = make_base(rows).groupBy("region", "market").count().count()
    assert grouped == 4


# ---- J4

def test_the_long_table_is_gathered_without_sorting(make_base):
    base = make_base([base_row("2024-03-04", s, total_sales_amt=k) for k, s in enumerate("ABC")])
    wide = full_union(base, "daily")
    frames = {"daily_ty": wide, "wtd_ty": wide.where("segment != 'B'"), "mtd_ty": wide.where("segment != 'C'")}
    got = combine(frames, date_literal("2024-03-10"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" in plan
    names = list(frames)
    packed = pack(wide, 0, names[0])
    for i, n in enumerate(names[1:], 1):
        packed = packed.unionByName(pack(frames[n], i, n))
    one, other = combine_unique(packed, names), combine_packed(packed, names)
    assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0 and one.count() > 0
