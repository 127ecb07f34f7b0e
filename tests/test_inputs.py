"""Readers that check what they read, the checkpoint folder, and the caller's cache."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import base_row
from storepulse import schemas
from storepulse.operators import full_union, since
from storepulse.plans import run_job
from storepulse.session import ensure_checkpoint_dir
from storepulse.sinks import read_report, write_report
from storepulse.sources import read_report_base, read_store_lookup


@pytest.fixture
def base(make_base):
    return make_base([base_row("2024-03-04", "A", total_sales_amt=5), base_row("2023-03-06", "A", total_sales_amt=4)])


def test_readers_take_paths_and_tables(spark, base, make_lookup, tmp_path):
    base.write.parquet(f"{tmp_path}/base")
    lookup = make_lookup([(1, 101, None)])
    lookup.write.parquet(f"{tmp_path}/lookup")
    base.createOrReplaceTempView("daily_report_base")
    lookup.createOrReplaceTempView("store_lookup")
    for got in (read_report_base(spark, f"{tmp_path}/base"), read_report_base(spark, table="daily_report_base")):
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schemas.REPORT_BASE]
        assert got.exceptAll(base).count() == 0 and got.count() == 2
    for got in (read_store_lookup(spark, f"{tmp_path}/lookup"), read_store_lookup(spark, table="store_lookup")):
        assert got.collect() == lookup.collect()
    with pytest.raises(ValueError, match="either"):
        read_report_base(spark)


@pytest.mark.parametrize("change,message", [
    (lambda df: df.drop("total_sales_amt"), "missing total_sales_amt"),
    (lambda df: df.withColumnRenamed("traffic", "visits"), "missing traffic"),
    (lambda df: df.withColumn("total_sales_amt", F.col("total_sales_amt").cast("double")), "total_sales_amt is double"),
    (lambda df: df.withColumn("report_date", F.col("report_date").cast("string")), "report_date is string"),
])
def test_readers_refuse_other_schemas(spark, base, tmp_path, change, message):
    change(base).write.parquet(f"{tmp_path}/base")
    change(base).createOrReplaceTempView("changed_base")
    with pytest.raises(ValueError, match=message):
        read_report_base(spark, f"{tmp_path}/base")
    with pytest.raises(ValueError, match=message):
        read_report_base(spark, table="changed_base")


def test_extra_columns_are_left_out(spark, base, tmp_path):
    base.withColumn("note", F.lit("x")).write.parquet(f"{tmp_path}/base")
    assert "note" not in read_report_base(spark, f"{tmp_path}/base").columns


def _session(folder, in_use=None):
    """A stand-in for a session with or without the setting."""
    have = SimpleNamespace(isDefined=lambda: in_use is not None, get=lambda: in_use)
    sc = SimpleNamespace(set_to=[], _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: have)))
    sc.setCheckpointDir = sc.set_to.append
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder or default), sparkContext=sc)


def test_checkpoint_folder_is_never_made_up(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_session(None))
    given = _session("hdfs:///checkpoints")
    assert ensure_checkpoint_dir(given) == "hdfs:///checkpoints" and given.sparkContext.set_to == ["hdfs:///checkpoints"]
    assert ensure_checkpoint_dir(_session(None, "hdfs:///set")) == "hdfs:///set"
    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")  # set at build time
    assert spark.range(3).checkpoint().count() == 3


def test_run_job_leaves_the_callers_cache(spark, base, make_lookup, tmp_path):
    base.persist()
    base.count()
    run_job(spark, base, make_lookup([(1, 101, None)]), str(tmp_path), as_of="2024-03-10", periods=("daily",))
    assert base.storageLevel.useMemory
    base.unpersist()


def test_run_job_writes_tables_and_refreshes_them(spark, make_base, make_lookup):
    spark.sql("CREATE DATABASE IF NOT EXISTS reports")
    lookup = make_lookup([(1, 101, None)])
    for sales in (5, 7):  # the second run replaces the first one's rows
        base = make_base([base_row("2024-03-04", "A", total_sales_amt=sales)])
        names = run_job(spark, base, lookup, database="reports", as_of="2024-03-10", periods=("daily",))
        assert names["daily_report"] == "reports.daily_report"
        got = spark.table("reports.daily_report")
        assert got.schema == schemas.ty_contract("daily")
        assert {int(r["total_sales_amt"]) for r in got.where("segment = 'A'").collect()} <= {sales}
        assert {int(r["total_sales_amt"]) for r in got.where("segment = 'Total'").collect()} == {sales}
    with pytest.raises(ValueError, match="either a folder or a database"):
        run_job(spark, base, lookup)


def test_month_layout_reads_only_its_months(spark, make_base, tmp_path):
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 13) for d in (1, 15, 28)]
    wide = full_union(make_base([base_row(d, s) for d in days for s in "AB"]), "daily")
    contract, flat, months = schemas.ty_contract("daily"), f"{tmp_path}/flat", f"{tmp_path}/months"
    write_report(wide, contract, flat)
    write_report(wide, contract, months, by_month=True)
    write_report(wide, contract, months, by_month=True)  # a refresh replaces it
    whole = read_report(spark, contract, months, by_month=True)
    plain = read_report(spark, contract, flat)
    assert whole.schema == contract == plain.schema
    assert whole.exceptAll(plain).count() == 0 and plain.exceptAll(whole).count() == 0

    recent = since(read_report(spark, contract, months, by_month=True, first=F.lit("2024-10-20").cast("date")),
                   F.lit("2025-01-19").cast("date"), 91)
    plan = recent._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(report_month" in plan
    opened = recent.select("report_date", F.input_file_name().alias("f")).collect()
    assert {r["f"].split("report_month=")[1][:7] for r in opened} == {"2024-10", "2024-11", "2024-12"}
    assert {str(r["report_date"]) for r in recent.collect()} == {d for d in days if d >= "2024-10-20"}

    # a row without a date stays in the whole table; a table without rows has the contract's columns
    odd = wide.limit(1).withColumn("report_date", F.lit(None).cast("date"))
    write_report(wide.unionByName(odd), contract, months, by_month=True)
    assert read_report(spark, contract, months, by_month=True).where("report_date IS NULL").count() == 1
    write_report(wide.limit(0), contract, months, by_month=True)
    assert read_report(spark, contract, months, by_month=True).count() == 0


def test_job_by_month_writes_the_same_reports(spark, base, make_lookup, tmp_path):
    given = (spark, base, make_lookup([(1, 101, None)]))
    flat = run_job(*given, f"{tmp_path}/flat", as_of="2024-03-20", periods=("daily",))
    months = run_job(*given, f"{tmp_path}/months", as_of="2024-03-20", periods=("daily",), by_month=True)
    assert set(flat) == set(months)
    for name in flat:
        a = spark.read.parquet(flat[name])
        b = read_report(spark, a.schema, months[name], by_month=True)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == b.count() > 0, name
    for call in (write_report, lambda df, contract, **where: read_report(spark, contract, **where)):
        with pytest.raises(ValueError, match="for paths"):
            call(a, a.schema, table="any", by_month=True)
