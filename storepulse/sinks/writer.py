"""K1-K7: save a report under its contract, as a full refresh that survives failure.

The contract is chosen by an explicit argument, never by the table name.  A
refresh is written beside the present table and takes its place only when
every task has succeeded: until then, and after a failed job, readers find the
table as it was.  The switch is two renames (the present one aside, the new one
into place); if the second fails the first is undone.  What a run leaves
aside when its driver dies between or before them is found by name
(``<table>__new_...``, ``<table>__old_...``).

Rows are sorted by date within each task, so Parquet row-group statistics let
date-bounded readers (the 91-day long report) skip old row groups.  With
``by_month`` a report is laid out in a folder a month instead, and a bounded
reader opens the files of its months alone: the rows are dealt by month before
the write, and adaptive execution splits a month that is too large for one task
and joins small ones.  ``read_report`` gives back the contract's columns of
either layout; rows without a date are in a folder of their own.  The month
layout is for paths alone: a catalog may keep the places of a renamed table's
partitions, so the switch can't be made there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import conform


MONTH = "report_month"


def write_report(df: DataFrame, contract: T.StructType, path: str | None = None, table: str | None = None,
                 by_month: bool = False) -> None:
    """Replace the Parquet folder ``path`` or the catalog table ``table`` by ``df`` under its contract."""
    if (path is None) == (table is None):
        raise ValueError("name either a path or a table")
    if by_month and path is None:
        raise ValueError("the month layout is for paths")
    spark, out = df.sparkSession, conform(df, contract)
    if by_month:
        out = out.withColumn(MONTH, F.trunc("report_date", "month")).hint("rebalance", F.col(MONTH))
        writer = out.sortWithinPartitions(MONTH, "report_date").write.partitionBy(MONTH)
    else:
        writer = out.sortWithinPartitions("report_date").write
    run = uuid.uuid4().hex[:12]
    if path is not None:
        path = path.rstrip("/")
        fresh, aside = (f"{path}__{kind}_{run}" for kind in ("new", "old"))
        try:
            writer.parquet(fresh)
            _switch_folder(spark, path, fresh, aside)
        except BaseException:
            _delete(spark, fresh)
            raise
        _delete(spark, aside)
    else:
        fresh, aside = (f"{table}__{kind}_{run}" for kind in ("new", "old"))
        try:
            writer.format("parquet").saveAsTable(fresh)
            _switch_table(spark, table, fresh, aside)
        except BaseException:
            spark.sql(f"DROP TABLE IF EXISTS {fresh}")
            raise
        spark.sql(f"DROP TABLE IF EXISTS {aside}")


def read_report(spark: SparkSession, contract: T.StructType, path: str | None = None, table: str | None = None,
                by_month: bool = False, first: Column | None = None) -> DataFrame:
    """A written report's columns; those of months before that of ``first`` are not read where the layout allows it.

    ``first`` picks files, not rows: earlier days of its month, and in the other layout all days, are there.
    """
    if (path is None) == (table is None):
        raise ValueError("name either a path or a table")
    if not by_month:
        return spark.read.parquet(path) if table is None else spark.table(table)
    if path is None:
        raise ValueError("the month layout is for paths")
    # a report without rows has no file to take a schema from
    df = spark.read.schema(T.StructType([*contract.fields, T.StructField(MONTH, T.DateType())])).parquet(path)
    if first is not None:
        df = df.where(F.col(MONTH) >= F.trunc(first, "month"))
    return df.select(*contract.names)


def _files(spark: SparkSession, path: str):
    """(file system, path) as the session's Hadoop configuration has them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _files(spark, path)
    if fs.exists(at):
        fs.delete(at, True)


def _rename(spark: SparkSession, path: str, to: str) -> None:
    fs, at = _files(spark, path)
    if not fs.rename(at, _files(spark, to)[1]):
        raise OSError(f"{path} can't be renamed to {to}")


def _switch_folder(spark: SparkSession, path: str, fresh: str, aside: str) -> None:
    fs, at = _files(spark, path)
    had = fs.exists(at)
    if had:
        _rename(spark, path, aside)
    try:
        _rename(spark, fresh, path)
    except BaseException:
        if had:
            _rename(spark, aside, path)
        raise


def _switch_table(spark: SparkSession, table: str, fresh: str, aside: str) -> None:
    had = spark.catalog.tableExists(table)
    if had:
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except BaseException:
        if had:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
        raise
