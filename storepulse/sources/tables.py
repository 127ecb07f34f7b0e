"""Table readers.

Every reader names the columns it needs up front so the Parquet scan only
decodes those (``ReadSchema`` in the plan) and later filters push into the
scan.  A deployment with catalog tables passes ``table=`` names instead of
paths; nothing else changes.
"""

from __future__ import annotations

import os
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas


def table_path(root: str, name: str) -> str:
    """Path of one Parquet table under a data root (``<root>/<name>.parquet``)."""
    return os.path.join(root, f"{name}.parquet")


def read_table(spark: SparkSession, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Load one Parquet table, pruned to ``columns``."""
    df = spark.read.parquet(table_path(root, name))
    return df.select(*columns) if columns else df


def checked(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """``df``'s columns of ``schema``, or an error that names those missing or of another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    differ = [f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}"
              for f in schema.fields if f.name in have and have[f.name] != f.dataType]
    if missing or differ:
        raise ValueError(f"{name}: " + "; ".join([f"missing {', '.join(missing)}"] * bool(missing) + differ))
    return df.select(*[f.name for f in schema.fields])


def footer_columns(spark: SparkSession, files: list[str]) -> dict[tuple[tuple[str, str], ...], list[str]]:
    """{((column, stored type), ...): files} of Parquet files, from their footers alone.

    Footers are read by Parquet's own parallel reader through the file system of each path; nothing
    but their schemas comes back.
    """
    conf = spark._jsc.hadoopConfiguration()
    statuses = spark._jvm.java.util.ArrayList()
    for f in files:
        at = spark._jvm.org.apache.hadoop.fs.Path(f)
        statuses.add(at.getFileSystem(conf).getFileStatus(at))
    found: dict[tuple[tuple[str, str], ...], list[str]] = {}
    for footer in spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.readAllFootersInParallel(conf, statuses, True):
        text = footer.getParquetMetadata().getFileMetaData().getSchema().toString()
        columns = []
        for line in text.splitlines():
            m = re.fullmatch(r"  (?:optional|required) (\S+) (\S+?)( \(.*\))?;", line)
            if m:  # columns of single values
                columns.append((m[2], m[1] + (m[3] or "")))
        found.setdefault(tuple(columns), []).append(footer.getFile().toString())
    return found


def same_in_all_files(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """``df``, or an error that names the files of it that lack a column of ``schema`` or store it as another type.

    Spark takes a folder's schema from one file, and reads a column that another file lacks as null.
    """
    names = [f.name for f in schema.fields]
    kinds = {}
    for columns, files in footer_columns(df.sparkSession, [unquote(f) for f in df.inputFiles()]).items():
        have = dict(columns)
        kinds.setdefault(tuple(have.get(n, "no such column") for n in names), []).extend(files)
    if len(kinds) > 1:
        first, *others = sorted(kinds, key=lambda k: -len(kinds[k]))
        told = "; ".join(f"{sorted(kinds[k])[0]} has " + ", ".join(f"{n}: {b}, not {a}" for n, a, b in zip(names, first, k) if a != b)
                         for k in others)
        raise ValueError(f"{name}: files differ: {told}")
    return df


def _stored(spark: SparkSession, path: str | None, table: str | None, schema: T.StructType, name: str) -> DataFrame:
    """A table's, or a Parquet folder's columns of ``schema``, which all of the folder's files have."""
    if (path is None) == (table is None):
        raise ValueError("name either a path or a table")
    if table:
        return checked(spark.table(table), schema, name)
    return checked(same_in_all_files(spark.read.parquet(path), schema, name), schema, name)


def read_report_base(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    """The store-by-day fact table; a missing, renamed or differently typed column, in any file, is an error."""
    return _stored(spark, path, table, schemas.REPORT_BASE, "report base")


def read_store_lookup(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    """S3: the store dimension (opening dates), checked like the base."""
    return _stored(spark, path, table, schemas.STORE_LOOKUP, "store lookup")
