"""Small helpers for applying Arrow functions to DataFrames."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each application."""
    sc = spark.sparkContext
    if getattr(sc, "_package_shipped", False):
        return
    package = Path(__file__).parent.parent
    out = os.path.join(tempfile.mkdtemp(), f"{package.name}.zip")
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(out)
    sc._package_shipped = True


def without(schema: T.StructType, names: tuple[str, ...] | list[str]) -> list[T.StructField]:
    """Fields of ``schema`` that are not called (in any case) one of ``names``."""
    low = {n.lower() for n in names}
    return [f for f in schema.fields if f.name.lower() not in low]


def unused(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores before it until ``df`` has no such column (in any case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None],
              schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for a function of one batch; None gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None:
                    yield from (out.to_batches() if isinstance(out, pa.Table) else [out])

    return df.mapInArrow(run, schema)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder, as a path that the driver and all workers can open."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = "/" + base[5:].lstrip("/")
    elif "://" in base:
        raise ValueError(f"files here are memory-mapped by workers: {base} has to be a mounted folder (file:)")
    folder = os.path.join(base, f"{name}-{uuid.uuid4().hex}")
    os.makedirs(folder)
    return folder
