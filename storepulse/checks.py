"""Data checks the plans rely on, each one aggregate job over few columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import metrics as M


def ly_date_offsets(base: DataFrame) -> int:
    """Rows whose ``ly_date`` is not ``report_date - 364`` (null-safe)."""
    bad = ~F.col("ly_date").eqNullSafe(F.date_sub(F.col("report_date"), M.LY_SHIFT_DAYS))
    return base.select("report_date", "ly_date").filter(bad).limit(1).count()


def has_nameless(base: DataFrame) -> bool:
    """Whether a row has no store name: a scan of one column, answered by Parquet's statistics where they can."""
    return not base.select("store_name").where("store_name IS NULL").isEmpty()


def duplicate_keys(df: DataFrame, keys: list[str]) -> int:
    """Number of key values that occur more than once (one shuffle on the keys)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1).count()
