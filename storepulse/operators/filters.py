"""Row filters, as predicates (Columns) plus DataFrame wrappers.

Predicates are kept as Columns so the level rollup can evaluate all of them in
one pass; the wrappers exist for callers that want the filtered rows.
Null semantics are Spark's three-valued logic: a null profit center or
segment fails every predicate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import metrics as M


def _in_list(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def is_store_sql() -> str:
    """physical stores (profit center neither online nor omni)."""
    return f"NOT (profit_center IN ({_in_list((M.ONLINE_PROFIT_CENTER, M.OMNI_PROFIT_CENTER))}))"


def is_online_sql() -> str:
    """F2."""
    return f"profit_center = '{M.ONLINE_PROFIT_CENTER}'"


def is_omni_sql() -> str:
    """F3."""
    return f"profit_center = '{M.OMNI_PROFIT_CENTER}'"


def has_segment_sql(column: str) -> str:
    """a usable region/market value (trimmed, case-sensitive)."""
    return f"NOT (trim(`{column}`) IN ({_in_list(M.BLANK_SEGMENTS)}))"


def is_store() -> Column:
    return F.expr(is_store_sql())


def is_online() -> Column:
    return F.expr(is_online_sql())


def is_omni() -> Column:
    return F.expr(is_omni_sql())


def has_segment(column: str) -> Column:
    return F.expr(has_segment_sql(column))


def filter_stores(df: DataFrame) -> DataFrame:
    return df.filter(is_store())


def filter_online(df: DataFrame) -> DataFrame:
    return df.filter(is_online())


def filter_omni(df: DataFrame) -> DataFrame:
    return df.filter(is_omni())


def filter_valid_segment(df: DataFrame, column: str) -> DataFrame:
    return df.filter(has_segment(column))


def since(df: DataFrame, as_of: Column, days: int, column: str = "report_date") -> DataFrame:
    """rows dated on or after ``as_of - days`` (no upper bound)."""
    return df.filter(F.col(column) >= F.date_sub(as_of, days))


def until(df: DataFrame, as_of: Column, days: int, column: str = "report_date") -> DataFrame:
    """rows dated on or before ``as_of - days``."""
    return df.filter(F.col(column) <= F.date_sub(as_of, days))
