"""Input schemas and the three output contracts, plus ``conform``.

A contract is an ordered ``StructType``.  ``conform`` binds columns *by name*
and casts each one to the contract type, so a report's physical column order
never decides which value lands in which column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import metrics as M

AMOUNT = T.DecimalType(15, 2)
NARROW = T.DecimalType(10, 2)
TRANSPOSED_TY = T.DecimalType(21, 2)
TRANSPOSED_CMP = T.DecimalType(10, 2)

_KEY_TYPES = {
    "report_date": T.DateType(),
    "ly_date": T.DateType(),
    "app_key": T.LongType(),
    "profit_center": T.StringType(),
    "custom_key": T.StringType(),
    "filter_level": T.StringType(),
    "segment": T.StringType(),
    "store_name": T.StringType(),
    "region": T.StringType(),
    "market": T.StringType(),
}


def measure_type(name: str) -> T.DataType:
    """Contract type of one this-year measure (additive or KPI)."""
    if name in M.COUNT_MEASURES:
        return T.LongType()
    if name in M.NARROW_KPIS:
        return NARROW
    return AMOUNT


# daily_report_base: 10 keys + 38 additive measures, one row per store and day.
REPORT_BASE = T.StructType(
    [T.StructField(c, _KEY_TYPES[c]) for c in M.KEY_COLUMNS]
    + [T.StructField(c, measure_type(c)) for c in M.ADDITIVE_MEASURES]
)

# store_lookup: opening date of each (app_key, profit center).
STORE_LOOKUP = T.StructType([
    T.StructField("app_key", T.LongType()),
    T.StructField("pft_ctr", T.IntegerType()),
    T.StructField("grand_open_date", T.DateType()),
])


def ty_contract(period: str) -> T.StructType:
    """This-year report: 10 keys, the period start unless daily, then the 71
    measures sorted by name."""
    fields = [T.StructField(c, _KEY_TYPES[c]) for c in M.KEY_COLUMNS]
    pcol = M.period_column(period)
    if pcol:
        fields.append(T.StructField(pcol, T.DateType()))
    fields += [T.StructField(c, measure_type(c)) for c in sorted(M.ty_measure_columns())]
    return T.StructType(fields)


COMPARISON = T.StructType(
    [T.StructField(c, _KEY_TYPES[c]) for c in M.COMPARE_KEY_COLUMNS]
    + [T.StructField(c, NARROW) for c in M.COMPARED_MEASURES]
)

VALUE_COLUMNS = tuple(
    f"{M.PERIOD_TAG[p]}_{view}" for p in M.PERIODS for view in ("ty", "ly", "comp")
)

TRANSPOSED = T.StructType(
    [
        T.StructField("report_date", T.DateType()),
        T.StructField("filter_level", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("column_order", T.IntegerType()),
        T.StructField("color", T.StringType()),
    ]
    + [
        T.StructField(c, TRANSPOSED_TY if c.endswith("_ty") else TRANSPOSED_CMP)
        for c in VALUE_COLUMNS
    ]
)


def cast_to(schema: T.StructType) -> list[Column]:
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select exactly the contract's columns, by name, cast to its types.

    Missing columns are an error (not silently null): a report that lost a
    measure must fail loudly.  Extra columns are dropped.
    """
    missing = [f.name for f in contract.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for contract: {missing}")
    return df.select(*cast_to(contract))
