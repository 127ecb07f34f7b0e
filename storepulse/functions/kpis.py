"""The 33 derived KPIs as one projection.

KPIs are ratios of *sums*: apply this after aggregating, never before.  One
``select`` (instead of 33 chained ``withColumn``) keeps the analyzed plan flat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import metrics as M
from .arith import guarded, q, round_ratio


def kpi_sql(k: M.Kpi) -> str:
    """Spark SQL expression of one KPI over the additive columns of its row."""
    numerator = " + ".join(q(c) for c in k.plus) + "".join(f" - {q(c)}" for c in k.minus)
    if k.per is None:
        return f"round({numerator}, 2)"
    den = q(k.per)
    if k.double:
        # Count ratios are defined with a floating-point 100.00: double arithmetic.
        value = f"round(({numerator}) * 100.0D / {den}, 2)"
    else:
        value = round_ratio(f"({numerator}) * 100" if k.pct else numerator, den)
    return guarded(den, value)


def kpi_column(k: M.Kpi) -> Column:
    return F.expr(kpi_sql(k)).alias(k.name)


def kpi_columns() -> list[Column]:
    return [kpi_column(k) for k in M.KPIS]


def with_kpis(df: DataFrame) -> DataFrame:
    """Append the 33 KPI columns (replacing any of the same name)."""
    keep = [c for c in df.columns if c not in M.KPI_NAMES]
    return df.select(*keep, *kpi_columns())
