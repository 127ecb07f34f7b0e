"""Percent change against last year, clamped.

``null`` when last year is 0 or null or this year is null; otherwise
``round((ty - ly) * 100 / ly, 2)`` clamped to +-1000.  The divisor is ``ly``
itself (not its absolute value), so a negative base flips the sign.

Decimal measures divide exactly (see ``arith.round_ratio``).  Integer and
double measures keep Spark's native ``/`` (a double), like their definition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import metrics as M
from .arith import clamp, q, round_ratio


def growth_sql(ty: str, ly: str, dtype: T.DataType) -> str:
    a, b = q(ty), q(ly)
    if isinstance(dtype, T.DecimalType):
        change = round_ratio(f"({a} - {b}) * 100", b)
    else:
        change = f"round(({a} - {b}) * 100 / {b}, 2)"
    return (f"CASE WHEN {b} = 0 OR {b} IS NULL OR {a} IS NULL THEN NULL "
            f"ELSE {clamp(change, M.GROWTH_LIMIT)} END")


def growth(ty: str, ly: str, dtype: T.DataType) -> Column:
    return F.expr(growth_sql(ty, ly, dtype))
