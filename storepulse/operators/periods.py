"""Period-to-date running sums and the shifted prior year.

The running sum is a window partitioned by (period start, store), ordered by
date, frame ROWS UNBOUNDED PRECEDING..CURRENT ROW.  Where (store, date) is
unique a partition holds at most one period of one store (<= 366 rows).  All 38
sums share one window spec and therefore one sort.

Rows without a store name share one partition a period, as defined, however
many they are.  Theirs is a distributed prefix sum: rows are dealt to ``PARTS``
parts of a date; each part's sums (aggregated before the shuffle) become running
sums over the parts in order of date, a small table; and a row's value is the
sum before its part plus the running sum within it.  Rows of one date have no
order of their own in the definition, so any is right.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import metrics as M
from .filters import until


def period_start(period: str, date_col: str = "report_date") -> Column:
    """First day of the week (Monday), month or year containing ``date_col``."""
    return F.trunc(F.col(date_col), period)


PARTS = 64


def _running(staged: DataFrame, by: list[str], order: list[str], carry: list[str]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return staged.select(*carry, *[F.sum(c).over(w).alias(c) for c in M.ADDITIVE_MEASURES])


def _running_in_parts(staged: DataFrame, pcol: str, date_col: str, carry: list[str]) -> DataFrame:
    """Running sums over dates of all rows of a period, in many tasks."""
    keys = [pcol, date_col, "_part"]
    dealt = staged.withColumn("_part", F.pmod(F.xxhash64(*staged.columns), F.lit(PARTS)).cast("int"))
    sums = dealt.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in M.ADDITIVE_MEASURES])
    before = Window.partitionBy(pcol).orderBy(date_col, "_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*[F.col(k).alias(f"_of_{k}") for k in keys],
                       *[F.sum(c).over(before).alias(f"_before_{c}") for c in M.ADDITIVE_MEASURES])
    within = _running(dealt, keys, [date_col], [*dict.fromkeys([*carry, *keys])])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    both = within.join(base, same)
    # a sum of nothing but nulls is null
    return both.select(*carry, *[F.coalesce(F.col(f"_before_{c}") + F.col(c), F.col(c), F.col(f"_before_{c}")).alias(c)
                                 for c in M.ADDITIVE_MEASURES])


def period_to_date(df: DataFrame, period: str, date_col: str = "report_date", nameless: bool = True) -> DataFrame:
    """Running sums of the 38 measures within each period and store.

    ``date_col='ny_date'`` accumulates the prior year on the shifted calendar
    (W5); the period start is then that of ``ny_date``.  ``nameless=False`` says
    that every row has a store name (``checks.has_nameless``), and saves a branch.
    """
    pcol = M.period_column(period)
    staged = df.withColumn(pcol, period_start(period, date_col))
    carry = [*M.KEY_COLUMNS[:2], pcol, *M.KEY_COLUMNS[2:]]
    named = _running(staged.where("store_name IS NOT NULL") if nameless else staged, [pcol, "store_name"], [date_col], carry)
    if not nameless:
        return named
    return named.unionByName(_running_in_parts(staged.where("store_name IS NULL"), pcol, date_col, carry))


def past_year_slice(df: DataFrame, as_of: Column) -> DataFrame:
    """Rows at least 365 days old, with ``ny_date`` = report_date + 364."""
    return until(df, as_of, M.PAST_YEAR_CUTOFF_DAYS).withColumn(
        "ny_date", F.date_add(F.col("report_date"), M.LY_SHIFT_DAYS)
    )
