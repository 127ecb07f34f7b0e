"""Attach each store's opening date (the comp-store test input).

Left join on ``app_key`` and the profit center read as an integer
(``try_cast``: a non-numeric profit center simply finds no match under ANSI
mode).  A missing or unknown opening date becomes 2020-01-01.  Like the
source definition the join does not de-duplicate the lookup.

The lookup is broadcast only after a bounded row count proves it small;
otherwise Spark plans a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import metrics as M

BROADCAST_MAX_ROWS = 2_000_000


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (stops counting early)."""
    return df.limit(max_rows + 1).count() <= max_rows


def prepare_lookup(lookup: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rename the lookup's columns and mark it for broadcast if it is small."""
    lk = lookup.select(
        F.col("app_key").alias("lk_app_key"),
        F.col("pft_ctr").alias("lk_pft_ctr"),
        F.col("grand_open_date").alias("lk_open_date"),
    )
    return F.broadcast(lk) if fits(lk, max_rows) else lk


def with_open_date(df: DataFrame, lookup: DataFrame, prepared: bool = False) -> DataFrame:
    """Append ``store_open_date`` to every row of ``df``."""
    lk = lookup if prepared else prepare_lookup(lookup)
    cond = (F.col("app_key") == F.col("lk_app_key")) & (
        F.col("profit_center").try_cast("int") == F.col("lk_pft_ctr")
    )
    joined = df.join(lk, cond, "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        F.coalesce(F.col("lk_open_date"), F.lit(M.DEFAULT_OPEN_DATE).cast("date")).alias("store_open_date"),
    )
