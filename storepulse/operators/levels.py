"""The seven-level stack.

Six rollup levels (Total, Stores, Online, Omni, each Region, each Market) are
computed from ONE pass over the store rows, in two aggregations.  The first sums
the 38 measures per (dates, channel, region, market): a level is a union of such
groups, and there are as many as a day has different ones, however many stores.
Only their sums are tagged with the levels they belong to (``explode`` of an
array of level structs; a failed predicate yields null and is compacted away)
and summed again.  So a store row's 38 decimals are added once, not once a
level.  Both aggregations are partial before their shuffle, so an exchange
carries one row per task and group, and a hot level such as Total cannot skew a
task.

``full_union`` stacks the store rows and the rollups (bag union) and adds the
KPIs to both, as ratios of sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import metrics as M
from ..functions.kpis import kpi_columns
from .filters import has_segment_sql, is_omni_sql, is_online_sql, is_store_sql

LEVEL_AGGREGATED = "Aggregated"


def _level(filter_level: str, segment: str, code: str) -> str:
    return f"named_struct('filter_level', {filter_level}, 'segment', {segment}, 'code', {code})"


def _aggregated(code: str) -> str:
    return _level(f"'{LEVEL_AGGREGATED}'", f"'{code.title()}'", f"'{code}'")


def _by_value(column: str) -> str:
    return _level(f"'{column.title()}'", f"`{column}`", f"`{column}`")


def channel_sql() -> str:
    """Which of Stores, Online and Omni a store row counts for (A3-A5 predicates); null: none."""
    return f"CASE WHEN {is_store_sql()} THEN 'stores' WHEN {is_online_sql()} THEN 'online' WHEN {is_omni_sql()} THEN 'omni' END"


def level_tags_sql() -> str:
    """Array of the levels that a group of (channel, region, market) rolls up into."""
    parts = [
        _aggregated("total"),
        *[f"CASE WHEN channel = '{code}' THEN {_aggregated(code)} END" for code in ("stores", "online", "omni")],
        f"CASE WHEN {has_segment_sql('region')} THEN {_by_value('region')} END",
        f"CASE WHEN {has_segment_sql('market')} THEN {_by_value('market')} END",
    ]
    return f"array_compact(array({', '.join(parts)}))"


def level_tags() -> Column:
    return F.expr(level_tags_sql())


#: What the first aggregation tells apart beside the dates; every level is a union of these groups.
GROUP = ("channel", "region", "market")


def _grouped(df: DataFrame, keys: list[str], sums: list[Column]) -> DataFrame:
    """First aggregation: one row for each of ``keys`` and (channel, region, market)."""
    return df.withColumn("channel", F.expr(channel_sql())).groupBy(*keys, *GROUP).agg(*sums)


def _sum(column: str, counted: str | None = None) -> Column:
    value = f"`{column}`" if counted is None else f"CASE WHEN {counted} THEN `{column}` ELSE 0 END"
    return F.expr(f"sum({value})").alias(column)


def group_keys(period: str) -> list[str]:
    """A10: report_date, ly_date and the period start unless daily."""
    pcol = M.period_column(period)
    return ["report_date", "ly_date"] + ([pcol] if pcol else [])


COMP_INCLUDED = "ly_date >= store_open_date"  # A9 mask: open on the row's last-year date


def rollup_levels(df: DataFrame, period: str, comp: bool = False) -> DataFrame:
    """A1 for all six levels at once; 38 sums per (dates, level, segment).

    ``comp=True`` sums only rows whose store was open on ``ly_date`` (others
    add 0), which needs ``store_open_date`` from ``lookup.with_open_date``.
    """
    keys = group_keys(period)
    grouped = _grouped(df, keys, [_sum(c, COMP_INCLUDED if comp else None) for c in M.ADDITIVE_MEASURES])
    tagged = grouped.select(*keys, *M.ADDITIVE_MEASURES, F.explode(level_tags()).alias("lvl"))
    out = tagged.groupBy(
        *keys,
        F.col("lvl.filter_level").alias("filter_level"),
        F.col("lvl.segment").alias("segment"),
        F.col("lvl.code").alias("code"),
    ).agg(*[_sum(c) for c in M.ADDITIVE_MEASURES])
    return out.select(
        *keys,
        F.lit(None).cast(T.LongType()).alias("app_key"),
        F.lit(None).cast(T.StringType()).alias("profit_center"),
        F.concat_ws(";", F.col("report_date"), F.col("code")).alias("custom_key"),
        "filter_level",
        "segment",
        F.lit(None).cast(T.StringType()).alias("store_name"),
        F.when(F.col("filter_level") == "Region", F.col("segment")).alias("region"),
        F.when(F.col("filter_level") == "Market", F.col("segment")).alias("market"),
        *M.ADDITIVE_MEASURES,
    )


def frame_columns(period: str) -> list[str]:
    pcol = M.period_column(period)
    return list(M.KEY_COLUMNS) + ([pcol] if pcol else []) + list(M.ADDITIVE_MEASURES)


def full_union(df: DataFrame, period: str, comp: bool = False) -> DataFrame:
    """Store rows plus the six rollups, each with the 33 KPIs.

    Store rows are never comp-masked (only the rollup sums are).  The KPI
    projection is written once over the union; the optimizer pushes it into
    both branches, so each row still computes its ratios from its own sums.
    """
    cols = frame_columns(period)
    stacked = df.select(*cols).unionByName(rollup_levels(df, period, comp).select(*cols))
    return stacked.select(*cols, *kpi_columns())


def tagged_union(df: DataFrame, tags: tuple[str, ...], masked: str) -> DataFrame:
    """U1 for several frames at once, told apart by the columns ``tags``, each with and without the comp mask.

    The boolean column ``masked`` is added: where it is true, the rollup sums count only
    rows whose store was open on ``ly_date`` (A9).  Store rows are never masked, so
    their KPIs are computed once and the rows then stand under both.
    """
    keys = [*tags, "report_date", "ly_date"]
    both = F.explode(F.array(F.lit(False), F.lit(True))).alias(masked)
    open_then = df.withColumn("_open", F.expr(f"coalesce({COMP_INCLUDED}, false)"))
    grouped = _grouped(open_then, [*keys, "_open"], [_sum(c) for c in M.ADDITIVE_MEASURES])
    grouped = grouped.select(*grouped.columns, both)
    exploded = grouped.select(*keys, masked, "_open", *M.ADDITIVE_MEASURES, F.explode(level_tags()).alias("lvl"))
    rolled = exploded.groupBy(
        *keys, masked, F.col("lvl.filter_level").alias("filter_level"), F.col("lvl.segment").alias("segment"),
    ).agg(*[_sum(c, f"NOT {masked} OR _open") for c in M.ADDITIVE_MEASURES])
    cols = [*keys, "filter_level", "segment", *M.ADDITIVE_MEASURES]
    ends = [*cols, *M.KPI_NAMES, masked]
    stores = df.select(*cols, *kpi_columns()).select(*cols, *M.KPI_NAMES, both)
    return stores.select(*ends).unionByName(rolled.select(*cols, masked, *kpi_columns()).select(*ends))
