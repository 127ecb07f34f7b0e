"""Named queries over a test-data folder: one per operator or report.

Every query derives its inputs from the raw tables of ``sf_dir`` (lineitem,
orders, customer, nation, region, part), so its work grows with them.  The
derived base and lookup are written once per session and data folder, as
Parquet below ``spark.checkpoint.dir``, and read by the production readers:
every query plans from a table with pushdown and column pruning, as the job does.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import metrics as M
from . import schemas
from .functions.kpis import kpi_columns
from .operators.filters import filter_omni, filter_online, filter_stores, filter_valid_segment
from .operators.levels import LEVEL_AGGREGATED, rollup_levels
from .operators.periods import past_year_slice
from .operators.transpose import transpose
from .plans.reports import Reports, date_literal
from .session import ensure_checkpoint_dir
from .sources.fixtures import derive_report_base, derive_store_lookup
from .sources.tables import read_report_base, read_store_lookup

AS_OF = "2001-08-01"  # last order date of the test data; every query reports as of it

_CACHE: dict[tuple[str, str], Reports] = {}


def reports(spark: SparkSession, sf_dir: str) -> Reports:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _CACHE:
        root = os.path.join(ensure_checkpoint_dir(spark), f"inputs-{uuid.uuid4().hex}")
        derive_report_base(spark, sf_dir).write.parquet(f"{root}/daily_report_base")
        derive_store_lookup(spark, sf_dir).write.parquet(f"{root}/store_lookup")
        base = read_report_base(spark, f"{root}/daily_report_base")
        lookup = read_store_lookup(spark, f"{root}/store_lookup")
        _CACHE[key] = Reports(base, lookup, date_literal(AS_OF))
    return _CACHE[key]


def _measures(cols) -> list:
    return [F.col(c).cast(schemas.measure_type(c)).alias(c) for c in cols]


ROLL_KEYS = ("report_date", "ly_date", "filter_level", "segment", "custom_key", "region", "market")


def _rollup(df: DataFrame, period: str, comp: bool = False, segment: str | None = None,
            level: str | None = None) -> DataFrame:
    out = rollup_levels(df, period, comp)
    if segment:
        out = out.filter((F.col("filter_level") == LEVEL_AGGREGATED) & (F.col("segment") == segment))
    if level:
        out = out.filter(F.col("filter_level") == level)
    pcol = M.period_column(period)
    return out.select(*ROLL_KEYS, *([pcol] if pcol else []), *_measures(M.ADDITIVE_MEASURES))


def _base(spark, d):
    return reports(spark, d).base


def _ptd(period: str, shifted: bool = False):
    def q(spark, d):
        r = reports(spark, d)
        df = r.shifted_stores(period) if shifted else r.stores(period)
        return df.select(*M.KEY_COLUMNS, M.period_column(period), *_measures(M.ADDITIVE_MEASURES))
    return q


def _level_rollup(segment=None, level=None):
    return lambda spark, d: _rollup(_base(spark, d), "daily", segment=segment, level=level)


def _period_total(period: str):
    return lambda spark, d: _rollup(reports(spark, d).stores(period), period, segment="Total")


def _report(period: str, view: str):
    return lambda spark, d: reports(spark, d).conformed(period, view)


def _kpi_store_daily(spark, d):
    kpis = _base(spark, d).select(*M.KEY_COLUMNS, *kpi_columns())
    return kpis.select(*M.KEY_COLUMNS, *_measures(M.KPI_NAMES))


def _comp_prep(spark, d):
    r = reports(spark, d)
    return r.with_open(r.base)


def _comp_rollup(spark, d):
    r = reports(spark, d)
    return _rollup(r.with_open(r.base), "daily", comp=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_report_base": _base,
    "scan_store_lookup": lambda spark, d: reports(spark, d).lookup,
    "past_year_slice": lambda spark, d: past_year_slice(_base(spark, d), date_literal(AS_OF)),
    "filter_stores": lambda spark, d: filter_stores(_base(spark, d)),
    "filter_online": lambda spark, d: filter_online(_base(spark, d)),
    "filter_omni": lambda spark, d: filter_omni(_base(spark, d)),
    "filter_valid_segment": lambda spark, d: filter_valid_segment(_base(spark, d), "market"),
    "rollup_total": _level_rollup(segment="Total"),
    "rollup_stores": _level_rollup(segment="Stores"),
    "rollup_online": _level_rollup(segment="Online"),
    "rollup_omni": _level_rollup(segment="Omni"),
    "rollup_region": _level_rollup(level="Region"),
    "rollup_market": _level_rollup(level="Market"),
    "comp_rollup": _comp_rollup,
    "wtd_total": _period_total("week"),
    "mtd_total": _period_total("month"),
    "ytd_total": _period_total("year"),
    "kpi_store_daily": _kpi_store_daily,
    "wtd_running": _ptd("week"),
    "mtd_running": _ptd("month"),
    "ytd_running": _ptd("year"),
    "mtd_running_shifted": _ptd("month", shifted=True),
    "ytd_running_shifted": _ptd("year", shifted=True),
    "comp_prep": _comp_prep,
    "transpose_daily_ty": lambda spark, d: transpose(
        reports(spark, d).ty("daily"), "daily_ty", date_literal(AS_OF)),
}
for _p in M.PERIODS:
    _t = M.PERIOD_TAG[_p]
    QUERIES[f"{_t}_report"] = _report(_p, "ty")
    QUERIES[f"ly_{_t}_report"] = _report(_p, "ly")
    QUERIES[f"comp_{_t}_report"] = _report(_p, "comp")
QUERIES["combined_transposed_report"] = lambda spark, d: reports(spark, d).combined()
