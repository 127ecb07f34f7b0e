"""The thirteen reports as compositions of the operators.

Two ways to run them:

* ``Reports`` builds any single report from the two inputs (used by the query
  registry and tests) as an unevaluated DataFrame.  Two small checks run as it
  is built: whether the lookup is small enough to broadcast, and for the long
  report whether ``ly_date`` is always 364 days back.
* ``run_job`` is the production job: it computes each period's store-level
  frame once (persisted), writes the twelve wide tables (the last-year reports
  read this year's written one), then builds the long table from the *written*
  tables (reading back cuts the lineage and lets Parquet statistics skip
  everything older than the 91-day window).

One ``as_of`` date is fixed on the driver for the whole run, so every report
of one run uses the same "today".
"""

from __future__ import annotations

import datetime as _dt
import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import metrics as M
from .. import schemas
from ..checks import has_nameless, ly_date_offsets
from ..operators.compare import compare_last_year, compare_tagged
from ..operators.filters import since
from ..operators.levels import full_union, tagged_union
from ..operators.lookup import prepare_lookup, with_open_date
from ..operators.periods import past_year_slice, period_to_date
from ..operators.transpose import combine, combine_packed, pack
from ..sinks.writer import read_report, write_report

# Periods whose last-year match is the row's own ly_date (J1); the others use
# the prior year re-accumulated on the shifted calendar.
SELF_MATCHED = ("daily", "week")
TAGS = ("_period", "_match")  # of a frame, and the date on which its rows meet last year's


def table_name(period: str, view: str) -> str:
    tag = M.PERIOD_TAG[period]
    return {"ty": f"{tag}_report", "ly": f"ly_{tag}_report", "comp": f"comp_{tag}_report"}[view]


COMBINED_TABLE = "combined_transposed_report"


def date_literal(value: str | _dt.date | Column | None) -> Column:
    if isinstance(value, Column):
        return value
    day = value or _dt.date.today()
    return F.lit(str(day)).cast("date")


def store_frame(base: DataFrame, period: str, nameless: bool = True) -> DataFrame:
    """Store rows of one period: the base itself (daily) or its running sums."""
    return base if period == "daily" else period_to_date(base, period, nameless=nameless)


def shifted_store_frame(base: DataFrame, period: str, as_of: Column, nameless: bool = True) -> DataFrame:
    """The prior year accumulated on the shifted (ny_date) calendar."""
    return period_to_date(past_year_slice(base, as_of), period, "ny_date", nameless)


@dataclass
class Reports:
    """Lazy builders of every report over one base, lookup and as-of date."""

    base: DataFrame
    lookup: DataFrame
    as_of: Column
    _lookup_prepared: DataFrame | None = field(default=None, repr=False)
    _memo: dict = field(default_factory=dict, repr=False)

    def _once(self, key, build):
        """Build each frame once per instance, so reports that share a frame
        share one DataFrame (one analysis, and identical plans for reuse)."""
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    @property
    def nameless(self) -> bool:
        return self._once("nameless", lambda: has_nameless(self.base))

    @property
    def lookup_side(self) -> DataFrame:
        if self._lookup_prepared is None:
            self._lookup_prepared = prepare_lookup(self.lookup)
        return self._lookup_prepared

    def with_open(self, df: DataFrame) -> DataFrame:
        return with_open_date(df, self.lookup_side, prepared=True)

    def stores(self, period: str) -> DataFrame:
        return self._once(("stores", period), lambda: store_frame(self.base, period, self.nameless))

    def shifted_stores(self, period: str) -> DataFrame:
        return self._once(("shifted", period),
                          lambda: shifted_store_frame(self.base, period, self.as_of, self.nameless))

    def ty(self, period: str) -> DataFrame:
        """R1, R4, R7, R10."""
        return self._once(("ty", period), lambda: full_union(self.stores(period), period))

    def ly(self, period: str) -> DataFrame:
        """R2, R5, R8, R11."""
        def build():
            if period in SELF_MATCHED:
                return compare_last_year(self.ty(period))
            prior = full_union(self.shifted_stores(period), period)
            return compare_last_year(self.ty(period), prior)
        return self._once(("ly", period), build)

    def comp_frame(self, period: str) -> DataFrame:
        return self._once(("comp_frame", period), lambda: full_union(
            self.with_open(self.stores(period)), period, comp=True))

    def comp(self, period: str) -> DataFrame:
        """R3, R6, R9, R12."""
        def build():
            cur = self.comp_frame(period)
            if period in SELF_MATCHED:
                return compare_last_year(cur)
            prior = full_union(self.with_open(self.shifted_stores(period)), period, comp=True)
            return compare_last_year(cur, prior)
        return self._once(("comp", period), build)

    def report(self, period: str, view: str) -> DataFrame:
        return {"ty": self.ty, "ly": self.ly, "comp": self.comp}[view](period)

    def conformed(self, period: str, view: str) -> DataFrame:
        contract = schemas.ty_contract(period) if view == "ty" else schemas.COMPARISON
        return schemas.conform(self.report(period, view), contract)

    def combined(self) -> DataFrame:
        """R13 from the inputs alone, lazily, computing only the dates it shows.

        The long table has the last 91 days.  Each period's store rows are cut
        to these days after the running sums (which need the days before) and
        before the rollup, KPIs and comparison; the prior-year side is cut to
        the days these are compared with.  The base is cut to the dates that
        the running sums of both need, after checking that every ``ly_date``
        is ``report_date - 364``; otherwise nothing but the shown days is cut.

        The eight this-year frames (four periods, with and without the comp
        mask) are one frame with tag columns, and so are the eight they are
        compared with: one rollup and one KPI projection for each side, one join.
        """
        exact = ly_date_offsets(self.base) == 0
        base = self.base.filter(F.col("report_date") >= combined_first_date(self.as_of)) if exact else self.base
        days = M.ROLLING_WINDOW_DAYS
        now, last = [], []
        for p in M.PERIODS:
            every = store_frame(base, p, self.nameless)
            now.append(self._tagged(since(every, self.as_of, days), p, "report_date" if p not in SELF_MATCHED else "ly_date"))
            if p in SELF_MATCHED:  # no upper end: rows after as_of are shown
                past = since(every, self.as_of, days + M.LY_SHIFT_DAYS) if exact else every
                last.append(self._tagged(past, p, "report_date"))
            else:
                past = since(shifted_store_frame(base, p, self.as_of, self.nameless), self.as_of, days + M.LY_SHIFT_DAYS)
                last.append(self._tagged(past, p, f"date_add(report_date, {M.LY_SHIFT_DAYS})"))
        wide, prior = (tagged_union(reduce(DataFrame.unionByName, x), TAGS, "_comp") for x in (now, last))
        changes = compare_tagged(wide, prior, (*TAGS, "_comp"))
        names = list(schemas.VALUE_COLUMNS)
        number = lambda view: reduce(
            lambda rest, p: F.when(F.col("_period") == p, names.index(f"{M.PERIOD_TAG[p]}_{view}")).otherwise(rest),
            M.PERIODS, F.lit(None).cast("int"))
        packed = pack(wide.where("NOT _comp"), number("ty"), names[0]).unionByName(
            pack(changes, F.when(F.col("_comp"), number("comp")).otherwise(number("ly")), names[1]))
        return combine_packed(packed, names)

    def _tagged(self, stores: DataFrame, period: str, match: str) -> DataFrame:
        columns = [*M.KEY_COLUMNS, *M.ADDITIVE_MEASURES]
        opened = self.with_open(stores.select(*columns))
        return opened.select(*columns, "store_open_date", F.lit(period).alias("_period"), F.expr(match).alias("_match"))


def combined_first_date(as_of: Column) -> Column:
    """Oldest base date the 91-day long report depends on.

    A row dated D needs base rows from the start of D's year (year-to-date),
    the same span a year earlier shifted by 364 days (year-to-date last year),
    and the week of D - 364 (week-to-date last year).  Valid when
    ``ly_date = report_date - 364`` holds in the base (``checks.ly_date_offsets``).
    """
    first = F.date_sub(as_of, M.ROLLING_WINDOW_DAYS)
    return F.least(
        F.date_sub(F.trunc(first, "year"), M.LY_SHIFT_DAYS),
        F.trunc(F.date_sub(first, M.LY_SHIFT_DAYS), "week"),
    )


def _as_computed(written: DataFrame) -> DataFrame:
    """A written this-year report with its count ratios as the doubles they were.

    A double rounded to two digits and the decimal it was written as name each other,
    so changes computed from the table are those computed from the frame.
    """
    ratios = [k.name for k in M.KPIS if k.double]
    return written.withColumns({c: F.col(c).cast("double") for c in ratios})


def _period_job(base: DataFrame, lk: DataFrame, period: str, day: Column, nameless: bool, save, stored) -> None:
    """Write one period's three wide reports.

    This year's report is written, and read again for the comparison: a table needs
    no memory, and losing an executor costs no recomputation.  Only what feeds
    two plans and is not written is persisted: the store rows with their running sums
    (38 measures, no KPIs), and a comp frame that meets itself.
    """
    level = StorageLevel.MEMORY_AND_DISK
    held: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        held.append(df.persist(level))
        return df

    def stack(stores: DataFrame, comp: bool = False) -> DataFrame:
        return full_union(with_open_date(stores, lk, prepared=True) if comp else stores, period, comp)

    try:
        # the daily store frame is the caller's base itself: its caching is the caller's
        current = base if period == "daily" else keep(store_frame(base, period, nameless))
        contract = schemas.ty_contract(period)
        ty = _as_computed(stored(save(stack(current), contract, table_name(period, "ty"))))
        if period in SELF_MATCHED:
            ly, comp = compare_last_year(ty), compare_last_year(keep(stack(current, comp=True)))
        else:
            prior = keep(shifted_store_frame(base, period, day, nameless))
            ly = compare_last_year(ty, stack(prior))
            comp = compare_last_year(stack(current, comp=True), stack(prior, comp=True))
        save(ly, schemas.COMPARISON, table_name(period, "ly"))
        save(comp, schemas.COMPARISON, table_name(period, "comp"))
    finally:
        for df in held:
            df.unpersist()


def run_job(spark: SparkSession, base: DataFrame, lookup: DataFrame, out_root: str | None = None,
            as_of: str | _dt.date | Column | None = None, periods: tuple[str, ...] = M.PERIODS,
            timings: dict[str, float] | None = None, parallel: int = 4, database: str | None = None,
            by_month: bool = False) -> dict[str, str]:
    """Compute and write all thirteen reports, as Parquet under ``out_root`` or as tables of ``database``.

    Returns {table name: path or qualified table name}.  The four periods are independent until the
    long report, so their jobs are submitted from ``parallel`` driver threads
    (Spark schedules concurrent jobs; on a cluster this keeps executors busy
    while one period waits on a small stage).  The long report is built from
    the written tables.  With ``by_month`` each is laid out in a folder a month
    (``sinks.read_report`` reads it), and the long report opens only those of its
    91 days.  ``timings`` (if given) receives each table's write
    wall time.
    """
    if (out_root is None) == (database is None):
        raise ValueError("name either a folder or a database for the reports")
    day = date_literal(as_of)
    lk = prepare_lookup(lookup)
    nameless = has_nameless(base)
    paths: dict[str, str] = {}
    contracts = {}

    def stored(where: str, first: Column | None = None) -> DataFrame:
        place = {"path": where} if database is None else {"table": where}
        return read_report(spark, contracts[where], by_month=by_month, first=first, **place)

    def save(df: DataFrame, contract, name: str) -> str:
        start = time.perf_counter()
        if database is None:
            paths[name] = os.path.join(out_root, name)
            write_report(df, contract, path=paths[name], by_month=by_month)
        else:
            paths[name] = f"{database}.{name}"
            write_report(df, contract, table=paths[name], by_month=by_month)
        contracts[paths[name]] = contract
        if timings is not None:
            timings[name] = round(time.perf_counter() - start, 3)
        return paths[name]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for f in [pool.submit(_period_job, base, lk, p, day, nameless, save, stored) for p in periods]:
            f.result()

    if set(periods) == set(M.PERIODS):  # the long table needs all twelve frames
        first = F.date_sub(day, M.ROLLING_WINDOW_DAYS)
        frames = {
            f"{M.PERIOD_TAG[p]}_{v}": stored(paths[table_name(p, v)], first)
            for p in M.PERIODS for v in ("ty", "ly", "comp")
        }
        save(combine(frames, day), schemas.TRANSPOSED, COMBINED_TABLE)
    return paths
