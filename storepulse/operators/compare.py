"""This year against the same point last year.

J1 (daily, week-to-date): a row meets the row of the same segment dated on its
own ``ly_date``.  J2 (month-, year-to-date): it meets the row of the prior-year
frame whose shifted date (``report_date + 364``) is its ``report_date``; that
frame was accumulated on the shifted calendar.

Both are left equi-joins on (date, segment).  The keys are unique per side,
so the join neither skews nor multiplies; Spark plans a sort-merge join (or a
broadcast when AQE sees a small side).  The last-year side is projected to
its 48 measures before the join, so the shuffle carries only those.

As defined, the match ignores ``filter_level``: equal segment names on two
levels do match each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import metrics as M
from ..functions.growth import growth


def _last_year_side(df: DataFrame, shifted: bool) -> DataFrame:
    date_sql = f"date_add(report_date, {M.LY_SHIFT_DAYS})" if shifted else "report_date"
    return df.selectExpr(
        f"{date_sql} AS _ly_key_date",
        "segment AS _ly_key_segment",
        *[f"`{c}` AS `_ly_{c}`" for c in M.COMPARED_MEASURES],
    )


def compare_last_year(ty: DataFrame, last_year: DataFrame | None = None) -> DataFrame:
    """G1 over J1 (``last_year is None``: self match on ``ly_date``) or J2.

    Returns the nine keys of the this-year row and 48 clamped percent changes.
    """
    shifted = last_year is not None
    ly = _last_year_side(last_year if shifted else ty, shifted)
    this_date = F.col("report_date") if shifted else F.col("ly_date")
    joined = ty.join(
        ly,
        (this_date == F.col("_ly_key_date")) & (F.col("segment") == F.col("_ly_key_segment")),
        "left",
    )
    schema = {f.name: f.dataType for f in ty.schema.fields}
    return joined.select(
        *M.COMPARE_KEY_COLUMNS,
        *[growth(c, f"_ly_{c}", schema[c]).alias(c) for c in M.COMPARED_MEASURES],
    )


def compare_tagged(ty: DataFrame, prior: DataFrame, tags: tuple[str, ...]) -> DataFrame:
    """G1 for frames stacked with tag columns: rows meet where all tags and the segment are equal.

    One of the tags is the date to meet on.  Returns the tags, the date, level
    and segment of the this-year row and 48 clamped percent changes.
    """
    ly = prior.selectExpr(*[f"{t} AS _ly{t}" for t in tags], "segment AS _ly_key_segment",
                          *[f"`{c}` AS `_ly_{c}`" for c in M.COMPARED_MEASURES])
    same = [F.col(t) == F.col(f"_ly{t}") for t in tags]
    joined = ty.join(ly, [*same, F.col("segment") == F.col("_ly_key_segment")], "left")
    schema = {f.name: f.dataType for f in ty.schema.fields}
    return joined.select(*tags, "report_date", "filter_level", "segment",
                         *[growth(c, f"_ly_{c}", schema[c]).alias(c) for c in M.COMPARED_MEASURES])
