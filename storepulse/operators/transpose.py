"""The long (one row per metric) report.

T1 turns a wide report into rows of (date, level, segment, metric, value,
display order, color) with ``inline`` over an array of structs built from the
metric catalogue; null values are kept.  The value is cast by view: this-year
values to decimal(21,2), last-year and comp changes to decimal(10,2).

J4 combines twelve such frames.  Instead of eleven full outer joins on six
keys (each a shuffle, each re-partitioning a growing frame), the wide frames
are packed as (date, level, segment, source, 48-value array), unioned, dealt
once by (date, level, segment) and grouped there; each source becomes one
column, and only then is the result exploded to 48 rows per key.  The single
shuffle moves one array per key and source instead of 48 keyed rows.

Where a count over the keys of the stored frames finds none twice (normally), that is
all.  A full join multiplies rows that repeat a key within a frame.  Such keys
are told apart by a count in the same grouping: their rows are numbered within their source, each combination of one row per source gets its
own number, and one join and one grouping by key and combination give the
product.  A null key component never matches in a join, so such rows are kept
apart per source, and one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import metrics as M
from ..schemas import TRANSPOSED_CMP, TRANSPOSED_TY
from .filters import since

LONG_KEYS = ("report_date", "filter_level", "segment")


def value_type(value_column: str):
    """This-year columns are wide decimals, changes are narrow."""
    return TRANSPOSED_TY if value_column.endswith("ty") else TRANSPOSED_CMP


def catalogue_rows(value_column: str) -> Column:
    """T2 as an array of structs, one per metric, carrying the row's value."""
    vt = value_type(value_column)
    return F.array(*[
        F.struct(
            F.lit(label).alias("metric"),
            F.col(source).cast(vt).alias(value_column),
            F.lit(order).alias("column_order"),
            F.lit(color).alias("color"),
        )
        for label, source, order, color in M.CATALOGUE
    ])


def transpose(df: DataFrame, value_column: str, as_of: Column) -> DataFrame:
    """T1 with F6: the last 91 days of one wide report, one row per metric."""
    recent = since(df, as_of, M.ROLLING_WINDOW_DAYS)
    return recent.select(*LONG_KEYS, F.inline(catalogue_rows(value_column)))


def pack(df: DataFrame, source: int | Column, value_column: str) -> DataFrame:
    """(date, level, segment, source number, 48 values) of a wide frame, cast as ``value_column`` is."""
    vt = value_type(value_column)
    values = F.array(*[F.col(c).cast(vt).cast(TRANSPOSED_TY) for _, c, _, _ in M.CATALOGUE])
    number = source if isinstance(source, Column) else F.lit(source)
    return df.select(*LONG_KEYS, number.alias("_src"), values.alias("_values"))


def _combined(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One row for each of ``keys``, with each source's values in a column of its own."""
    return rows.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_src") == i, F.col("_values"))).alias(n) for i, n in enumerate(names)],
        F.count("*").alias("_n"), F.bit_or(F.expr("shiftleft(1L, _src)")).alias("_sources"))


def _products(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Every combination of one row per source, for keys that a source has more than once.

    Combination c takes row (c / step) % n of a source that has n rows, where step is
    the product of the counts of the sources before it.
    """
    numbered = rows.withColumn("_i", F.row_number().over(
        Window.partitionBy(*keys, "_src").orderBy("_values")) - 1)
    counts = rows.groupBy(*keys, "_src").agg(F.count("*").alias("_of"))
    steps = counts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_src", "_of"))).alias("_counts"))  # 12 at most
    total = F.aggregate("_counts", F.lit(1).cast("long"), lambda a, c: a * c["_of"])
    each = steps.select(*keys, "_counts", F.explode(F.sequence(F.lit(0).cast("long"), total - 1)).alias("_c"))
    each = each.select(*keys, "_c", F.posexplode("_counts").alias("_k", "_one"), "_counts")
    step = F.aggregate(F.slice("_counts", F.lit(1), F.col("_k")), F.lit(1).cast("long"), lambda a, c: a * c["_of"])
    each = each.select(*[F.col(k).alias(f"r_{k}") for k in keys], "_c", F.col("_one._src").alias("r_src"),
                       F.pmod(F.floor(F.col("_c") / step), F.col("_one._of")).alias("r_i"))
    same = [F.col(k) == F.col(f"r_{k}") for k in keys]
    picked = numbered.join(each, [*same, F.col("_src") == F.col("r_src"), F.col("_i") == F.col("r_i")])
    return _combined(picked.select(*keys, "_c", "_src", "_values"), [*keys, "_c"], names)


def _repeats(frames: dict[str, DataFrame]) -> bool:
    """Whether some frame has a key twice, or a null in one: one grouped count over the key columns alone."""
    keys = reduce(DataFrame.unionByName, [df.select(*LONG_KEYS, F.lit(i).alias("_src")) for i, df in enumerate(frames.values())])
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in LONG_KEYS])
    counted = keys.groupBy(*LONG_KEYS, "_src").agg(F.count("*").alias("n"))
    return not counted.where((F.col("n") > 1) | null_key).isEmpty()


def combine(frames: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """J4 + T1 for all frames: {value column name: wide report} -> long table.

    The frames should be stored tables: whether they repeat a key is counted first,
    from their key columns, and normally none does.
    """
    recent = {n: since(df, as_of, M.ROLLING_WINDOW_DAYS) for n, df in frames.items()}
    packed = reduce(DataFrame.unionByName, [pack(df, i, n) for i, (n, df) in enumerate(recent.items())])
    return combine_packed(packed, list(frames)) if _repeats(recent) else combine_unique(packed, list(frames))


def _listed(rows: DataFrame, names: list[str]) -> DataFrame:
    """One row for each metric of rows that hold each source's values in an array."""
    metrics = F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(label).alias("metric"),
                 F.lit(order).alias("column_order"), F.lit(color).alias("color"))
        for i, (label, _, order, color) in enumerate(M.CATALOGUE)
    ])
    long = rows.select(*LONG_KEYS, *names, F.explode(metrics).alias("_m"))
    return long.select(
        *LONG_KEYS,
        F.col("_m.metric").alias("metric"),
        F.col("_m.column_order").alias("column_order"),
        F.col("_m.color").alias("color"),
        *[F.col(n)[F.col("_m.pos")].cast(value_type(n)).alias(n) for n in names],
    )


def combine_unique(packed: DataFrame, names: list[str]) -> DataFrame:
    """J4 + T1 of ``pack``ed frames none of which has a key twice, or a null in one.

    A key then has one row a source at most, and these are gathered by a hash
    aggregation, which neither sorts nor compares arrays.
    """
    gathered = packed.groupBy(*LONG_KEYS).agg(F.map_from_entries(F.collect_list(F.struct("_src", "_values"))).alias("_by"))
    return _listed(gathered.select(*LONG_KEYS, *[F.col("_by")[i].alias(n) for i, n in enumerate(names)]), names)


def combine_packed(packed: DataFrame, names: list[str]) -> DataFrame:
    """J4 + T1 of ``pack``ed frames; source i becomes the value column ``names[i]``."""
    keys = list(LONG_KEYS)
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    whole = packed.where(~null_key).repartition(*keys)  # one exchange for the groupings below
    grouped = _combined(whole, keys, names)
    repeated = F.col("_n") > F.bit_count("_sources")
    again = grouped.where(repeated).select(*[F.col(k).alias(f"d_{k}") for k in keys])
    several = whole.join(again, [F.col(k) == F.col(f"d_{k}") for k in keys], "left_semi")
    alone = packed.where(null_key).select(
        *keys, *[F.when(F.col("_src") == i, F.col("_values")).alias(n) for i, n in enumerate(names)])
    rows = grouped.where(~repeated).select(*keys, *names).unionByName(
        _products(several, keys, names).select(*keys, *names)).unionByName(alone)
    return _listed(rows, names)
