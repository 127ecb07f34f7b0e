"""DuckDB reference SQL for every registered query (the correctness oracle).

The oracle is written the plain way, independent of the Spark plans: the base
is ONE ``GROUP BY`` with ``COUNT(DISTINCT ...)`` over the joined lines, every
rollup level is its own ``GROUP BY`` branch of a ``UNION ALL``, last year is a
self ``LEFT JOIN``, and the long report is eleven ``FULL OUTER JOIN ... USING``
of transposed frames.  Only the fixed metric tables are shared with the
Spark code.

Rounding: DuckDB divides decimals in double precision, so ratios are computed
on exact integers (amounts in cents) and rounded HALF_UP by integer division.
The four count ratios that are doubles in Spark keep double arithmetic for
their percent change, rounded the way Spark rounds a double (HALF_UP on its
shortest decimal representation).
"""

from __future__ import annotations

import re
from collections import Counter

from . import metrics as M
from .schemas import COMPARISON, REPORT_BASE, STORE_LOOKUP, TRANSPOSED, measure_type, ty_contract
from .sources import fixtures as FX

AS_OF = "DATE '2001-08-01'"
SELF_MATCHED = ("daily", "week")
DOUBLE_KPIS = tuple(k.name for k in M.KPIS if k.double)


def _duck_type(dt) -> str:
    s = dt.simpleString()
    return {"date": "DATE", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}.get(s, s.upper())


def _cast_all(schema, src: str = "") -> str:
    p = f"{src}." if src else ""
    return ", ".join(f"CAST({p}{f.name} AS {_duck_type(f.dataType)}) AS {f.name}" for f in schema.fields)


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ---------------------------------------------------------------- arithmetic

def _cents(expr: str, column: str) -> str:
    """Exact integer in hundredths of the column's unit."""
    if column in M.COUNT_MEASURES:
        return f"(CAST({expr} AS HUGEINT) * 100)"
    return f"CAST({expr} * 100 AS HUGEINT)"


def _half_up(n: str, d: str) -> str:
    """round(n / d) HALF_UP (away from zero) on integers."""
    return f"(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))))"


def _hundredths(cents: str) -> str:
    return f"(CAST({cents} AS DECIMAL(38,0)) * 0.01)"


def kpi_sql(k: M.Kpi, p: str = "") -> str:
    col = (lambda c: f"{p}{c}")
    if k.per is None:
        return "(" + " + ".join(col(c) for c in k.plus) + "".join(f" - {col(c)}" for c in k.minus) + ")"
    num = " + ".join(_cents(col(c), c) for c in k.plus) + "".join(f" - {_cents(col(c), c)}" for c in k.minus)
    if k.pct:
        num = f"({num}) * 100"
    value = _hundredths(_half_up(f"({num}) * 100", _cents(col(k.per), k.per)))
    return f"CASE WHEN {col(k.per)} = 0 THEN 0 ELSE {value} END"


def _spark_round_double(x: str) -> str:
    return f"round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2)"


def growth_sql(c: str, a: str = "a", b: str = "b") -> str:
    ta, lb = f"{a}.{c}", f"{b}.{c}"
    if c in DOUBLE_KPIS:
        da, db = f"CAST({ta} AS DOUBLE)", f"CAST({lb} AS DOUBLE)"
        change = _spark_round_double(f"({da} - {db}) * 100 / {db}")
    elif c in M.COUNT_MEASURES:
        n = f"(CAST({ta} AS HUGEINT) - CAST({lb} AS HUGEINT)) * 100 * 100"
        change = _hundredths(_half_up(n, f"CAST({lb} AS HUGEINT)"))
    else:
        n = f"({_cents(ta, c)} - {_cents(lb, c)}) * 100 * 100"
        change = _hundredths(_half_up(n, _cents(lb, c)))
    return (f"CASE WHEN {lb} = 0 OR {lb} IS NULL OR {ta} IS NULL THEN NULL "
            f"ELSE least({M.GROWTH_LIMIT}, greatest({change}, -{M.GROWTH_LIMIT})) END")


# ---------------------------------------------------------------- CTE graph

class _Graph:
    def __init__(self):
        self.defs: dict[str, tuple[str, tuple[str, ...]]] = {}

    def add(self, name: str, sql: str, deps: tuple[str, ...] = ()):
        self.defs[name] = (sql, deps)

    def render(self, final: str, deps: tuple[str, ...]) -> str:
        order: list[str] = []

        def visit(n):
            if n in order:
                return
            for d in self.defs[n][1]:
                visit(d)
            order.append(n)

        for d in deps:
            visit(d)
        # what is read more than once is computed once, whatever statement the query is put into
        bodies = [final, *(self.defs[n][0] for n in order)]
        uses = Counter(w for b in bodies for w in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", b))
        ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if uses[n] > 1 else ''}(\n{self.defs[n][0]}\n)" for n in order)
        return f"WITH {ctes}\n{final}"


G = _Graph()

# Base derived from the test tables: one GROUP BY with distinct counts.
_fin = f"o.o_orderpriority IN ({_in(FX.FINANCED_PRIORITIES)})"
G.add("lines", f"""
SELECT CAST(o.o_orderdate AS DATE) AS odate, c.c_nationkey AS k, o.o_orderkey, o.o_custkey,
       o.o_orderstatus, o.o_orderpriority, {_fin} AS fin,
       o.o_orderpriority IN ({_in(FX.APPLICATION_PRIORITIES)}) AS app,
       CAST(l.l_extendedprice AS DECIMAL(15,2)) AS e,
       CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS net,
       CAST(l.l_extendedprice AS DECIMAL(15,2)) * {FX.COST_RATE} AS cost,
       CAST(l.l_quantity AS DECIMAL(15,2)) AS qty,
       abs(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))) AS days,
       CAST(l.l_tax AS DECIMAL(4,2)) AS taxrate,
       p.p_type IN ({_in(FX.FURNITURE_TYPES)}) AS fur,
       p.p_type IN ({_in(FX.BEDDING_TYPES)}) AS bed,
       p.p_type = '{FX.PROTECTION_TYPE}' AS promo,
       p.p_type = '{FX.DELIVERY_TYPE}' AS econ,
       NOT (p.p_type IN ({_in(FX.EXCLUDED_TYPES)})) AS inc,
       l.l_linestatus = 'F' AS dlv, l.l_returnflag = 'R' AS ret, l.l_discount > 0 AS disc
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey""")

G.add("base_agg", f"""
SELECT odate, k,
  COUNT(DISTINCT o_orderkey) AS carts,
  COUNT(DISTINCT CASE WHEN app THEN o_orderkey END) AS apps,
  COUNT(DISTINCT o_custkey) AS customers,
  COUNT(DISTINCT CASE WHEN fin THEN o_custkey END) AS fin_customers,
  COUNT(DISTINCT CASE WHEN disc THEN o_custkey END) AS disc_customers,
  COUNT(DISTINCT CASE WHEN inc THEN o_custkey END) AS inc_customers,
  SUM(net) AS s_net, SUM(cost) AS s_cost, SUM(net * taxrate) AS s_tax,
  SUM(CASE WHEN o_orderstatus = 'P' THEN net ELSE 0 END) AS deposit,
  SUM(CASE WHEN fur THEN net ELSE 0 END) AS s_fur,
  SUM(CASE WHEN bed THEN net END) AS s_bed,
  SUM(CASE WHEN promo THEN net ELSE 0 END) AS s_promo,
  SUM(CASE WHEN econ THEN net ELSE 0 END) AS s_econ,
  SUM(CASE WHEN fur THEN cost ELSE 0 END) AS c_fur,
  SUM(CASE WHEN bed THEN cost END) AS c_bed,
  SUM(CASE WHEN ret THEN net ELSE 0 END) AS s_ret,
  SUM(CASE WHEN fin THEN {FX.FINANCING_RATE} * net ELSE 0 END) AS fin_cost,
  SUM(CASE WHEN fin AND fur THEN {FX.FINANCING_RATE} * net ELSE 0 END) AS fin_fur,
  SUM(CASE WHEN fin AND bed THEN {FX.FINANCING_RATE} * net ELSE 0 END) AS fin_bed,
  SUM(CASE WHEN fin THEN net ELSE 0 END) AS fin_sales,
  SUM(CASE WHEN fin THEN net * {FX.FINANCED_SHARE} ELSE 0 END) AS fin_amt,
  SUM(CASE WHEN inc THEN net ELSE 0 END) AS inc_net,
  SUM(CASE WHEN inc THEN cost ELSE 0 END) AS inc_cost,
  SUM(CASE WHEN inc THEN e ELSE 0 END) AS inc_e,
  SUM(CASE WHEN inc AND NOT ret THEN net ELSE 0 END) AS inc_net_kept,
  SUM(CASE WHEN inc AND NOT ret THEN qty ELSE 0 END) AS inc_qty_kept,
  SUM(CASE WHEN dlv THEN net ELSE 0 END) AS dlv_net,
  SUM(CASE WHEN dlv THEN cost ELSE 0 END) AS dlv_cost,
  SUM(CASE WHEN dlv THEN qty ELSE 0 END) AS dlv_qty,
  SUM(CASE WHEN dlv THEN qty * days ELSE 0 END) AS dlv_wdays,
  SUM(CASE WHEN dlv AND bed THEN net ELSE 0 END) AS dlv_bed_net
FROM lines GROUP BY odate, k""", ("lines",))

_ON, _OM = FX.ONLINE_NATION, FX.OMNI_NATION
_store = f"NOT (b.k IN ({_ON}, {_OM}))"


def _pc(k: str) -> str:
    return (f"CASE WHEN {k} = {_ON} THEN '{M.ONLINE_PROFIT_CENTER}' WHEN {k} = {_OM} "
            f"THEN '{M.OMNI_PROFIT_CENTER}' ELSE CAST({k} + 100 AS VARCHAR) END")


_base_values = {
    "report_date": "b.odate", "ly_date": f"b.odate - {M.LY_SHIFT_DAYS}", "app_key": "b.k",
    "profit_center": _pc("b.k"),
    "custom_key": "concat_ws(';', b.odate, n.n_name)", "filter_level": "'Store'",
    "segment": "n.n_name", "store_name": "n.n_name", "region": "r.r_name",
    "market": "CASE WHEN b.k % 7 = 6 THEN 'n/a' ELSE 'M' || CAST(b.k % 7 AS VARCHAR) END",
    "traffic": f"CASE WHEN {_store} THEN 3 * b.carts ELSE 0 END",
    "total_sales_amt": "b.s_net",
    "stores_sales_amt": f"CASE WHEN {_store} THEN b.s_net ELSE 0 END",
    "online_sales_amt": f"CASE WHEN b.k = {_ON} THEN b.s_net ELSE 0 END",
    "omni_sales_amt": f"CASE WHEN b.k = {_OM} THEN b.s_net ELSE 0 END",
    "total_cogs": "b.s_cost", "total_cogs_stores": f"CASE WHEN {_store} THEN b.s_cost ELSE 0 END",
    "total_tax_amt": "b.s_tax", "total_deposit_amt": "b.deposit", "carts_count": "b.carts",
    "applications_count": "b.apps",
    "paid_hours": f"CASE WHEN {_store} THEN 8 * b.customers ELSE 0 END",
    "bedding_sales_amt": "b.s_bed", "protection_sales_amt": "b.s_promo",
    "furniture_sales_amt": "b.s_fur", "furniture_cogs": "b.c_fur", "bedding_cogs": "b.c_bed",
    "furniture_financing_cost": "b.fin_fur", "bedding_financing_cost": "b.fin_bed",
    "delivery_sales_amt": "b.s_econ", "cancelled_sales_amt": "b.s_ret",
    "sales_financed": "b.fin_sales", "customers_financed": "b.fin_customers",
    "total_financed_amt": "b.fin_amt", "total_financing_cost": "b.fin_cost",
    "unique_cust_count": "b.customers", "discounted_cust_count": "b.disc_customers",
    "all_sales_exc_ctgs": "b.inc_net", "all_cogs_exc_ctgs": "b.inc_cost",
    "all_promo_exc_ctgs": "b.inc_e", "cust_count_exc_ctgs": "b.inc_customers",
    "sales_exc_ctgs": "b.inc_net_kept", "qty_exc_ctgs": "b.inc_qty_kept",
    "sales_delivered": "b.dlv_net", "cogs_delivered": "b.dlv_cost", "qty_delivered": "b.dlv_qty",
    "weighted_days": "b.dlv_wdays", "bedding_sales_delivered": "b.dlv_bed_net",
}
G.add("base", "SELECT " + ", ".join(
    f"CAST({_base_values[f.name]} AS {_duck_type(f.dataType)}) AS {f.name}" for f in REPORT_BASE.fields
) + """
FROM base_agg b JOIN nation n ON b.k = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    ("base_agg",))

G.add("lookup", f"""
SELECT CAST(n_nationkey AS BIGINT) AS app_key,
       CAST({_pc('n_nationkey')} AS INTEGER) AS pft_ctr,
       CASE WHEN n_nationkey % 9 = 4 THEN NULL
            ELSE DATE '{FX.FIRST_OPEN_DATE}' + CAST(n_nationkey * {FX.OPEN_DATE_STEP_DAYS} AS INTEGER) END
         AS grand_open_date
FROM nation WHERE n_nationkey <> {FX.MISSING_LOOKUP_NATION}""")

G.add("past_year", f"""
SELECT *, report_date + {M.LY_SHIFT_DAYS} AS ny_date FROM base
WHERE report_date <= {AS_OF} - {M.PAST_YEAR_CUTOFF_DAYS}""", ("base",))

_KEYS = ", ".join(M.KEY_COLUMNS)
_MEAS = M.ADDITIVE_MEASURES


def _ptd(name: str, src: str, period: str, date_col: str):
    pcol = M.period_column(period)
    trunc = f"date_trunc('{period}', {date_col})"
    sums = ", ".join(
        f"SUM({c}) OVER (PARTITION BY {trunc}, store_name ORDER BY {date_col} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in _MEAS)
    G.add(name, f"SELECT report_date, ly_date, CAST({trunc} AS DATE) AS {pcol}, app_key, profit_center, "
                f"custom_key, filter_level, segment, store_name, region, market, {sums} FROM {src}", (src,))


def _with_open(name: str, src: str):
    G.add(name, f"""
SELECT s.*, COALESCE(l.grand_open_date, DATE '{M.DEFAULT_OPEN_DATE}') AS store_open_date
FROM {src} s LEFT JOIN lookup l
  ON s.app_key = l.app_key AND TRY_CAST(s.profit_center AS INTEGER) = l.pft_ctr""", (src, "lookup"))


_BRANCHES = (
    ("total", None),
    ("stores", f"NOT (profit_center IN ('{M.ONLINE_PROFIT_CENTER}', '{M.OMNI_PROFIT_CENTER}'))"),
    ("online", f"profit_center = '{M.ONLINE_PROFIT_CENTER}'"),
    ("omni", f"profit_center = '{M.OMNI_PROFIT_CENTER}'"),
)


def _rollup_branches(src: str, period: str, comp: bool) -> list[str]:
    pcol = M.period_column(period)
    gk = "report_date, ly_date" + (f", {pcol}" if pcol else "")
    if comp:
        sums = ", ".join(f"SUM(CASE WHEN ly_date >= store_open_date THEN {c} ELSE 0 END) AS {c}" for c in _MEAS)
    else:
        sums = ", ".join(f"SUM({c}) AS {c}" for c in _MEAS)
    out = []
    for code, cond in _BRANCHES:
        where = f"WHERE {cond}" if cond else ""
        out.append(
            f"SELECT {gk}, CAST(NULL AS BIGINT) AS app_key, CAST(NULL AS VARCHAR) AS profit_center, "
            f"concat_ws(';', report_date, '{code}') AS custom_key, 'Aggregated' AS filter_level, "
            f"'{code.title()}' AS segment, CAST(NULL AS VARCHAR) AS store_name, "
            f"CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS market, {sums} "
            f"FROM {src} {where} GROUP BY {gk}")
    for col in ("region", "market"):
        region = "region" if col == "region" else "CAST(NULL AS VARCHAR)"
        market = "market" if col == "market" else "CAST(NULL AS VARCHAR)"
        out.append(
            f"SELECT {gk}, CAST(NULL AS BIGINT) AS app_key, CAST(NULL AS VARCHAR) AS profit_center, "
            f"concat_ws(';', report_date, {col}) AS custom_key, '{col.title()}' AS filter_level, "
            f"{col} AS segment, CAST(NULL AS VARCHAR) AS store_name, {region} AS region, "
            f"{market} AS market, {sums} FROM {src} WHERE NOT (trim({col}) IN ('', 'n/a')) "
            f"GROUP BY {gk}, {col}")
    return out


def _rollups(name: str, src: str, period: str, comp: bool):
    G.add(name, "\nUNION ALL\n".join(_rollup_branches(src, period, comp)), (src,))


def _full_union(name: str, src: str, period: str, comp: bool):
    pcol = M.period_column(period)
    cols = list(M.KEY_COLUMNS) + ([pcol] if pcol else []) + list(_MEAS)
    _rollups(f"{name}_roll", src, period, comp)
    kpis = ", ".join(f"{kpi_sql(k)} AS {k.name}" for k in M.KPIS)
    G.add(name, f"SELECT *, {kpis} FROM (SELECT {', '.join(cols)} FROM {src} "
                f"UNION ALL SELECT {', '.join(cols)} FROM {name}_roll) u", (src, f"{name}_roll"))


def _compare(name: str, ty: str, prior: str, shifted: bool):
    """``prior`` is a frame of its own; where it is not shifted it holds the rows of ``ty`` again."""
    meets = f"report_date + {M.LY_SHIFT_DAYS}" if shifted else "report_date"
    src = f"(SELECT {meets} AS meets, segment, {', '.join(M.COMPARED_MEASURES)} FROM {prior})"
    cond = f"a.{'report_date' if shifted else 'ly_date'} = b.meets"
    keys = ", ".join(f"a.{c}" for c in M.COMPARE_KEY_COLUMNS)
    g = ", ".join(f"{growth_sql(c)} AS {c}" for c in M.COMPARED_MEASURES)
    G.add(name, f"SELECT {keys}, {g} FROM {ty} a LEFT JOIN {src} b ON {cond} AND a.segment = b.segment", (ty, prior))


def _since(name: str, src: str, days: int | None) -> str:
    """``src``, or its rows of the last ``days`` days under ``name``."""
    if days is None:
        return src
    G.add(name, f"SELECT * FROM {src} WHERE report_date >= {AS_OF} - {days}", (src,))
    return name


def _store_frames(period: str, suffix: str = "", days: int | None = None) -> tuple[str, str]:
    """Store rows of this year and last year as CTEs; with opening dates they are open_<name>.

    With ``days`` they are cut, after the running sums, to so many last days and those they are compared with.
    """
    tag = M.PERIOD_TAG[period] + suffix

    def running(name: str, src: str, date_col: str) -> str:
        if period == "daily":
            G.add(name, f"SELECT * FROM {src}", (src,))
        else:
            _ptd(name, src, period, date_col)
        return name

    shifted = period not in SELF_MATCHED
    now = _since(f"cut_{tag}", running(f"ptd_{tag}", "base", "report_date"), days)
    # last year's side is built from the base again where its rows are those of this year, so no frame meets itself
    last = running(f"sptd_{tag}", "past_year" if shifted else "base", "ny_date" if shifted else "report_date")
    last = _since(f"scut_{tag}", last, None if days is None else days + M.LY_SHIFT_DAYS)
    for name in (now, last):
        _with_open(f"open_{name}", name)
    return now, last


def _build_period(period: str):
    """CTEs ty_<tag>, ly_<tag>, comp_<tag> (and helpers)."""
    tag, shifted = M.PERIOD_TAG[period], period not in SELF_MATCHED
    now, last = _store_frames(period)
    _full_union(f"ty_{tag}", now, period, False)
    _full_union(f"cty_{tag}", f"open_{now}", period, True)
    _full_union(f"sty_{tag}", last, period, False)
    _full_union(f"scty_{tag}", f"open_{last}", period, True)
    _compare(f"ly_{tag}", f"ty_{tag}", f"sty_{tag}", shifted)
    _compare(f"comp_{tag}", f"cty_{tag}", f"scty_{tag}", shifted)


for _p in M.PERIODS:
    _build_period(_p)

_TAGS = "period, comp, meets, report_date, ly_date"


def _stacked(name: str, frames: list[tuple[str, str, str]]):
    """All levels and KPIs of several frames (period, store rows with opening dates, date to meet on), with and without the mask."""
    G.add(f"{name}_stores", "\nUNION ALL\n".join(
        f"SELECT '{period}' AS period, {meets} AS meets, report_date, ly_date, profit_center, region, market, filter_level, segment, "
        f"store_open_date, {', '.join(_MEAS)} FROM {src}" for period, src, meets in frames), tuple(src for _, src, _ in frames))
    G.add(f"{name}_both", f"SELECT * FROM {name}_stores CROSS JOIN (VALUES (FALSE), (TRUE)) AS masks(comp)", (f"{name}_stores",))
    sums = ", ".join(f"SUM(CASE WHEN NOT comp OR ly_date >= store_open_date THEN {c} ELSE 0 END) AS {c}" for c in _MEAS)
    branches = [f"SELECT {_TAGS}, 'Aggregated' AS filter_level, '{code.title()}' AS segment, {sums} FROM {name}_both "
                f"{f'WHERE {cond}' if cond else ''} GROUP BY {_TAGS}" for code, cond in _BRANCHES]
    branches += [f"SELECT {_TAGS}, '{col.title()}' AS filter_level, {col} AS segment, {sums} FROM {name}_both "
                 f"WHERE NOT (trim({col}) IN ('', 'n/a')) GROUP BY {_TAGS}, {col}" for col in ("region", "market")]
    branches.append(f"SELECT {_TAGS}, filter_level, segment, {', '.join(_MEAS)} FROM {name}_both")
    G.add(f"{name}_levels", "\nUNION ALL\n".join(branches), (f"{name}_both",))
    kpis = ", ".join(f"{kpi_sql(k)} AS {k.name}" for k in M.KPIS)
    G.add(name, f"SELECT *, {kpis} FROM {name}_levels", (f"{name}_levels",))


def _values(value_type: str) -> str:
    return "[" + ", ".join(f"CAST({c} AS {value_type})" for _, c, _, _ in M.CATALOGUE) + "]"


# The long report: transposed frames joined by the six keys.
_CAT_VALUES = ", ".join(f"('{label}', '{src}', {order}, '{color}')" for label, src, order, color in M.CATALOGUE)
G.add("catalogue", f"SELECT * FROM (VALUES {_CAT_VALUES}) AS t(metric, source, column_order, color)")


def _transpose(name: str, src: str, value_col: str):
    vt = "DECIMAL(21,2)" if value_col.endswith("ty") else "DECIMAL(10,2)"
    case = " ".join(f"WHEN '{c}' THEN CAST(f.{c} AS {vt})" for _, c, _, _ in M.CATALOGUE)
    G.add(name, f"""
SELECT f.report_date, f.filter_level, f.segment, m.metric, CAST(m.column_order AS INTEGER) AS column_order,
       m.color, CASE m.source {case} END AS {value_col}
FROM {src} f CROSS JOIN catalogue m
WHERE f.report_date >= {AS_OF} - {M.ROLLING_WINDOW_DAYS}""", (src, "catalogue"))


_transpose("t_daily_ty", "ty_daily", "daily_ty")


# One frame holds all periods with and without the mask, for the text to stay short.  A wide row has each metric
# once, so joining the wide rows and then listing their metrics gives the rows that joining the listed metrics would.
_frames = {p: _store_frames(p, "_shown", M.ROLLING_WINDOW_DAYS) for p in M.PERIODS}
_stacked("now", [(p, f"open_{now}", "ly_date" if p in SELF_MATCHED else "report_date") for p, (now, _) in _frames.items()])
_stacked("last", [(p, f"open_{last}", "report_date" if p in SELF_MATCHED else f"report_date + {M.LY_SHIFT_DAYS}")
                  for p, (_, last) in _frames.items()])
G.add("changes", "SELECT a.period, a.comp, a.report_date, a.filter_level, a.segment, "
      + ", ".join(f"{growth_sql(c)} AS {c}" for c in M.COMPARED_MEASURES)
      + " FROM now a LEFT JOIN last b ON a.period = b.period AND a.comp = b.comp AND a.meets = b.meets AND a.segment = b.segment",
      ("now", "last"))
G.add("now_values", f"SELECT period, report_date, filter_level, segment, {_values('DECIMAL(21,2)')} AS metrics FROM now WHERE NOT comp", ("now",))
G.add("change_values", f"SELECT period, comp, report_date, filter_level, segment, {_values('DECIMAL(10,2)')} AS metrics FROM changes", ("changes",))
_names = [f"{M.PERIOD_TAG[p]}_{v}" for p in M.PERIODS for v in ("ty", "ly", "comp")]
for _p in M.PERIODS:
    for _v, _src, _which in (("ty", "now_values", ""), ("ly", "change_values", " AND NOT comp"), ("comp", "change_values", " AND comp")):
        _n = f"{M.PERIOD_TAG[_p]}_{_v}"
        G.add(f"w_{_n}", f"SELECT report_date, filter_level, segment, metrics AS {_n} FROM {_src} WHERE period = '{_p}'{_which}", (_src,))
G.add("joined", "SELECT * FROM w_" + _names[0] + "".join(
    f"\nFULL OUTER JOIN w_{n} USING (report_date, filter_level, segment)" for n in _names[1:]), tuple(f"w_{n}" for n in _names))
G.add("numbered", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{label}', {order}, '{color}')" for i, (label, _, order, color) in enumerate(M.CATALOGUE, 1))
    + ") AS t(place, metric, column_order, color)")
G.add("combined", "SELECT report_date, filter_level, segment, metric, column_order, color, "
      + ", ".join(f"{n}[place] AS {n}" for n in _names) + " FROM joined CROSS JOIN numbered", ("joined", "numbered"))


# ---------------------------------------------------------------- queries

def _select(schema, src: str, where: str = "") -> tuple[str, tuple[str, ...]]:
    return f"SELECT {_cast_all(schema)} FROM {src} {where}", (src,)


def _measure_cast(cols) -> str:
    return ", ".join(f"CAST({c} AS {_duck_type(measure_type(c))}) AS {c}" for c in cols)


_ROLL_KEYS = ("report_date", "ly_date", "filter_level", "segment", "custom_key", "region", "market")


def _rollup_query(src: str, segment: str | None, period: str = "daily", level: str | None = None):
    pcol = M.period_column(period)
    keys = list(_ROLL_KEYS) + ([pcol] if pcol else [])
    cond = f"filter_level = '{level}'" if level else f"filter_level = 'Aggregated' AND segment = '{segment}'"
    return (f"SELECT {', '.join(keys)}, {_measure_cast(_MEAS)} FROM {src} WHERE {cond}", (src,))


def _ptd_query(src: str, period: str):
    pcol = M.period_column(period)
    return (f"SELECT {_KEYS}, {pcol}, {_measure_cast(_MEAS)} FROM {src}", (src,))


_QUERIES: dict[str, tuple[str, tuple[str, ...]]] = {
    "scan_report_base": _select(REPORT_BASE, "base"),
    "scan_store_lookup": _select(STORE_LOOKUP, "lookup"),
    "past_year_slice": (f"SELECT {_cast_all(REPORT_BASE)}, ny_date FROM past_year", ("past_year",)),
    "filter_stores": _select(REPORT_BASE, "base",
                             f"WHERE NOT (profit_center IN ('{M.ONLINE_PROFIT_CENTER}', '{M.OMNI_PROFIT_CENTER}'))"),
    "filter_online": _select(REPORT_BASE, "base", f"WHERE profit_center = '{M.ONLINE_PROFIT_CENTER}'"),
    "filter_omni": _select(REPORT_BASE, "base", f"WHERE profit_center = '{M.OMNI_PROFIT_CENTER}'"),
    "filter_valid_segment": _select(REPORT_BASE, "base", "WHERE NOT (trim(market) IN ('', 'n/a'))"),
    "rollup_total": _rollup_query("ty_daily_roll", "Total"),
    "rollup_stores": _rollup_query("ty_daily_roll", "Stores"),
    "rollup_online": _rollup_query("ty_daily_roll", "Online"),
    "rollup_omni": _rollup_query("ty_daily_roll", "Omni"),
    "rollup_region": _rollup_query("ty_daily_roll", None, level="Region"),
    "rollup_market": _rollup_query("ty_daily_roll", None, level="Market"),
    "comp_rollup": (f"SELECT {', '.join(_ROLL_KEYS)}, {_measure_cast(_MEAS)} FROM cty_daily_roll",
                    ("cty_daily_roll",)),
    "wtd_total": _rollup_query("ty_wtd_roll", "Total", "week"),
    "mtd_total": _rollup_query("ty_mtd_roll", "Total", "month"),
    "ytd_total": _rollup_query("ty_ytd_roll", "Total", "year"),
    "kpi_store_daily": (
        f"SELECT {_KEYS}, " + ", ".join(
            f"CAST({kpi_sql(k)} AS {_duck_type(measure_type(k.name))}) AS {k.name}" for k in M.KPIS)
        + " FROM base", ("base",)),
    "wtd_running": _ptd_query("ptd_wtd", "week"),
    "mtd_running": _ptd_query("ptd_mtd", "month"),
    "ytd_running": _ptd_query("ptd_ytd", "year"),
    "mtd_running_shifted": _ptd_query("sptd_mtd", "month"),
    "ytd_running_shifted": _ptd_query("sptd_ytd", "year"),
    "comp_prep": (f"SELECT {_cast_all(REPORT_BASE)}, store_open_date FROM open_ptd_daily", ("open_ptd_daily",)),
    "transpose_daily_ty": ("SELECT report_date, filter_level, segment, metric, column_order, color, daily_ty "
                           "FROM t_daily_ty", ("t_daily_ty",)),
}
for _p in M.PERIODS:
    _t = M.PERIOD_TAG[_p]
    _QUERIES[f"{_t}_report"] = _select(ty_contract(_p), f"ty_{_t}")
    _QUERIES[f"ly_{_t}_report"] = _select(COMPARISON, f"ly_{_t}")
    _QUERIES[f"comp_{_t}_report"] = _select(COMPARISON, f"comp_{_t}")
_QUERIES["combined_transposed_report"] = _select(TRANSPOSED, "combined")


def oracle_sql() -> dict[str, str]:
    return {name: G.render(final, deps) for name, (final, deps) in _QUERIES.items()}
