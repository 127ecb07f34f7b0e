"""Expression helpers (SQL text + Columns): rounding, KPIs, growth."""

from .arith import clamp, guarded, q, round_ratio
from .growth import growth, growth_sql
from .kpis import kpi_column, kpi_columns, kpi_sql, with_kpis

__all__ = ["clamp", "guarded", "q", "round_ratio", "growth", "growth_sql", "kpi_column",
           "kpi_columns", "kpi_sql", "with_kpis"]
