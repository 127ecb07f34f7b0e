"""storepulse: retail KPI reporting on Spark DataFrames.

From a store-by-day fact table and a store dimension, build daily and
period-to-date reports at store, total, channel, region and market level,
33 derived KPIs, year-over-year and comparable-store changes, and one long
table combining them.
"""

from . import metrics, schemas
from .plans import Reports, run_job

__all__ = ["metrics", "schemas", "Reports", "run_job"]
