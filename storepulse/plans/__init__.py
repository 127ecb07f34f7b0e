"""Report plans: R1-R13 as compositions, and the end-to-end job."""

from .reports import COMBINED_TABLE, Reports, combined_first_date, date_literal, run_job, table_name

__all__ = ["COMBINED_TABLE", "Reports", "combined_first_date", "date_literal", "run_job", "table_name"]
