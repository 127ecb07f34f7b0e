"""Report writers (contract-checked, full refresh) and the reader of what they write."""

from .writer import read_report, write_report

__all__ = ["read_report", "write_report"]
