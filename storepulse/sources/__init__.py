"""Readers of the two report inputs, and their derivation from the test tables."""

from .fixtures import derive_report_base, derive_store_lookup
from .tables import read_report_base, read_store_lookup, read_table

__all__ = ["derive_report_base", "derive_store_lookup", "read_report_base",
           "read_store_lookup", "read_table"]
