"""DataFrame -> DataFrame operators of the report (filters, rollups, windows,
joins, reshape).  Each is a small function usable with ``df.transform``."""

from .compare import compare_last_year
from .filters import (filter_omni, filter_online, filter_stores, filter_valid_segment,
                      has_segment, is_omni, is_online, is_store, since, until)
from .levels import full_union, level_tags, rollup_levels
from .lookup import fits, prepare_lookup, with_open_date
from .periods import past_year_slice, period_start, period_to_date
from .transpose import combine, transpose

__all__ = [
    "compare_last_year", "filter_omni", "filter_online", "filter_stores", "filter_valid_segment",
    "has_segment", "is_omni", "is_online", "is_store", "since", "until", "full_union", "level_tags",
    "rollup_levels", "fits", "prepare_lookup", "with_open_date", "past_year_slice", "period_start",
    "period_to_date", "combine", "transpose",
]
