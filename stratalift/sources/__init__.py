"""Reading layers, report queries and paged sources."""

from stratalift.sources.layers import (
    date_window,
    dimension_in_list,
    incremental_window,
    non_empty,
    read_dated,
    read_layer,
    string_landing,
)
from stratalift.sources.paged import PageRequest, paged_source, read_pages
from stratalift.sources.reports import report_query

__all__ = [
    "PageRequest",
    "date_window",
    "dimension_in_list",
    "incremental_window",
    "non_empty",
    "paged_source",
    "read_dated",
    "read_layer",
    "read_pages",
    "report_query",
    "string_landing",
]
