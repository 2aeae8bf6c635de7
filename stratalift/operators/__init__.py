"""DataFrame-to-DataFrame operators."""

from stratalift.operators.differences import (
    different_leaves,
    digest_tree,
    read_tree,
    row_differences,
    write_tree,
)
from stratalift.operators.filters import filter_condition, filter_tree
from stratalift.operators.integrity import dataset_checksum, row_checksum
from stratalift.operators.merge import merge_rows, merge_sources
from stratalift.operators.metrics import (
    cast_failures,
    group_agg,
    quality_report,
    row_count,
    row_reconciliation,
)
from stratalift.operators.nearest import merge_asof, merge_ranges
from stratalift.operators.projections import (
    audit_columns,
    audit_last,
    cast_types,
    concat_separator,
    divide,
    drop_columns,
    exclude_row_columns,
    reformat_date,
    rename_columns,
    replace_text,
    split_column,
)
from stratalift.operators.rows import dedupe, distinct_values, page_rows, preview, sort_multi
from stratalift.operators.upserts import upsert, upsert_counts

__all__ = [
    "audit_columns",
    "audit_last",
    "cast_failures",
    "cast_types",
    "concat_separator",
    "dataset_checksum",
    "dedupe",
    "different_leaves",
    "digest_tree",
    "distinct_values",
    "divide",
    "drop_columns",
    "exclude_row_columns",
    "filter_condition",
    "filter_tree",
    "group_agg",
    "merge_asof",
    "merge_ranges",
    "merge_rows",
    "merge_sources",
    "page_rows",
    "preview",
    "quality_report",
    "read_tree",
    "reformat_date",
    "rename_columns",
    "replace_text",
    "row_checksum",
    "row_count",
    "row_differences",
    "row_reconciliation",
    "sort_multi",
    "split_column",
    "upsert",
    "upsert_counts",
    "write_tree",
]
