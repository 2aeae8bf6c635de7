"""Table specs and what is built from them: transforms, transfers, reports."""

from stratalift.plans.landing import landing_layer
from stratalift.plans.layers import CustomLayer, FileLayer, layers_from_config
from stratalift.plans.reports import display_layers, layer_checksum_diff, layer_row_counts
from stratalift.plans.spec import LABELS, LAYERS, LINEAGE, ColumnSpec, TableSpec
from stratalift.plans.transfers import (
    LineageError,
    MergeStep,
    RunOptions,
    TransferResult,
    audit_text,
    run_lineage,
    transfer,
)
from stratalift.plans.transforms import Changes, changes, transform
from stratalift.plans.sketches import keep_sketches, unique_over
from stratalift.plans.states import keep_states, kept_group_agg, merge_states, partial_states
from stratalift.plans.upkeep import refresh_gold, upsert_layer

__all__ = [
    "Changes",
    "ColumnSpec",
    "CustomLayer",
    "FileLayer",
    "LABELS",
    "LAYERS",
    "LINEAGE",
    "LineageError",
    "MergeStep",
    "RunOptions",
    "TableSpec",
    "TransferResult",
    "audit_text",
    "changes",
    "display_layers",
    "keep_sketches",
    "keep_states",
    "kept_group_agg",
    "landing_layer",
    "layer_checksum_diff",
    "layer_row_counts",
    "layers_from_config",
    "merge_states",
    "partial_states",
    "refresh_gold",
    "run_lineage",
    "transfer",
    "transform",
    "unique_over",
    "upsert_layer",
]
