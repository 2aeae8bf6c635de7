"""Writing layers, catalog tables, databases and the audit trail."""

from stratalift.sinks.catalog import (
    append_audit,
    catalog_name,
    register_catalog,
    write_bucketed,
    write_catalog,
)
from stratalift.sinks.clustered import write_clustered
from stratalift.sinks.jdbc import write_jdbc
from stratalift.sinks.layers import current_path, dated_snapshot, publish_layer, write_layer

__all__ = [
    "append_audit",
    "catalog_name",
    "current_path",
    "dated_snapshot",
    "publish_layer",
    "register_catalog",
    "write_bucketed",
    "write_catalog",
    "write_clustered",
    "write_jdbc",
    "write_layer",
]
