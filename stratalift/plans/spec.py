"""Table specs: which columns a table has and what happens to them on their way."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from stratalift.functions.types import spark_type
from stratalift.operators.filters import Tree
from stratalift.sources.paged import PAGE_ROWS

# The layers in order, where each one leads, and their labels.
LAYERS = ("DS", "LZ", "RZ", "BL", "SL", "GL", "DZ")
LINEAGE = {"DS": "LZ", "LZ": "RZ", "RZ": "BL", "BL": "SL", "SL": "GL", "GL": "DZ"}
LABELS = {
    "DS": "API",
    "LZ": "EDLZ",
    "RZ": "Raw Zone",
    "BL": "Bronze Layer",
    "SL": "Silver Layer",
    "GL": "Gold Layer",
    "DZ": "SQL Server",
}
TRANSFORMED_FROM = "BL"
MERGED_FROM = "SL"
# The named expression every spec knows.
EXPRESSIONS = {"alphanumeric": r"^[a-zA-Z0-9]+$"}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "string"
    drop: bool = False
    rename: str | None = None
    quality: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    """One logical table of a family.

    ``metrics`` come before ``dimensions`` wherever columns are walked, except
    in the landing order. The remaining fields are the steps of the transform,
    each empty by default; see :func:`stratalift.plans.transforms.transform`.
    """

    family: str
    table: str
    dimensions: tuple[ColumnSpec, ...] = ()
    metrics: tuple[ColumnSpec, ...] = ()
    filter: Tree = field(default_factory=dict)
    compact_dates: tuple[str, ...] = ()
    concat_separator: Mapping[str, Mapping[str, Mapping[int, int]]] = field(default_factory=dict)
    replace: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    divide: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    split: Mapping[str, Mapping[str, Mapping[str, int]]] = field(default_factory=dict)
    group_by: tuple[str, ...] = ()
    group_aggs: Mapping[str, str] = field(default_factory=dict)
    sort: Mapping[str, str] = field(default_factory=dict)
    dedupe: bool = False
    dedupe_keys: tuple[str, ...] | None = None
    tie_break: Mapping[str, str] = field(default_factory=dict)
    # what the source API is asked for; without a first day only the days not landed yet
    start_date: str | None = None
    end_date: str | None = None
    fetch_offset: int = 0
    fetch_limit: int = PAGE_ROWS
    in_lists: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    expressions: Mapping[str, str] = field(default_factory=lambda: dict(EXPRESSIONS))

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if len(set(names)) < len(names):
            raise ValueError(f"{self.family}/{self.table} declares a column twice")

    @property
    def columns(self) -> tuple[ColumnSpec, ...]:
        return self.metrics + self.dimensions

    @property
    def landing_order(self) -> list[str]:
        return [c.name for c in self.dimensions + self.metrics]

    def check_types(self) -> None:
        """Raise on a type name Spark does not know."""
        for column in self.columns:
            spark_type(column.type)

    def quality_checks(self, columns: Sequence[str]) -> dict[str, tuple[str, ...]]:
        """Checks of the columns present, found under their new name where one was renamed."""
        checks = {}
        for column in self.columns:
            present = column.name if column.name in columns else column.rename
            if column.quality and present in columns:
                checks[present] = column.quality
        return checks

    @classmethod
    def from_config(
        cls,
        family: str,
        table: str,
        config: Mapping[str, Any],
        expressions: Mapping[str, str] | None = None,
        compact_dates: Iterable[str] = (),
    ) -> TableSpec:
        """Read a nested configuration.

        Below ``Schema`` it has ``Dimensions`` and ``Metrics`` (``Type``,
        ``Drop``, ``Rename``, ``Quality`` per column), ``Transformation``
        (``Filter``, ``New``, ``Update``, ``Group``, ``Sort``) and ``Quality``
        (``Duplicates``: ``Remove``, ``Fields``). ``API`` may have
        ``StartDate``, ``EndDate``, ``Fetch_Offset``, ``Fetch_Limit`` and a
        ``Filter`` by ``DimensionInList``. Sets are put in order, so that a run
        does not depend on how they iterate.
        """
        schema = config["Schema"]
        steps = schema.get("Transformation") or {}
        new = steps.get("New") or {}
        update = steps.get("Update") or {}
        group = steps.get("Group") or {}
        duplicates = (schema.get("Quality") or {}).get("Duplicates") or {}
        fields = _listed(duplicates.get("Fields"))
        api = config.get("API") or {}
        in_lists = (api.get("Filter") or {}).get("DimensionInList") or {}
        return cls(
            family=family,
            table=table,
            dimensions=_columns(schema.get("Dimensions")),
            metrics=_columns(schema.get("Metrics")),
            filter=steps.get("Filter") or {},
            compact_dates=tuple(compact_dates),
            concat_separator=update.get("ConcatSeparator") or {},
            replace=update.get("Replace") or {},
            divide=new.get("Divide") or {},
            split=new.get("Split") or {},
            group_by=_listed(group.get("By")),
            group_aggs=group.get("Agg") or {},
            sort=steps.get("Sort") or {},
            dedupe=bool(duplicates.get("Remove")) and bool(fields),
            dedupe_keys=None if "*" in fields else fields or None,
            start_date=api.get("StartDate"),
            end_date=api.get("EndDate"),
            fetch_offset=api.get("Fetch_Offset", 0),
            fetch_limit=api.get("Fetch_Limit", PAGE_ROWS),
            in_lists={name: _listed(values) for name, values in in_lists.items()},
            expressions={**EXPRESSIONS, **(expressions or {})},
        )


def _listed(values: Iterable[str] | None) -> tuple[str, ...]:
    values = values or ()
    return tuple(sorted(values) if isinstance(values, (set, frozenset)) else values)


def _columns(config: Mapping[str, Mapping[str, Any]] | None) -> tuple[ColumnSpec, ...]:
    return tuple(
        ColumnSpec(
            name=name,
            type=entry.get("Type", "string"),
            drop=entry.get("Drop") is True,
            rename=entry.get("Rename"),
            quality=_listed(entry.get("Quality")),
        )
        for name, entry in (config or {}).items()
    )
