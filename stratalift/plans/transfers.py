"""Moving a table one layer on, or along its whole lineage.

A hop reads its source once where it can: row counts, quality counts, failed casts
and the additive checksum are observed while the target is written. A hop that
sorts, merges or groups takes them in one aggregation before. Exact distinct
counts always scan their own columns. Only removing duplicates adds a staging
table, so that its shuffle runs once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from datetime import UTC, date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from stratalift.functions.columns import col
from stratalift.operators.filters import filter_condition
from stratalift.operators.integrity import (
    ROW_CHECKSUM,
    additive_digest,
    additive_sums,
    dataset_checksum,
    row_checksum,
)
from stratalift.operators.merge import merge_rows, merge_sources
from stratalift.operators.metrics import (
    REPORT_SCHEMA,
    QualityPlan,
    cast_failed,
    group_agg,
    plain_aggregates,
    profile,
    quality_entries,
    quality_plan,
    row_count,
    with_distinct,
)
from stratalift.operators.projections import audit_columns
from stratalift.operators.rows import dedupe
from stratalift.plans.layers import CustomLayer, FileLayer, Layer
from stratalift.plans.spec import LABELS, LINEAGE, MERGED_FROM, TRANSFORMED_FROM, TableSpec
from stratalift.plans.transforms import Changes, changes, transform, updates
from stratalift.sinks.catalog import append_audit, catalog_name, register_catalog, write_catalog
from stratalift.sinks.layers import current_path
from stratalift.staging import staged

KEPT = "__kept"

RUN_REPORT_SCHEMA = """
    family string, table_name string, source string, target string, mode string, run_by string,
    status int, started timestamp, ended timestamp, duration_seconds double,
    columns_added array<string>, columns_purged array<string>, columns_updated array<string>,
    columns_renamed map<string,string>, columns_total array<string>,
    rows_gross bigint, rows_net bigint, rows_duplicates bigint, rows_filtered bigint,
    rows_written bigint, cast_nulls map<string,bigint>,
    checksum string, checksum_mode string, hash string,
    catalog_failure string, failure string, run_id string
"""


@dataclass(frozen=True)
class MergeStep:
    """Another source for the merging hop: joined on keys, or appended without them."""

    other: DataFrame
    on: tuple[str, ...] = ()
    how: str = "inner"
    salts: int | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        if not self.on:
            return merge_rows(df, self.other)
        return merge_sources(df, self.other, self.on, self.how, self.salts)


@dataclass(frozen=True)
class RunOptions:
    run_date: date | str
    run_ts: datetime | str | None = None
    mode: str = "Live"
    caller: str = "Direct"
    runner: str | None = None
    pipeline: Mapping[str, str] | None = None
    quality: bool = True
    approx_distinct: bool = False
    integrity: bool = False
    checksum_mode: str = "additive"
    strict: bool = False
    merges: tuple[MergeStep, ...] = ()
    catalog: str | None = None
    audit_table: str | None = None
    # names a run, so that it can be taken up again
    run_id: str | None = None


@dataclass
class TransferResult:
    """``report`` has one row, ``quality`` one per check, ``table`` is what was written."""

    report: DataFrame
    quality: DataFrame
    table: DataFrame | None = None


class LineageError(RuntimeError):
    """Some tables of a lineage run failed; ``reports`` holds every hop's report, failed ones too."""

    def __init__(self, message: str, reports: DataFrame):
        super().__init__(message)
        self.reports = reports


def audit_text(spec: TableSpec, source: str, options: RunOptions) -> str:
    """Who moved the rows: source label, caller, and the runner or the pipeline run."""
    label = LABELS[source]
    if source == "DS":
        label = f"{spec.family} {label}"
    run = options.pipeline
    if run:
        return (
            f"{label} - {run['caller']} Pipeline - {run['name']} ({run['run_id']})"
            f" - {run['trigger_type']} ({run['triggered_on']})"
        )
    return " - ".join(part for part in (label, options.caller, options.runner) if part)


def transfer(
    spark: SparkSession,
    spec: TableSpec,
    source: str,
    target: str | None,
    layers: Mapping[str, Layer],
    options: RunOptions,
) -> TransferResult:
    """Move ``spec``'s table from ``source`` to ``target`` (default: the next layer).

    The transform runs on the way out of BL, merging and grouping out of SL. A
    failure is reported to the audit table, if there is one, and raised with the report
    as its ``report``; only a failed catalog registration is merely noted.
    """
    target = target or LINEAGE.get(source)
    if source not in LINEAGE or target not in LABELS or source == target:
        raise ValueError(f"no transfer from {source!r} to {target!r}")
    if source not in layers or target not in layers:
        raise ValueError(f"no table given for layer {source!r} or {target!r}")
    started = datetime.now(UTC)
    facts: dict[str, Any] = {
        "family": spec.family,
        "table_name": spec.table,
        "source": source,
        "target": target,
        "mode": options.mode,
        "run_by": audit_text(spec, source, options),
        "run_id": options.run_id,
        "started": started,
        "hash": "SHA-256" if options.integrity else None,
        "checksum_mode": options.checksum_mode if options.integrity else None,
    }
    try:
        quality, table = _hop(spark, spec, source, target, layers, options, facts)
    except Exception as error:
        facts.update(status=404, failure=f"{type(error).__name__}: {error}")
        error.report = _finish(spark, facts, options)
        raise
    facts.update(status=200)
    return TransferResult(_finish(spark, facts, options), quality, table)


def _hop(
    spark: SparkSession,
    spec: TableSpec,
    source: str,
    target: str,
    layers: Mapping[str, Layer],
    options: RunOptions,
    facts: dict[str, Any],
) -> tuple[DataFrame, DataFrame | None]:
    spec.check_types()
    read = layers[source].read(spark, options.run_date)
    if not (options.quality and spec.dedupe):
        return _move(spark, spec, source, target, layers, options, facts, read, None)
    with ExitStack() as tables:
        if isinstance(layers[source], CustomLayer):
            # an API or a database is asked once only
            read = tables.enter_context(staged(read, "source"))
        rows = dedupe(read, spec.dedupe_keys, spec.tie_break)
        if not _one_action(source, layers[target], options):
            rows = tables.enter_context(staged(rows, "unique"))
        gross = row_count(read)
        return _move(spark, spec, source, target, layers, options, facts, rows, gross)


def _one_action(source: str, place: Layer, options: RunOptions) -> bool:
    """Whether the target's write is all that reads the source rows.

    Untransformed rows are read back from the target for what the write cannot take along.
    """
    plain = source not in (TRANSFORMED_FROM, MERGED_FROM)
    return plain and isinstance(place, FileLayer)


def _move(
    spark: SparkSession,
    spec: TableSpec,
    source: str,
    target: str,
    layers: Mapping[str, Layer],
    options: RunOptions,
    facts: dict[str, Any],
    rows: DataFrame,
    gross: DataFrame | None,
) -> tuple[DataFrame, DataFrame | None]:
    place = layers[target]
    transforms = source == TRANSFORMED_FROM
    merges = source == MERGED_FROM and bool(options.merges or spec.group_aggs)
    probe = _Probe(rows, gross, spec, transforms, options)
    # Without a shuffle between source and files the writing tasks take the
    # profile along; each of them counts once, however often it is tried.
    # Otherwise a task that is run again would count again, so it is taken first.
    sorts = transforms and bool(spec.sort)
    along = isinstance(place, FileLayer) and not merges and not sorts
    rows, seen = probe.prepared, Observation(f"{spec.family}/{spec.table}/{source}")
    if along:
        rows = rows.observe(seen, *probe.aggregates())
    else:
        facts.update(probe.facts(probe.row()))
    rows = rows.drop(KEPT)
    touched = Changes()
    if transforms:
        touched = changes(rows.columns, spec)
        rows = transform(rows, spec)
    elif merges:
        for step in options.merges:
            rows = step.apply(rows)
        if spec.group_aggs:
            rows = group_agg(rows, spec.group_by, spec.group_aggs)
    rows = audit_columns(rows, facts["run_by"], options.run_ts)
    facts.update(
        columns_added=touched.added,
        columns_purged=touched.purged,
        columns_updated=touched.updated,
        columns_renamed=touched.renamed,
        columns_total=rows.columns,
    )
    if isinstance(place, FileLayer):
        written = Observation(f"{spec.family}/{spec.table}/{target}")
        place.write(rows.observe(written, F.count(F.lit(1)).alias("rows")), options.run_date)
        facts.update(rows_written=written.get["rows"])
    else:
        place.write(rows, options.run_date)
    if along:
        # untransformed rows are as good read from the target as from the source
        again = None if transforms else place.read(spark, options.run_date)
        facts.update(probe.facts(probe.row(seen.get, again)))
    if options.catalog:
        facts.update(catalog_failure=_catalog(spark, spec, target, place, rows, options))
    table = place.read(spark, options.run_date) if isinstance(place, FileLayer) else None
    return spark.createDataFrame(facts.pop("quality"), REPORT_SCHEMA), table


class _Probe:
    """What a hop wants to know about its source rows, and how it gets to know it."""

    def __init__(
        self,
        rows: DataFrame,
        gross: DataFrame | None,
        spec: TableSpec,
        transforms: bool,
        options: RunOptions,
    ):
        self.rows, self.gross, self.options = rows, gross, options
        self.plan = QualityPlan()
        if options.quality:
            checks = spec.quality_checks(rows.columns)
            self.plan = quality_plan(rows, checks, spec.expressions, options.approx_distinct)
        filters = transforms and spec.filter
        kept = filter_condition(rows, spec.filter) if filters else F.lit(True)
        # Columns of their own, so that a row evaluates each of them once.
        self.prepared = row_checksum(rows, options.strict) if options.integrity else rows
        self.prepared = self.prepared.withColumn(KEPT, kept)
        self.plan.plain["net"] = F.count_if(F.col(KEPT))
        self.casts: dict[str, str] = {}
        if transforms:
            self._count_casts(spec)
        self.additive = options.integrity and options.checksum_mode == "additive"
        if self.additive:
            self.plan.plain.update(additive_sums(ROW_CHECKSUM))

    def _count_casts(self, spec: TableSpec) -> None:
        new = updates(self.rows.columns, spec)
        for at, c in enumerate(spec.columns):
            if c.name in self.rows.columns and c.type != "string":
                kind = StringType() if c.name in new else self.rows.schema[c.name].dataType
                value = new.get(c.name, col(c.name))
                counts = cast_failed(value, kind, c.type, F.col(KEPT))
                for number, (path, count) in enumerate(counts.items()):
                    self.casts[f"{c.name}{path}"] = f"cast{at}_{number}"
                    self.plan.plain[f"cast{at}_{number}"] = count

    def aggregates(self) -> list[Column]:
        return [value.alias(name) for name, value in plain_aggregates(self.plan).items()]

    def row(
        self, seen: Mapping[str, Any] | None = None, again: DataFrame | None = None
    ) -> Row:
        """The whole profile.

        ``seen`` are plain aggregates that a write took along; whatever needs
        the rows once more then reads ``again``, if given, instead of the source.
        """
        if seen:
            schema = ", ".join(f"{name} bigint" for name in seen)
            known = self.rows.sparkSession.createDataFrame([tuple(seen.values())], schema)
            if again is not None:
                self.rows = self.prepared = again
            profiled = with_distinct(known, self.prepared, self.plan, self.gross)
        else:
            profiled = profile(self.prepared, self.plan, self.gross)
        checksum = additive_digest() if self.additive else F.lit(None).cast("string")
        entries = F.array(*quality_entries(self.plan))
        return profiled.select("*", entries.alias("quality"), checksum.alias("checksum")).first()

    def facts(self, row: Row) -> dict[str, Any]:
        checksum = row["checksum"]
        if self.options.integrity and not self.additive:
            mode = self.options.checksum_mode
            checksum = dataset_checksum(self.rows, mode, self.options.strict).first()["checksum"]
        return {
            "rows_gross": row["gross"],
            "rows_net": row["net"],
            "rows_duplicates": row["gross"] - row["rows"],
            "rows_filtered": row["rows"] - row["net"],
            "cast_nulls": {name: row[at] for name, at in self.casts.items()},
            "checksum": checksum,
            "quality": [tuple(entry) for entry in row["quality"]] if row["gross"] else [],
        }


def _catalog(
    spark: SparkSession,
    spec: TableSpec,
    target: str,
    place: Layer,
    rows: DataFrame,
    options: RunOptions,
) -> str | None:
    name = catalog_name(options.catalog, spec.family, spec.table, target)
    try:
        if isinstance(place, FileLayer):
            register_catalog(spark, name, current_path(spark, place.place(options.run_date)), place.fmt)
        else:
            write_catalog(rows, name)
    except Exception as error:  # the layer itself is written by now
        return f"{type(error).__name__}: {error}"
    return None


def _finish(spark: SparkSession, facts: dict[str, Any], options: RunOptions) -> DataFrame:
    ended = datetime.now(UTC)
    facts.update(ended=ended, duration_seconds=(ended - facts["started"]).total_seconds())
    schema = DataType.fromDDL(RUN_REPORT_SCHEMA)
    report = spark.createDataFrame([tuple(facts.get(f.name) for f in schema)], schema)
    if options.audit_table:
        append_audit(report, options.audit_table)
    return report


def run_lineage(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    layers: Mapping[str, Mapping[str, Layer]],
    options: RunOptions,
    lineage: Mapping[str, str] | None = None,
    skip: Sequence[str] = ("DZ",),
    workers: int = 1,
) -> DataFrame:
    """Transfer every table hop by hop; ``layers`` holds each table's own layers.

    The destination is left out unless ``skip`` says otherwise. A table stops
    at its first failure, the others go on; at the end a failure raises. Hops
    from or to a layer that the table does not have are left out. Returns the run
    reports, one row per hop.

    With ``workers`` so many tables run at once, each in a pool of its own, which a
    session with the FAIR scheduler serves alike. With a ``run_id`` and an audit table in the
    options, hops that this run has done by the audit table are not done again: a run that
    was ended half-way goes on behind its last whole hop, and their reports are those of then.
    """
    done = _done(spark, options)
    hops = lineage or LINEAGE

    def run(spec: TableSpec) -> tuple[list[tuple], str | None]:
        if workers > 1:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{spec.family}/{spec.table}")
        reports: list[tuple] = []
        for source, target in hops.items():
            if target in skip or not {source, target} <= layers[spec.table].keys():
                continue
            before = done.get((spec.family, spec.table, source, target))
            if before is not None:
                reports.append(before)
                continue
            try:
                result = transfer(spark, spec, source, target, layers[spec.table], options)
            except Exception as error:
                if hasattr(error, "report"):
                    reports.append(tuple(error.report.first()))
                return reports, f"{spec.family}/{spec.table} {source} to {target}: {error}"
            reports.append(tuple(result.report.first()))
        return reports, None

    if workers > 1:
        with ThreadPoolExecutor(workers) as pool:
            ended = list(pool.map(run, specs))
    else:
        ended = [run(spec) for spec in specs]
    result = spark.createDataFrame([row for rows, _ in ended for row in rows], RUN_REPORT_SCHEMA)
    failures = [failure for _, failure in ended if failure]
    if failures:
        raise LineageError("; ".join(failures), result)
    return result


def _done(spark: SparkSession, options: RunOptions) -> dict[tuple[str, str, str, str], tuple]:
    """The reports of the run's hops that the audit table knows as done, the latest of each."""
    if not (options.run_id and options.audit_table and spark.catalog.tableExists(options.audit_table)):
        return {}
    audit = spark.table(options.audit_table)
    if "run_id" not in audit.columns:
        return {}
    known = audit.where((F.col("run_id") == options.run_id) & (F.col("status") == 200)).orderBy("ended")
    names = [f.name for f in DataType.fromDDL(RUN_REPORT_SCHEMA)]
    return {(r["family"], r["table_name"], r["source"], r["target"]): tuple(r) for r in known.select(*names).collect()}
