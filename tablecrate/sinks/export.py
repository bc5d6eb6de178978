"""Export: many selected tables and views as one verified snapshot folder.

Layout: `<out>/<id>/ddl/NNNN__schema.name.sql`, `<out>/<id>/data/NNNN__schema.name/`,
`<out>/<id>/inputs/` (the pinned source files), `<out>/<id>/files/` (file ledgers) and
`<out>/manifest.json`. The manifest is written last and replaces its predecessor in one
step, so a failed export leaves the former snapshot as it was.
"""

from __future__ import annotations

import threading
import time
import uuid
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablecrate.config import General, JobConfig, ObjectConfig
from tablecrate.errors import CrateError
from tablecrate.functions import seal
from tablecrate.functions.digest import row_hash_sum
from tablecrate.functions.names import backtick_path, spark_literal
from tablecrate.plans.export_plan import expand
from tablecrate.plans.pins import Pin, pin, read_pins, require_unchanged
from tablecrate.session import scratch_scope, sized_shuffles
from tablecrate.sinks.parallel import in_parallel
from tablecrate.sources import ledger, manifests, payload, relations
from tablecrate.sources.files import MetadataFiles
from tablecrate.sources.lookup import find_source
from tablecrate.sources.manifests import Inputs, Manifest, ManifestObject, ObjectColumn, Place, ViewDefinition
from tablecrate.sources.relations import Column, Relation

INPUTS = "inputs"  # the run's table of pinned source files


@dataclass(frozen=True)
class _Source:
    item: ObjectConfig
    relation: Relation
    rows: DataFrame


def version_number(spark: SparkSession) -> int:
    major, minor, patch = (int(part) for part in spark.version.split("-")[0].split(".")[:3])
    return major * 10_000 + minor * 100 + patch


def export_snapshot(
    spark: SparkSession,
    config: JobConfig,
    out: str,
    *,
    password: str | None = None,
    connection_options: dict[str, str] | None = None,
) -> Manifest:
    """`spark` must come from `job_session`. With `connection_options` the sources are
    read over JDBC instead of from the catalog."""
    general = config.general
    out = out.rstrip("/")
    salt = seal.new_salt() if password is not None else None
    key = seal.derive_key(password, salt) if password is not None else None
    pinned = general.consistent_snapshot and connection_options is None

    def resolve(item: ObjectConfig) -> _Source:
        return _resolve(spark, item, connection_options)

    planned = (
        expand(spark, config.objects) if connection_options is None else list(config.objects)
    )
    # All inputs are analyzed before the first row is written; see plans.pins.
    sources = [resolve(item) for item in planned]
    inputs = [source.rows for source in sources if source.item.export_as == "table"]
    run_id = uuid.uuid4().hex
    before = _pinned(spark, inputs, f"{out}/{run_id}", key) if pinned else None
    read_bytes = 0 if before is None else before.bytes

    def export_one(position: int) -> ManifestObject:
        def attempt(number: int) -> ManifestObject:
            fresh = number > 1 and not pinned
            source = resolve(planned[position - 1]) if fresh else sources[position - 1]
            return _write_object(spark, source, out, run_id, position, number, general, key)

        return _with_attempts(spark, attempt, general, ".".join(planned[position - 1].source))

    try:
        with sized_shuffles(spark, read_bytes):
            positions = range(1, len(planned) + 1)
            objects = in_parallel(spark, export_one, positions, general.workers())
        if before is not None:
            require_unchanged(spark, before, key)
    except BaseException:
        MetadataFiles(spark).delete_tree(f"{out}/{run_id}")
        raise
    manifest = Manifest(
        written=datetime.now(timezone.utc).isoformat(timespec="seconds"),
        engine=version_number(spark),
        session=f"catalog={spark.catalog.currentCatalog()}"
        f" user={spark.sql('SELECT current_user()').first()[0]}",
        payload_format=general.data_format,
        consistent=pinned and all(map(_has_files, sources)),
        objects=objects,
        inputs=None if before is None else Inputs(before.files, before.bytes, before.fingerprint),
    )
    manifests.publish(spark, out, manifest, key, salt)
    return manifest


def _pinned(spark: SparkSession, inputs: list[DataFrame], run: str, key: bytes | None) -> Pin:
    try:
        return pin(spark, inputs, f"{run}/{INPUTS}", key)
    except BaseException:
        MetadataFiles(spark).delete_tree(run)
        raise


def pinned_inputs(spark: SparkSession, snapshot: manifests.Snapshot) -> DataFrame:
    """path, bytes, modified: the source files a consistent snapshot was read from."""
    run = manifests.run_folder(spark, snapshot.path)
    place = f"{snapshot.path}/{run}/{INPUTS}"
    if not MetadataFiles(spark).exists(f"{place}/_SUCCESS"):
        raise CrateError(f"{snapshot.path} was exported without pinned inputs")
    return read_pins(spark, place, snapshot.key)


def _has_files(source: _Source) -> bool:
    """Whether pinned files prove the rows: a view may have none, such as one of rand()."""
    stored = source.item.export_as == "view" or source.relation.kind == "table"
    return stored or bool(source.rows.inputFiles())


def _resolve(
    spark: SparkSession, item: ObjectConfig, connection: dict[str, str] | None
) -> _Source:
    if connection is not None and item.export_as == "view":
        raise CrateError("a view definition cannot be exported over JDBC")
    relation, rows = find_source(spark, *item.source, connection, item.key_range)
    return _Source(item, relation, rows)


def _write_object(
    spark: SparkSession,
    source: _Source,
    out: str,
    run_id: str,
    position: int,
    attempt: int,
    general: General,
    key: bytes | None,
) -> ManifestObject:
    item, relation = source.item, source.relation
    stem = f"{position:04d}__{relations.safe_file_name('.'.join(item.source))}"
    ddl_path, data_path = f"{run_id}/ddl/{stem}.sql", f"{run_id}/data/{stem}"
    if attempt > 1:
        data_path += f"__{attempt}"
    names = item.selection.effective_columns(relation.column_names)
    by_name = {column.name: column for column in relation.columns}
    columns = [by_name[name] for name in names]

    counts = {}
    if item.export_as == "table":
        with scratch_scope(spark):
            selected = item.selection.rows(source.rows)
            # Counted and hashed in the write's own last stage: no second pass, and a task
            # that runs twice is counted once.
            seen = Observation()
            observed = selected.observe(
                seen, F.count(F.lit(1)).alias("rows"), row_hash_sum(selected).alias("checksum")
            )
            payload.write(observed, f"{out}/{data_path}", general.data_format, key)
        if general.file_ledger:
            stored = selected.schema, general.data_format, key is not None
            ledger.write(spark, out, data_path, *stored, ".".join(item.target_or_source))
        counts = {"rows": seen.get["rows"], "checksum": str(seen.get["checksum"])}

    is_view = item.export_as == "view"
    ddl = (
        f"CREATE VIEW {backtick_path(*item.target_or_source)} AS\n{_view_body(relation)};\n"
        if is_view
        else table_ddl(*item.target_or_source, columns) + ";\n"
    )
    ddl_text = seal.seal_text(spark, ddl, key) if key is not None else ddl
    MetadataFiles(spark).write(f"{out}/{ddl_path}", ddl_text)
    view = ViewDefinition(_view_body(relation), relation.view_namespace, relation.view_settings) if is_view else None
    return ManifestObject(
        source=Place(*item.source),
        target=Place(*item.target_or_source),
        kind=relation.kind,
        select=item.selection.text,
        columns=[_column(column, is_view) for column in columns],
        ddl=ddl_path,
        payload=data_path,
        estimate=None if is_view else relation.row_estimate,
        comment=relation.comment,
        view=view,
        **counts,
    )


def _column(column: Column, is_view: bool) -> ObjectColumn:
    """A view's columns are described, but what binds rows belongs to the tables below it."""
    described = ObjectColumn(column.name, column.type_text, comment=column.comment or None, labels=list(column.labels))
    if is_view:
        return described
    return replace(described, required=column.not_null, key=column.key, default=column.default)


def _view_body(relation: Relation) -> str:
    return relation.view_text.strip().rstrip(";")


def table_ddl(schema: str, name: str, columns: Sequence[Column]) -> str:
    lines = []
    for column in columns:
        line = relations.column_ddl(column.name, column.data_type)
        if column.not_null:
            line += " NOT NULL"
        if column.default is not None:
            line += f" DEFAULT {column.default}"
        if column.comment:
            line += f" COMMENT {spark_literal(column.comment)}"
        lines.append(line)
    return f"CREATE TABLE {backtick_path(schema, name)} (\n    " + ",\n    ".join(lines) + "\n)"


# What setJobGroup() sets for the thread.
_GROUP_PROPERTIES = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")


def _with_attempts(
    spark: SparkSession, attempt: Callable[[int], ManifestObject], general: General, label: str
) -> ManifestObject:
    """Repeat one object's export on any failure or timeout. Lost tasks are Spark's own
    business; this covers a source that was briefly away."""
    context = spark.sparkContext
    outer = {key: context.getLocalProperty(key) for key in _GROUP_PROPERTIES}
    for number in range(1, general.attempts + 1):
        timer = None
        if general.attempt_timeout_ms:
            group = f"tablecrate-{uuid.uuid4().hex}"
            spark.sparkContext.setJobGroup(group, f"export {label}", interruptOnCancel=True)
            timer = threading.Timer(
                general.attempt_timeout_ms / 1000, spark.sparkContext.cancelJobGroup, [group]
            )
            timer.daemon = True
            timer.start()
        try:
            return attempt(number)
        except Exception as error:
            if number == general.attempts:
                raise
            warnings.warn(f"export of {label}, attempt {number} failed: {error}", stacklevel=2)
            time.sleep(general.retry_delay_ms / 1000)
        finally:
            if timer is not None:
                timer.cancel()
                for key, value in outer.items():
                    context.setLocalProperty(key, value)
    raise AssertionError("unreachable")


def purge_runs(spark: SparkSession, snapshot: str) -> list[str]:
    """Delete the data folders of earlier exports to the same place. Readers of the former
    snapshot must have finished."""
    opened = snapshot.rstrip("/")
    current = manifests.run_folder(spark, opened)
    files = MetadataFiles(spark)
    old = [name for name in files.subfolders(opened) if name != current and len(name) == 32]
    for name in old:
        files.delete_tree(f"{opened}/{name}")
    return old
