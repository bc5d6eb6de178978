"""Load a snapshot into the catalog: replace, append or schema only.

Tables are external: each replace writes a new version folder and then points the catalog
entry to it, so the old rows stay readable until the new ones are proven. Where columns
agree that is one step (`SET LOCATION`). What a replace is about to do is noted in the catalog
first (a property, or the name of the table set aside), so the next load can finish it
or take it back (`recover`).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.errors import CrateError
from tablecrate.functions import seal
from tablecrate.functions.digest import row_hash_sum
from tablecrate.functions.names import backtick, backtick_path, column_list, spark_literal
from tablecrate.operators import sketches
from tablecrate.operators.keys import key_watermark, next_value
from tablecrate.operators.loading import compatibility, require_not_null
from tablecrate.sinks.export import version_number
from tablecrate.sinks.parallel import in_parallel
from tablecrate.sources import ledger, manifests, payload, relations
from tablecrate.sources.files import MetadataFiles
from tablecrate.sources.manifests import ManifestObject, Snapshot

NEXT_VALUE_PROPERTY = "tablecrate.next_value"
BATCH_PROPERTY = "tablecrate.batch"
INTENT_PROPERTY = "tablecrate.intent"
_OWN_PROPERTIES = (
    relations.NOT_NULL_PROPERTY,
    relations.KEYS_PROPERTY,
    relations.LABELS_PROPERTY,
    NEXT_VALUE_PROPERTY,
)

_ASIDE = "__old_"  # a table set aside is named after the one it was

RESULT_SCHEMA = "schema string, name string, export_as string, rows bigint"


@dataclass(frozen=True)
class Loaded:
    schema: str
    name: str
    export_as: str
    rows: int


def read_object(
    spark: SparkSession, snapshot: Snapshot, item: ManifestObject, *, ordered: bool = False
) -> DataFrame:
    """The rows of one exported object. Files do not promise a row order; `ordered`
    sorts by the selection's ORDER BY again."""
    if not item.has_data:
        raise CrateError(f"{'.'.join(item.target)} is a view: the snapshot holds no rows of it")
    rows = payload.read(
        spark,
        f"{snapshot.path}/{item.payload}",
        _schema(item),
        snapshot.manifest.payload_format,
        snapshot.key,
    )
    if ordered and (sort_items := item.selection.sort_items):
        rows = rows.orderBy(*(key.column(rows, item.column_names) for key in sort_items))
    return rows


def find_object(snapshot: Snapshot, name: str) -> ManifestObject:
    for item in snapshot.manifest.objects:
        if name in (item.target.name, ".".join(item.target)):
            return item
    raise CrateError(f"the snapshot has no object {name}")


def load_snapshot(
    spark: SparkSession,
    path: str,
    *,
    mode: str = "replace",
    schema_only: bool = False,
    password: str | None = None,
    warehouse: str | None = None,
    batch_id: str | None = None,
    workers: int = 1,
) -> DataFrame:
    """Load every object; returns one row per object. `spark` must come from `job_session`.

    Objects that were loaded before another one failed stay loaded. `batch_id` makes an
    append repeatable: a table that already holds the batch is left alone.
    """
    if mode not in ("replace", "append"):
        raise CrateError(f"mode must be replace or append, got {mode!r}")
    snapshot = manifests.open_snapshot(spark, path, password)
    objects = snapshot.manifest.objects
    _check_writer(spark, snapshot, schema_only)
    for item in objects:
        if mode == "append" and not item.has_data:
            raise CrateError(f"append mode does not support the view {'.'.join(item.target)}")
    _check_layout(spark, snapshot, schema_only)

    def load_one(item: ManifestObject) -> Loaded:
        return _load_object(spark, snapshot, item, mode, schema_only, warehouse, batch_id)

    # Views come last and in manifest order, so everything they name exists.
    done = in_parallel(spark, load_one, [item for item in objects if item.has_data], workers)
    done += [load_one(item) for item in objects if not item.has_data]
    return spark.createDataFrame([(d.schema, d.name, d.export_as, d.rows) for d in done], RESULT_SCHEMA)


def _check_writer(spark: SparkSession, snapshot: Snapshot, schema_only: bool) -> None:
    manifest = snapshot.manifest
    if schema_only or manifest.payload_format == "csv" or not any(o.has_data for o in manifest.objects):
        return
    written, reading = manifest.engine // 10_000, version_number(spark) // 10_000
    if written != reading:
        raise CrateError(
            f"a binary snapshot of major version {written} cannot be loaded by version {reading};"
            " export it as csv"
        )


def _check_layout(spark: SparkSession, snapshot: Snapshot, schema_only: bool) -> None:
    files = MetadataFiles(spark)
    for item in snapshot.manifest.objects:
        needed = [item.ddl]
        if item.has_data and not schema_only:
            needed.append(f"{item.payload}/_SUCCESS")
        for relative in needed:
            if not files.exists(f"{snapshot.path}/{relative}"):
                raise CrateError(f"the snapshot is not complete: {relative} is missing")


def read_ddl(spark: SparkSession, snapshot: Snapshot, item: ManifestObject) -> str:
    text = MetadataFiles(spark).read(f"{snapshot.path}/{item.ddl}")
    return seal.open_text(spark, text, snapshot.key) if snapshot.key is not None else text


def _load_object(
    spark: SparkSession,
    snapshot: Snapshot,
    item: ManifestObject,
    mode: str,
    schema_only: bool,
    warehouse: str | None,
    batch_id: str | None,
) -> Loaded:
    schema, name = item.target
    place = f" LOCATION {spark_literal(f'{warehouse}/{schema}')}" if warehouse else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {backtick(schema)}{place}")
    recover(spark, schema, name)
    present = relations.find(spark, schema, name)
    if not item.has_data:
        _create_view(spark, item, present)
        return Loaded(schema, name, item.export_as, 0)
    if mode == "append" and present is not None:
        return _append(spark, snapshot, item, present, schema_only, batch_id)
    return _replace(spark, snapshot, item, present, schema_only, warehouse, batch_id)


def _replace(
    spark: SparkSession,
    snapshot: Snapshot,
    item: ManifestObject,
    present: relations.Relation | None,
    schema_only: bool,
    warehouse: str | None,
    batch_id: str | None,
) -> Loaded:
    schema, name = item.target
    version = uuid.uuid4().hex
    location = f"{_schema_location(spark, schema, warehouse)}/{name}/{version}"
    staged = f"{name}__{version}"
    try:
        if schema_only:
            rows, next_values = 0, {key: 1 for key in item.keys}
            spark.createDataFrame([], _schema(item)).write.parquet(location)
        else:
            rows, next_values = _write_version(spark, snapshot, item, location)
    except BaseException:
        MetadataFiles(spark).delete_tree(location)
        raise
    properties = {
        relations.NOT_NULL_PROPERTY: json.dumps(item.required),
        relations.KEYS_PROPERTY: json.dumps(item.keys),
        relations.LABELS_PROPERTY: json.dumps({c.name: c.labels for c in item.columns if c.labels}),
        NEXT_VALUE_PROPERTY: json.dumps(next_values),
    }
    if batch_id is not None:
        properties[f"{BATCH_PROPERTY}.{batch_id}"] = "done"
    if present is not None and _is_version_of(present, item):
        _repoint(spark, present, location, properties)
        return Loaded(schema, name, item.export_as, rows)
    _create_table(spark, schema, staged, item, location, properties)
    _swap(spark, schema, staged, name, present)
    return Loaded(schema, name, item.export_as, rows)


def _write_version(
    spark: SparkSession, snapshot: Snapshot, item: ManifestObject, location: str
) -> tuple[int, dict[str, int]]:
    """Copy the payload into a new version folder; count, hash and find the largest keys
    on the way, and compare with the manifest before anyone can see the table."""
    rows = require_not_null(
        read_object(spark, snapshot, item), item.required, ".".join(item.target)
    )
    seen = Observation()
    marks = [next_value(rows[backtick(key)]).alias(f"next_{i}") for i, key in enumerate(item.keys)]
    observed = rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), row_hash_sum(rows).alias("checksum"), *marks
    )
    observed.write.option("compression", payload.COMPRESSION).parquet(location)
    _compare(spark, snapshot, item, seen.get["rows"], str(seen.get["checksum"]))
    return seen.get["rows"], {key: seen.get[f"next_{i}"] for i, key in enumerate(item.keys)}


def _compare(
    spark: SparkSession, snapshot: Snapshot, item: ManifestObject, rows: int, checksum: str
) -> None:
    for what, expected, found in (
        ("row count", item.rows, rows),
        ("checksum", item.checksum, checksum),
    ):
        if expected is not None and expected != found:
            raise CrateError(
                f"{'.'.join(item.target)}: the {what} is {found}, the manifest says {expected}"
                + ledger.damage_of(spark, snapshot, item)
            )


def _append(
    spark: SparkSession,
    snapshot: Snapshot,
    item: ManifestObject,
    present: relations.Relation,
    schema_only: bool,
    batch_id: str | None,
) -> Loaded:
    schema, name = item.target
    table = backtick_path(schema, name)
    if present.kind != "table":
        raise CrateError(f"append needs a table, but {schema}.{name} is a {present.kind}")
    report = compatibility(item.column_names, [c.type for c in item.columns], present)
    for column, expected, actual, status in report:
        if status != "ok":
            raise CrateError(
                f"cannot append to {schema}.{name}: column {column} is {status}"
                f" (expected {expected}, found {actual})"
            )
    # A required column that is not part of the load must get its value from a default.
    for column in present.columns:
        filled = column.name in item.column_names or column.default is not None
        if column.not_null and not filled:
            raise CrateError(f"cannot append to {schema}.{name}: {column.name} would be NULL")
    if schema_only:
        return Loaded(schema, name, item.export_as, 0)

    marker = f"{BATCH_PROPERTY}.{batch_id}"
    if batch_id is not None:
        state = present.properties.get(marker)
        if state == "done":
            return Loaded(schema, name, item.export_as, 0)
        if state is not None:
            raise CrateError(
                f"an earlier append of batch {batch_id} to {schema}.{name} was interrupted;"
                " check the table before loading it again"
            )

    rows = read_object(spark, snapshot, item)
    # Appended rows are visible at once, so they are proven before the insert starts.
    proof = rows.agg(F.count(F.lit(1)).alias("rows"), row_hash_sum(rows).alias("checksum")).first()
    _compare(spark, snapshot, item, proof["rows"], str(proof["checksum"]))
    required = [c.name for c in present.columns if c.not_null and c.name in item.column_names]
    checked = require_not_null(rows, required, f"{schema}.{name}")
    if batch_id is not None:
        _set_properties(spark, table, {marker: "started"})
    spark.sql(
        f"INSERT INTO {table} ({column_list(item.column_names)}) SELECT * FROM {{rows}}",
        rows=checked,
    )
    if sketches.has_store(spark, present):
        sketches.add_batch(spark, present, _appended(present, checked))
    properties = {marker: "done"} if batch_id is not None else {}
    synced = [c.name for c in present.columns if c.key and c.name in item.column_names]
    if synced:
        values = json.loads(present.properties.get(NEXT_VALUE_PROPERTY, "{}"))
        found = key_watermark(spark.table(table), synced).collect()
        values |= {row["column"]: row["next_value"] for row in found}
        properties[NEXT_VALUE_PROPERTY] = json.dumps(values)
    if properties:
        _set_properties(spark, table, properties)
    return Loaded(schema, name, item.export_as, proof["rows"])


def _appended(present: relations.Relation, rows: DataFrame) -> DataFrame:
    """The rows as the table holds them: all its columns, left-out ones by their default."""
    return rows.select(
        *(
            rows[backtick(c.name)] if c.name in rows.columns
            else F.expr(c.default or "NULL").cast(c.data_type).alias(c.name)
            for c in present.columns
        )
    )


def _schema(item: ManifestObject) -> T.StructType:
    return T.StructType(
        [
            T.StructField(column.name, relations.type_from_text(column.type)) for column in item.columns
        ]
    )


def _schema_location(spark: SparkSession, schema: str, warehouse: str | None) -> str:
    if warehouse:
        return f"{warehouse.rstrip('/')}/{schema}"
    return spark.catalog.getDatabase(backtick(schema)).locationUri.rstrip("/")


def _create_table(
    spark: SparkSession,
    schema: str,
    name: str,
    item: ManifestObject,
    location: str,
    properties: dict[str, str],
) -> None:
    lines = []
    for column in item.columns:
        line = relations.column_ddl(column.name, relations.type_from_text(column.type))
        if column.default is not None:
            line += f" DEFAULT {column.default}"
        if column.comment:
            line += f" COMMENT {spark_literal(column.comment)}"
        lines.append(line)
    comment = f" COMMENT {spark_literal(item.comment)}" if item.comment else ""
    spark.sql(
        f"CREATE TABLE {backtick_path(schema, name)} ({', '.join(lines)}) USING parquet"
        f" LOCATION {spark_literal(location)}{comment} TBLPROPERTIES ({_property_list(properties)})"
    )


def _create_view(
    spark: SparkSession, item: ManifestObject, present: relations.Relation | None
) -> None:
    """The view is created as it first was: under the same settings, and with its
    unqualified names looked up in the same namespace."""
    schema, name = item.target
    session = spark.newSession()
    for key, value in item.view.settings.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    if item.view.namespace:
        session.sql(f"USE {item.view.namespace}")
    staged = f"{name}__{uuid.uuid4().hex}"
    columns = column_list(item.column_names)
    session.sql(f"CREATE VIEW {backtick_path(schema, staged)} ({columns}) AS {item.view.text}")
    _swap(spark, schema, staged, name, present, "VIEW")


def _swap(
    spark: SparkSession,
    schema: str,
    staged: str,
    name: str,
    present: relations.Relation | None,
    kind: str = "TABLE",
) -> None:
    """Put `staged` in the place of `name`. The old object is set aside first and comes
    back if the second rename fails; nothing but catalog entries moves for external
    tables."""

    def rename(what: str, old: str, new: str) -> None:
        _run(spark, _renaming(what, schema, old, new))

    if present is None:
        rename(kind, staged, name)
        return
    aside = f"{name}{_ASIDE}{uuid.uuid4().hex}"
    old_kind = "VIEW" if present.kind == "view" else "TABLE"
    rename(old_kind, name, aside)
    try:
        rename(kind, staged, name)
    except Exception:
        rename(old_kind, aside, name)
        raise
    _run(spark, f"DROP {old_kind} {backtick_path(schema, aside)}")


def _renaming(kind: str, schema: str, old: str, new: str) -> str:
    return f"ALTER {kind} {backtick_path(schema, old)} RENAME TO {backtick_path(schema, new)}"


def _is_version_of(present: relations.Relation, item: ManifestObject) -> bool:
    """Whether an earlier replace made the table, with the columns and comments of `item`."""
    if present.kind != "table" or present.managed or present.location is None:
        return False
    parent, folder = present.location.rstrip("/").rsplit("/", 1)
    if NEXT_VALUE_PROPERTY not in present.properties or len(folder) != 32:
        return False
    if parent.rsplit("/", 1)[-1] != present.name:
        return False
    now = [(c.name, c.type_text, c.default, c.comment or None) for c in present.columns]
    then = [(c.name, c.type, c.default, c.comment or None) for c in item.columns]
    return now == then and (present.comment or None) == (item.comment or None)


def _repoint(
    spark: SparkSession, present: relations.Relation, location: str, properties: dict[str, str]
) -> None:
    """Give the table another version folder: the rows change in one step, and the intent
    noted before it tells a later load which properties belong to them."""
    table = backtick_path(present.schema, present.name)
    intent = json.dumps({"location": location, "properties": properties})
    _run(spark, f"ALTER TABLE {table} SET TBLPROPERTIES ({_property_list({INTENT_PROPERTY: intent})})")
    _run(spark, f"ALTER TABLE {table} SET LOCATION {spark_literal(location)}")
    _settle(spark, present, properties)


def _settle(
    spark: SparkSession, present: relations.Relation, properties: dict[str, str]
) -> None:
    """The properties of the rows the table points to now; marks of older rows go. The
    intent goes last, so this can be repeated."""
    table = backtick_path(present.schema, present.name)
    old = [
        key
        for key in present.properties
        if key not in properties and (key in _OWN_PROPERTIES or key.startswith(f"{BATCH_PROPERTY}."))
    ]
    _run(spark, f"ALTER TABLE {table} SET TBLPROPERTIES ({_property_list(properties)})")
    dropped = ", ".join(spark_literal(key) for key in old)
    if dropped:
        _run(spark, f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({dropped})")
    _run(spark, f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({spark_literal(INTENT_PROPERTY)})")
    spark.catalog.refreshTable(table)


def recover(spark: SparkSession, schema: str, name: str) -> None:
    """Finish or take back a replace of `schema.name` that was interrupted. Every load calls
    this first; one load of a table at a time."""
    prefix = f"{name}{_ASIDE}".lower()
    found = F.lower("tableName")
    # Only names that `_swap` makes: any other table of the schema is someone's own.
    made = F.startswith(found, F.lit(prefix)) & F.substring(found, len(prefix) + 1, 1_000).rlike("^[0-9a-f]{32}$")
    for row in spark.sql(f"SHOW TABLES IN {backtick(schema)}").where(made & ~F.col("isTemporary")).collect():  # one at most, unless catalog entries could not be dropped
        aside = relations.get(spark, schema, row["tableName"])
        kind = "VIEW" if aside.kind == "view" else "TABLE"
        if relations.find(spark, schema, name) is None:
            _run(spark, _renaming(kind, schema, aside.name, name))
        else:
            _run(spark, f"DROP {kind} {backtick_path(schema, aside.name)}")
    present = relations.find(spark, schema, name)
    if present is None or INTENT_PROPERTY not in present.properties:
        return
    intent = json.loads(present.properties[INTENT_PROPERTY])
    if _same_place(present.location, intent["location"]):
        _settle(spark, present, intent["properties"])
    else:
        table = backtick_path(schema, name)
        _run(spark, f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({spark_literal(INTENT_PROPERTY)})")


def _same_place(one: str | None, other: str) -> bool:
    """Version folders have names of their own, whatever form the path before them takes."""
    return one is not None and one.rstrip("/").rsplit("/", 1)[-1] == other.rstrip("/").rsplit("/", 1)[-1]


def _run(spark: SparkSession, statement: str) -> None:
    spark.sql(statement)


def _set_properties(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_property_list(properties)})")


def _property_list(properties: dict[str, str]) -> str:
    return ", ".join(f"{spark_literal(k)} = {spark_literal(v)}" for k, v in properties.items())


def next_values(spark: SparkSession, schema: str, name: str) -> dict[str, int]:
    """The next key of every key column, as kept up to date by loads."""
    recover(spark, schema, name)
    found = relations.get(spark, schema, name).properties.get(NEXT_VALUE_PROPERTY, "{}")
    return json.loads(found)


def declare_keys(spark: SparkSession, schema: str, name: str, columns: Sequence[str]) -> None:
    """Mark generated key columns; snapshots and loads carry the mark along."""
    relation = relations.get(spark, schema, name)
    unknown = set(columns) - set(relation.column_names)
    if unknown:
        raise CrateError(f"{schema}.{name} has no columns {sorted(unknown)}")
    properties = {relations.KEYS_PROPERTY: json.dumps(list(columns))}
    _set_properties(spark, backtick_path(schema, name), properties)


def declare_not_null(spark: SparkSession, schema: str, name: str, columns: Sequence[str]) -> None:
    """Record NOT NULL columns, which file tables forget."""
    properties = {relations.NOT_NULL_PROPERTY: json.dumps(list(columns))}
    _set_properties(spark, backtick_path(schema, name), properties)


def purge_versions(spark: SparkSession, schema: str, name: str) -> list[str]:
    """Delete the version folders a replaced table no longer points to. Readers that
    started before the last replace must have finished."""
    relation = relations.get(spark, schema, name)
    if relation.location is None or relation.managed:
        return []
    parent, current = relation.location.rstrip("/").rsplit("/", 1)
    files = MetadataFiles(spark)
    if parent.rsplit("/", 1)[-1] != name:
        return []
    old = [folder for folder in files.subfolders(parent) if folder != current and len(folder) == 32]
    for folder in old:
        files.delete_tree(f"{parent}/{folder}")
    return old
