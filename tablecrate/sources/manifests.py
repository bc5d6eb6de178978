"""The manifest of a snapshot: read, check, write, and many manifests as one DataFrame.

A manifest is one JSON document. It has a row of columns for each object, with all that a load
must know of a column in one place; what follows from the selection text is not stored again.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecrate.errors import CrateError
from tablecrate.functions import seal
from tablecrate.operators.selection import Selection
from tablecrate.operators.selection import parse as parse_selection
from tablecrate.sources.files import MetadataFiles

LAYOUT = 3
FILE_NAME = "manifest.json"
PAYLOADS = ("binary", "csv")


class Place(NamedTuple):
    schema: str
    name: str


@dataclass(frozen=True)
class ObjectColumn:
    name: str
    type: str
    required: bool = False
    key: bool = False
    default: str | None = None
    comment: str | None = None
    labels: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class ViewDefinition:
    text: str
    namespace: str | None = None
    settings: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class ManifestObject:
    """One object. With `view` the snapshot keeps its definition, else its rows."""

    source: Place
    target: Place
    kind: str
    select: str
    columns: list[ObjectColumn]
    ddl: str
    payload: str
    estimate: int | None = None
    rows: int | None = None
    checksum: str | None = None
    comment: str | None = None
    view: ViewDefinition | None = None

    @property
    def has_data(self) -> bool:
        return self.view is None

    @property
    def export_as(self) -> str:
        return "table" if self.has_data else "view"

    @property
    def selection(self) -> Selection:
        return parse_selection(self.select)

    @property
    def column_names(self) -> list[str]:
        return [column.name for column in self.columns]

    @property
    def required(self) -> list[str]:
        return [column.name for column in self.columns if column.required]

    @property
    def keys(self) -> list[str]:
        return [column.name for column in self.columns if column.key]


@dataclass(frozen=True)
class Inputs:
    """The source files as they were pinned before the first read."""

    files: int
    bytes: int
    fingerprint: str


@dataclass(frozen=True)
class Manifest:
    written: str
    engine: int
    session: str
    payload_format: str
    consistent: bool
    objects: list[ManifestObject]
    inputs: Inputs | None = None
    layout: int = LAYOUT


def parse(text: str, origin: str) -> Manifest:
    try:
        raw = json.loads(text)
        if raw["layout"] != LAYOUT:
            raise CrateError(f"{origin} has layout {raw['layout']}; this version reads layout {LAYOUT}")
        manifest = _known(Manifest, raw, objects=[_object(item) for item in raw["objects"]],
                          inputs=_known(Inputs, raw["inputs"]) if raw.get("inputs") else None)
    except (ValueError, KeyError, TypeError, AttributeError) as error:
        raise CrateError(f"{origin} is not a manifest: {error}") from error
    _require_sound(manifest, origin)
    return manifest


def _known(kind: type, raw: dict, **made: object):
    """What `kind` knows of `raw`; later versions may have added to it."""
    return kind(**{k: v for k, v in raw.items() if k in kind.__dataclass_fields__} | made)


def _object(raw: dict) -> ManifestObject:
    return _known(
        ManifestObject,
        raw,
        source=Place(*raw["source"]),
        target=Place(*raw["target"]),
        columns=[_known(ObjectColumn, column) for column in raw["columns"]],
        view=_known(ViewDefinition, raw["view"]) if raw.get("view") else None,
    )


def _problems(manifest: Manifest) -> Iterator[str]:
    if manifest.payload_format not in PAYLOADS:
        yield f"its payload is {manifest.payload_format!r}, not one of {PAYLOADS}"
    if not manifest.objects:
        yield "it lists nothing"
    targets = [item.target for item in manifest.objects]
    for target in sorted({t for t in targets if targets.count(t) > 1}):
        yield f"several objects go to {'.'.join(target)}"
    for item in manifest.objects:
        names = item.column_names
        if not names or len({*names}) < len(names):
            yield f"{'.'.join(item.target)} has no columns, or one of them twice"


def _require_sound(manifest: Manifest, origin: str) -> None:
    if found := list(_problems(manifest)):
        raise CrateError(f"{origin} is not sound: {'; '.join(found)}")


@dataclass(frozen=True)
class Snapshot:
    """A published snapshot that has been opened: its folder, manifest and key."""

    path: str
    manifest: Manifest
    encrypted: bool
    key: bytes | None = None


def manifest_path(snapshot: str) -> str:
    return f"{snapshot.rstrip('/')}/{FILE_NAME}"


def is_encrypted(spark: SparkSession, snapshot: str) -> bool:
    return bool(_envelope(spark, snapshot).get("encrypted"))


def run_folder(spark: SparkSession, snapshot: str) -> str:
    """The folder the published files are in; also known for encrypted snapshots."""
    envelope = _envelope(spark, snapshot)
    return envelope.get("run") or envelope["objects"][0]["ddl"].split("/")[0]


def _envelope(spark: SparkSession, snapshot: str) -> dict:
    files = MetadataFiles(spark)
    if not files.exists(manifest_path(snapshot)):
        raise CrateError(f"{snapshot} has no manifest, so it is not a finished snapshot")
    try:
        return json.loads(files.read(manifest_path(snapshot)))
    except ValueError as error:
        raise CrateError(f"{manifest_path(snapshot)} is not JSON") from error


def open_snapshot(spark: SparkSession, snapshot: str, password: str | None = None) -> Snapshot:
    envelope = _envelope(spark, snapshot)
    if not envelope.get("encrypted"):
        manifest = parse(json.dumps(envelope), manifest_path(snapshot))
        return Snapshot(snapshot.rstrip("/"), manifest, encrypted=False)
    if password is None:
        raise CrateError(f"{snapshot} is encrypted: a password is needed")
    key = seal.derive_key(password, base64.b64decode(envelope["salt"]))
    text = seal.open_text(spark, envelope["manifest"], key)
    manifest = parse(text, manifest_path(snapshot))
    return Snapshot(snapshot.rstrip("/"), manifest, encrypted=True, key=key)


def publish(
    spark: SparkSession, snapshot: str, manifest: Manifest, key: bytes | None, salt: bytes | None
) -> None:
    """The last step of an export, and the one that makes it visible."""
    _require_sound(manifest, snapshot)
    content = asdict(manifest)
    if key is not None:
        content = {
            "encrypted": True,
            "run": manifest.objects[0].ddl.split("/")[0],
            "kdf": "scrypt",
            "salt": base64.b64encode(salt).decode(),
            "manifest": seal.seal_text(spark, json.dumps(content), key),
        }
    MetadataFiles(spark).write(manifest_path(snapshot), json.dumps(content, indent=2) + "\n")


_SCAN_SCHEMA = """
    layout int, written string, engine int, session string, payload_format string,
    consistent boolean, inputs struct<files: bigint, bytes: bigint>,
    objects array<struct<
        source: array<string>, target: array<string>, kind: string, select: string,
        columns: array<struct<name: string, type: string, required: boolean, key: boolean>>,
        ddl: string, payload: string, estimate: bigint, rows: bigint, checksum: string,
        view: struct<text: string>>>
"""


def manifest_objects(spark: SparkSession, *snapshots: str) -> DataFrame:
    """One row per object of every (unencrypted) snapshot; folder names may be globs."""
    listed = (
        spark.read.schema(_SCAN_SCHEMA)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json([manifest_path(snapshot) for snapshot in snapshots])
        .withColumn("manifest", F.col("_metadata.file_path"))
        .select("*", F.posexplode("objects").alias("position", "object"))
    )
    select = F.col("object.select")
    return listed.select(
        "manifest", "layout", "written", "engine", "payload_format", "consistent", "inputs", "position",
        F.col("object.source")[0].alias("source_schema"),
        F.col("object.source")[1].alias("relation"),
        F.array_join("object.target", ".").alias("target"),
        "object.kind",
        F.when(F.col("object.view").isNull(), "table").otherwise("view").alias("export_as"),
        select.alias("selection"),
        F.when(select.rlike(r"(?is)^\s*select\s*\*\s*except"), "except_list")
        .when(select.rlike(r"(?is)^\s*select\s*\*"), "*")
        .otherwise("columns_list")
        .alias("projection"),
        "object.columns", "object.ddl", "object.payload", "object.estimate", "object.rows", "object.checksum",
    )
