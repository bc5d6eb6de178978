"""Job config: what to export, under which names, and the declared constraints."""

from __future__ import annotations

import os
import re
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from pathlib import Path

from tablecrate.errors import CrateError
from tablecrate.operators.selection import Selection, parse
from tablecrate.sources.jdbc import Connection, KeyRange

_TARGET_NAME = re.compile(r"[A-Za-z0-9_]+")
_VARIABLE = re.compile(r"\{([^{}]*)\}")
# Constraint kinds in report order.
CONSTRAINT_KINDS = ("primary_key", "unique", "foreign_key", "check", "exclusion")


@dataclass(frozen=True)
class General:
    data_format: str = "binary"  # "binary" is Parquet here
    compression: str = "zstd"
    consistent_snapshot: bool = True
    concurrency: int | None = None
    attempts: int = 3
    retry_delay_ms: int = 1000
    attempt_timeout_ms: int = 0
    file_ledger: bool = False  # a digest of each payload file; reads what was written once more

    def __post_init__(self) -> None:
        _one_of("data_format", self.data_format, ("binary", "csv"))
        _one_of("compression", str(self.compression).lower(), ("zstd",))
        if not isinstance(self.consistent_snapshot, bool):
            raise CrateError("general.consistent_snapshot must be true or false")
        if not isinstance(self.file_ledger, bool):
            raise CrateError("general.file_ledger must be true or false")
        if self.concurrency is not None:
            _at_least("concurrency", self.concurrency, 1)
        _at_least("attempts", self.attempts, 1)
        _at_least("retry_delay_ms", self.retry_delay_ms, 0)
        _at_least("attempt_timeout_ms", self.attempt_timeout_ms, 0)

    def override(self, **values: object) -> General:
        """Explicit values win over the config; None means not given."""
        return replace(self, **{k: v for k, v in values.items() if v is not None})

    def workers(self, environment: Mapping[str, str] = os.environ) -> int:
        if self.concurrency is not None:
            return self.concurrency
        text = environment.get("TABLECRATE_CONCURRENCY", "1")
        if not text.isdigit() or int(text) < 1:
            raise CrateError(f"TABLECRATE_CONCURRENCY must be a positive integer, got {text!r}")
        return int(text)


@dataclass(frozen=True)
class ObjectConfig:
    selection: Selection
    target: tuple[str, str] | None = None
    export_as: str = "table"
    key_range: KeyRange | None = None

    @property
    def source(self) -> tuple[str, str]:
        return self.selection.source

    @property
    def target_or_source(self) -> tuple[str, str]:
        return self.target or self.source


@dataclass(frozen=True)
class Constraint:
    """A declared constraint: file tables cannot hold one in the catalog."""

    relation: tuple[str, str]
    name: str
    kind: str
    columns: tuple[str, ...] = ()
    references: tuple[str, str] | None = None
    referenced_columns: tuple[str, ...] = ()
    expression: str | None = None

    @property
    def definition(self) -> str:
        columns = ", ".join(self.columns)
        if self.kind == "primary_key":
            return f"PRIMARY KEY ({columns})"
        if self.kind == "unique":
            return f"UNIQUE ({columns})"
        if self.kind == "foreign_key":
            parent = ".".join(self.references)
            return f"FOREIGN KEY ({columns}) REFERENCES {parent}({', '.join(self.referenced_columns)})"
        if self.kind == "check":
            return f"CHECK ({self.expression})"
        return f"EXCLUDE ({self.expression})"


@dataclass(frozen=True)
class JobConfig:
    objects: tuple[ObjectConfig, ...]
    general: General = field(default_factory=General)
    connection: Connection | None = None
    constraints: tuple[Constraint, ...] = ()

    def unique_sources(self) -> list[tuple[str, str]]:
        return list(dict.fromkeys(item.source for item in self.objects))


def load(path: str | Path, environment: Mapping[str, str] = os.environ) -> JobConfig:
    try:
        text = Path(path).read_text(encoding="utf-8")
    except OSError as error:
        raise CrateError(f"cannot read config {path}: {error}") from error
    return loads(text, environment)


def loads(text: str, environment: Mapping[str, str] = os.environ) -> JobConfig:
    try:
        raw = tomllib.loads(text)
    except tomllib.TOMLDecodeError as error:
        raise CrateError(f"the config is not valid TOML: {error}") from error
    objects = raw.get("objects", [])
    if not objects:
        raise CrateError("config: objects must not be empty")
    known = General.__dataclass_fields__
    return JobConfig(
        objects=tuple(_object(index, item) for index, item in enumerate(objects)),
        general=General(**{k: v for k, v in raw.get("general", {}).items() if k in known}),
        connection=_connection(raw.get("connection"), environment),
        constraints=tuple(_constraint(i, item) for i, item in enumerate(raw.get("constraints", []))),
    )


def select_objects(*selects: str, **options: object) -> JobConfig:
    """A config from selection texts alone."""
    return JobConfig(
        objects=tuple(ObjectConfig(parse(select)) for select in selects), general=General(**options)
    )


def _object(index: int, raw: dict) -> ObjectConfig:
    label = f"config: objects[{index}]"
    text = str(raw.get("select", "")).strip()
    if not text:
        raise CrateError(f"{label}.select must not be empty")
    try:
        selection = parse(text)
    except CrateError as error:
        raise CrateError(f"{label}.select: {error}") from error
    schema, name = raw.get("target_schema"), raw.get("target_name")
    if (schema is None) != (name is None):
        raise CrateError(f"{label} must set both target_schema and target_name or neither")
    for part in (schema, name):
        if part is not None and not _TARGET_NAME.fullmatch(part):
            raise CrateError(f"{label}: target name {part!r} may hold letters, digits and _ only")
    export_as = raw.get("export_as", "table")
    _one_of(f"objects[{index}].export_as", export_as, ("table", "view"))
    if export_as == "view" and (selection.projection != "*" or selection.has_clauses):
        raise CrateError(f"{label}: export_as='view' needs exactly 'select * from schema.object'")
    split = raw.get("split")
    return ObjectConfig(
        selection=selection,
        target=None if schema is None else (schema, name),
        export_as=export_as,
        key_range=None if split is None else KeyRange(**split),
    )


def _constraint(index: int, raw: dict) -> Constraint:
    label = f"config: constraints[{index}]"
    _one_of(f"constraints[{index}].kind", raw.get("kind"), CONSTRAINT_KINDS)
    try:
        item = Constraint(
            relation=_two_parts(raw["relation"]),
            name=raw["name"],
            kind=raw["kind"],
            columns=tuple(raw.get("columns", ())),
            references=_two_parts(raw["references"]) if "references" in raw else None,
            referenced_columns=tuple(raw.get("referenced_columns", raw.get("columns", ()))),
            expression=raw.get("expression"),
        )
    except KeyError as error:
        raise CrateError(f"{label} needs {error}") from error
    if item.kind in ("primary_key", "unique", "foreign_key") and not item.columns:
        raise CrateError(f"{label} needs columns")
    if item.kind in ("check", "exclusion") and not item.expression:
        raise CrateError(f"{label} needs an expression")
    if item.kind == "foreign_key":
        if item.references is None:
            raise CrateError(f"{label} needs references")
        if len(item.columns) != len(item.referenced_columns):
            raise CrateError(f"{label}: columns and referenced_columns differ in length")
    return item


def _two_parts(text: str) -> tuple[str, str]:
    return parse(f"select * from {text}").source


def _connection(raw: dict | None, environment: Mapping[str, str]) -> Connection | None:
    if raw is None:
        return None
    values = {}
    for key in ("host", "port", "dbname", "user", "password", "url"):
        text = str(raw.get(key, ""))
        filled = _VARIABLE.sub(lambda match: environment.get(match[1], ""), text).strip()
        if "{" in _VARIABLE.sub("", text):
            raise CrateError(f"connection.{key}: unclosed '{{' in {text!r}")
        if filled:
            values[key] = filled
    if "port" in values:
        if not values["port"].isdigit() or not 0 < int(values["port"]) < 65536:
            raise CrateError(f"connection.port: {values['port']!r} is not a port")
        values["port"] = int(values["port"])
    return Connection(**values) if values else None


def _one_of(name: str, value: object, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise CrateError(f"config: {name} must be one of {', '.join(allowed)}, got {value!r}")


def _at_least(name: str, value: object, minimum: int) -> None:
    if not isinstance(value, int) or isinstance(value, bool) or value < minimum:
        raise CrateError(f"config: {name} must be an integer of at least {minimum}, got {value!r}")
