"""Tables and views of the session catalog: kind, columns, definition, size."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablecrate.errors import CrateError
from tablecrate.functions.names import backtick, backtick_path, spark_literal

# Table properties that carry what Spark's file tables do not keep themselves.
NOT_NULL_PROPERTY = "tablecrate.not_null"
KEYS_PROPERTY = "tablecrate.keys"
LABELS_PROPERTY = "tablecrate.labels"

@dataclass(frozen=True)
class Column:
    name: str
    data_type: T.DataType
    not_null: bool = False
    default: str | None = None
    comment: str | None = None
    labels: tuple[str, ...] = ()
    key: bool = False

    @property
    def type_text(self) -> str:
        return type_to_text(self.data_type)


@dataclass(frozen=True)
class Relation:
    schema: str
    name: str
    kind: str  # "table" or "view"
    columns: tuple[Column, ...]
    comment: str | None = None
    view_text: str | None = None
    view_settings: dict[str, str] = field(default_factory=dict)  # it was created under
    view_namespace: str | None = None  # where its unqualified names are looked up
    row_estimate: int | None = None
    properties: dict[str, str] = field(default_factory=dict)
    location: str | None = None
    managed: bool = False

    @property
    def column_names(self) -> list[str]:
        return [column.name for column in self.columns]


def find(spark: SparkSession, schema: str, name: str) -> Relation | None:
    path = backtick_path(schema, name)
    if not spark.catalog.databaseExists(backtick(schema)) or not spark.catalog.tableExists(path):
        return None
    facts = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {path} AS JSON").first()[0])
    described = {column["name"]: column for column in facts["columns"]}
    properties = facts.get("table_properties", {})
    not_null = set(json.loads(properties.get(NOT_NULL_PROPERTY, "[]")))
    keys = set(json.loads(properties.get(KEYS_PROPERTY, "[]")))
    labels = json.loads(properties.get(LABELS_PROPERTY, "{}"))
    columns = tuple(
        Column(
            name=item.name,
            data_type=item.dataType,
            not_null=item.name in not_null or not item.nullable,
            default=described.get(item.name, {}).get("default"),
            comment=described.get(item.name, {}).get("comment"),
            labels=tuple(labels.get(item.name, ())),
            key=item.name in keys,
        )
        for item in spark.table(path).schema
    )
    if not columns:
        raise CrateError(f"source relation {schema}.{name} has no columns")
    is_view = facts["type"] == "VIEW"
    created_under = facts.get("view_creation_spark_configuration", {})
    return Relation(
        schema=schema,
        name=name,
        kind="view" if is_view else "table",
        columns=columns,
        comment=facts.get("comment"),
        view_text=facts.get("view_text") if is_view else None,
        view_settings=dict(created_under) if is_view else {},
        view_namespace=facts.get("view_catalog_and_namespace") if is_view else None,
        row_estimate=None if is_view else facts.get("statistics", {}).get("num_rows"),
        properties=properties,
        location=facts.get("location"),
        managed=facts["type"] == "MANAGED",
    )


def get(spark: SparkSession, schema: str, name: str) -> Relation:
    relation = find(spark, schema, name)
    if relation is None:
        raise CrateError(f"source relation {schema}.{name} does not exist")
    return relation


def rows(spark: SparkSession, schema: str, name: str) -> DataFrame:
    return spark.table(backtick_path(schema, name))


def register_files(
    spark: SparkSession, schema: str, tables: dict[str, str], location: str, source: str = "parquet"
) -> None:
    """Put existing data files into the catalog as external tables `schema.<name>`."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {backtick(schema)} LOCATION {spark_literal(location)}")
    for name, path in tables.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {backtick_path(schema, name)}"
            f" USING {source} LOCATION {spark_literal(path)}"
        )


def type_to_text(data_type: T.DataType) -> str:
    """Readable type text; JSON where a struct's field names need quoting."""
    text = data_type.simpleString()
    nested = re.search(r"[<:]", text)
    if nested and not re.fullmatch(r"[a-z0-9_<>:,() ]+", text):
        return data_type.json()
    return text


def type_from_text(text: str) -> T.DataType:
    if text.startswith("{"):
        column = {"name": "c", "type": json.loads(text), "nullable": True, "metadata": {}}
        return T.StructType.fromJson({"type": "struct", "fields": [column]})["c"].dataType
    return T.DataType.fromDDL(text)


def column_ddl(name: str, data_type: T.DataType) -> str:
    """`name` TYPE, with every nested field name quoted where it must be."""
    return T.StructType([T.StructField(name, data_type)]).toDDL()


def safe_file_name(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9_.-]", "_", text)
