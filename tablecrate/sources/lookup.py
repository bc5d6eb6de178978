"""One source relation, from the catalog or over JDBC: its facts and its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablecrate.sources import jdbc, relations
from tablecrate.sources.relations import Column, Relation


def find_source(
    spark: SparkSession,
    schema: str,
    name: str,
    connection: dict[str, str] | None = None,
    key_range: jdbc.KeyRange | None = None,
) -> tuple[Relation, DataFrame]:
    if connection is None:
        return relations.get(spark, schema, name), relations.rows(spark, schema, name)
    rows = jdbc.read_relation(spark, connection, schema, name, key_range)
    columns = tuple(
        Column(field.name, field.dataType, not_null=not field.nullable) for field in rows.schema
    )
    return Relation(schema, name, "table", columns), rows
