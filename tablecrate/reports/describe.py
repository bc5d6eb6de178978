"""Describe whole relations: columns, constraints, statistics, warnings."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.config import CONSTRAINT_KINDS, Constraint, JobConfig
from tablecrate.errors import CrateError
from tablecrate.functions import reporttext
from tablecrate.functions.names import backtick, backtick_path
from tablecrate.operators import sketches
from tablecrate.operators.profile import common_values, profile_approximate, profile_exact
from tablecrate.operators.quality import foreign_keys_outside
from tablecrate.sources import relations
from tablecrate.sources.lookup import find_source
from tablecrate.sources.relations import Relation

COLUMN_SCHEMA = """
    schema string, relation string, kind string, ordinal int, column string, type string,
    nullable boolean, default_expression string, comment string
"""


@dataclass(frozen=True)
class CommonValue:
    value: str
    frequency: float


@dataclass(frozen=True)
class ColumnStatistics:
    null_fraction: float
    estimated_distinct: float | None
    average_width_bytes: float | None
    most_common_values: list[CommonValue] = field(default_factory=list)


@dataclass(frozen=True)
class RelationDescription:
    relation: Relation
    constraints: list[Constraint]
    row_estimate: int | None = None
    statistics: dict[str, ColumnStatistics] | None = None  # None: not asked for

    @property
    def statistics_status(self) -> str | None:
        if self.statistics is None:
            return None
        return "available" if self.statistics else "unavailable"


@dataclass(frozen=True)
class Description:
    spark_version: str
    relations: list[RelationDescription]
    warnings: list[str]
    include_comments: bool = True

    @property
    def has_statistics(self) -> bool:
        return any(item.statistics is not None for item in self.relations)


def column_facts(spark: SparkSession, sources: Iterable[tuple[str, str]]) -> DataFrame:
    """One row per column of the named relations, in order; whole relations always."""
    facts = []
    for schema, name in dict.fromkeys(sources):
        relation = relations.get(spark, schema, name)
        for ordinal, column in enumerate(relation.columns, start=1):
            facts.append(
                (
                    schema,
                    name,
                    relation.kind,
                    ordinal,
                    column.name,
                    column.type_text,
                    not column.not_null,
                    column.default,
                    column.comment,
                )
            )
    return spark.createDataFrame(facts, COLUMN_SCHEMA)


def row_counts(spark: SparkSession, sources: Iterable[tuple[str, str]]) -> DataFrame:
    """(schema, relation, rows) in one job; Parquet answers from its footers."""
    counted: DataFrame | None = None
    for schema, name in dict.fromkeys(sources):
        one = relations.rows(spark, schema, name).agg(F.count(F.lit(1)).alias("rows"))
        one = one.select(F.lit(schema).alias("schema"), F.lit(name).alias("relation"), "rows")
        counted = one if counted is None else counted.unionAll(one)
    if counted is None:
        raise CrateError("there are no relations to count")
    return counted


def describe(
    spark: SparkSession,
    config: JobConfig,
    *,
    statistics: str | int | None = None,
    source: str = "catalog",
    exact: bool = False,
    include_comments: bool = True,
    connection_options: dict[str, str] | None = None,
) -> Description:
    """Describe each relation the config names, once.

    `statistics`: None, "basic", or the number of common values per column. `source`:
    "catalog" touches no rows: it reads the sketches that `operators.sketches.analyze` stored
    and appends have added to, common values included, or else what ANALYZE TABLE left.
    "compute" reads the rows, with approximate or `exact` distinct counts.
    """
    top = _common_value_count(statistics)
    if source not in ("catalog", "compute"):
        raise CrateError(f"statistics come from catalog or compute, not {source!r}")
    described = []
    for schema, name in config.unique_sources():
        relation, relation_rows = find_source(spark, schema, name, connection_options)
        declared = [c for c in config.constraints if c.relation == (schema, name)]
        declared.sort(key=lambda c: (CONSTRAINT_KINDS.index(c.kind), c.name))
        rows, found = relation.row_estimate, None
        if statistics is not None and source == "catalog":
            if sketches.has_store(spark, relation):
                rows, found = _stored_statistics(spark, relation, top)
            else:
                found = _catalog_statistics(spark, relation)
        elif statistics is not None:
            rows, found = _computed_statistics(relation, relation_rows, top, exact)
        described.append(
            RelationDescription(relation, declared, rows if statistics is not None else None, found)
        )
    warnings = []
    if any(c.kind == "foreign_key" for c in config.constraints):
        outside = foreign_keys_outside(spark, config.constraints, config.unique_sources())
        warnings = [row["warning"] for row in outside.orderBy("schema", "relation", "name").collect()]
    return Description(spark.version, described, warnings, include_comments)


def _common_value_count(statistics: str | int | None) -> int:
    if statistics is None or statistics == "basic":
        return 0
    if isinstance(statistics, bool) or not isinstance(statistics, int) or statistics < 1:
        raise CrateError(f"statistics must be 'basic' or a number of at least 1, got {statistics!r}")
    return statistics


def _catalog_statistics(spark: SparkSession, relation: Relation) -> dict[str, ColumnStatistics]:
    found: dict[str, ColumnStatistics] = {}
    if relation.kind == "view" or relation.row_estimate is None:
        return found
    path = backtick_path(relation.schema, relation.name)
    for column in relation.columns:
        described = spark.sql(f"DESCRIBE EXTENDED {path} {backtick(column.name)}").collect()
        facts = {row["info_name"]: row["info_value"] for row in described}
        nulls = facts.get("num_nulls", "NULL")
        if nulls == "NULL":
            continue
        width = facts.get("avg_col_len", "NULL")
        distinct = facts.get("distinct_count", "NULL")
        rows = relation.row_estimate
        found[column.name] = ColumnStatistics(
            null_fraction=int(nulls) / rows if rows else 0.0,
            estimated_distinct=None if distinct == "NULL" else float(distinct),
            average_width_bytes=None if width == "NULL" else float(width),
        )
    return found


def _stored_statistics(
    spark: SparkSession, relation: Relation, top: int
) -> tuple[int, dict[str, ColumnStatistics]]:
    rows = sketches.summary(sketches.stored(spark, relation), top).orderBy("ordinal").collect()  # a row a column
    total = rows[0]["rows"]
    found = {
        row["column"]: ColumnStatistics(
            null_fraction=row["null_fraction"] or 0.0,
            estimated_distinct=row["distinct_values"],
            average_width_bytes=row["average_width_bytes"],
            most_common_values=[CommonValue(v["value"], v["rows"] / total) for v in row["common"]],
        )
        for row in rows
    }
    return total, found if total else {}


def _computed_statistics(
    relation: Relation, rows: DataFrame, top: int, exact: bool
) -> tuple[int, dict[str, ColumnStatistics]]:
    profile = profile_exact(rows) if exact else profile_approximate(rows)
    profiled = {row["column"]: row for row in profile.collect()}
    total = next((row["rows"] for row in profiled.values()), 0)
    common: dict[str, list[CommonValue]] = {}
    if top and total:
        names = [
            c.name for c in relation.columns if not isinstance(c.data_type, T.BinaryType)
        ]
        # At most `top` values of each column come to the driver: this is the report itself.
        for row in common_values(rows, top, names).orderBy("ordinal", "rank").collect():
            common.setdefault(row["column"], []).append(CommonValue(row["value"], row["frequency"]))
    found = {
        name: ColumnStatistics(
            null_fraction=row["null_fraction"] or 0.0,
            estimated_distinct=row["distinct_values"],
            average_width_bytes=row["average_width_bytes"],
            most_common_values=common.get(name, []),
        )
        for name, row in profiled.items()
    }
    return total, found if total else {}


def profile_report(profile: DataFrame) -> DataFrame:
    """The profile as text lines: (ordinal, column, nulls, distinct, width)."""
    return profile.select(
        "ordinal",
        "column",
        reporttext.percentage(F.col("null_fraction")).alias("nulls"),
        reporttext.distinct_estimate(F.col("distinct_values")).alias("distinct"),
        F.concat(F.round("average_width_bytes").cast("bigint").cast("string"), F.lit(" bytes")).alias("width"),
    )


def whole_bytes(width: float | None) -> int | None:
    return None if width is None else math.floor(width + 0.5)
