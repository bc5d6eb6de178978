"""Declared constraints against the rows, and against the set of selected relations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecrate.config import Constraint
from tablecrate.functions.names import backtick
from tablecrate.operators.selection import spark_text
from tablecrate.sources import relations


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their `rows`. As in SQL, a unique key
    with a NULL part never clashes."""
    keys = [df[backtick(name)] for name in columns]
    complete = df
    for key in keys:
        complete = complete.where(key.isNotNull())
    return complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def check_violations(df: DataFrame, expression: str) -> DataFrame:
    """Rows that fail a CHECK; a NULL result passes. The text means what it would mean in a
    WHERE clause of a selection."""
    return df.where(~F.expr(f"({spark_text(expression)})"))


def orphan_keys(
    child: DataFrame,
    columns: Sequence[str],
    parent: DataFrame,
    parent_columns: Sequence[str],
) -> DataFrame:
    """Foreign keys without a parent, with the number of child `rows` that hold them.

    The child is reduced to its distinct keys before the join, so a key held by a third
    of all rows joins as one row.
    """
    keys = [child[backtick(name)] for name in columns]
    referencing = child
    for key in keys:
        referencing = referencing.where(key.isNotNull())
    held = referencing.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    offered = parent.select(
        *[parent[backtick(name)].alias(f"__parent_{i}") for i, name in enumerate(parent_columns)]
    )
    matches: Column = F.lit(True)
    for i, name in enumerate(columns):
        matches = matches & (held[backtick(name)] == offered[f"__parent_{i}"])
    return held.join(offered, matches, "left_anti")


_REPORT_SCHEMA = "relation string, constraint string, kind string, violations bigint"


def constraint_report(spark: SparkSession, constraints: Iterable[Constraint]) -> DataFrame:
    """relation, constraint, kind, violations: one row a declared constraint.

    Violations are rows: all rows of a repeated key (and, of a primary key, those with a
    NULL part), child rows without a parent, rows that fail a CHECK. The CHECKs and NULL
    parts of one relation are counted in one scan; keys shuffle once each. Exclusion
    constraints have no meaning here and report NULL.
    """
    parts: list[DataFrame] = []
    scans: dict[tuple[str, str], list[tuple[int, Constraint, Column]]] = {}
    declared = list(constraints)
    for place, constraint in enumerate(declared):
        rows = relations.rows(spark, *constraint.relation)
        if constraint.kind in ("primary_key", "unique"):
            repeated = duplicate_keys(rows, constraint.columns).agg(F.sum("rows").alias("n"))
            parts.append(_reported(place, constraint, repeated))
        if constraint.kind == "foreign_key":
            parents = relations.rows(spark, *constraint.references)
            orphans = orphan_keys(rows, constraint.columns, parents, constraint.referenced_columns)
            parts.append(_reported(place, constraint, orphans.agg(F.sum("rows").alias("n"))))
        found = None
        if constraint.kind == "primary_key":
            found = reduce(or_, [F.col(backtick(name)).isNull() for name in constraint.columns])
        elif constraint.kind == "check":
            found = ~F.expr(f"({spark_text(constraint.expression)})")
        elif constraint.kind not in ("unique", "foreign_key"):
            parts.append(_reported(place, constraint, spark.range(1).select(F.lit(None).cast("bigint").alias("n"))))
        if found is not None:
            scans.setdefault(constraint.relation, []).append((place, constraint, found))
    for relation, counted in scans.items():
        counts = [F.count_if(found).alias(f"n{i}") for i, (_, _, found) in enumerate(counted)]
        entries = F.array(
            *[
                F.struct(
                    F.lit(place).alias("place"),
                    F.lit(".".join(relation)).alias("relation"),
                    F.lit(c.name).alias("constraint"),
                    F.lit(c.kind).alias("kind"),
                    F.col(f"n{i}").alias("violations"),
                )
                for i, (place, c, _) in enumerate(counted)
            ]
        )
        parts.append(relations.rows(spark, *relation).agg(*counts).select(F.inline(entries)))
    if not parts:
        return spark.createDataFrame([], _REPORT_SCHEMA)
    every = reduce(DataFrame.unionAll, parts)
    # By place: two constraints of one relation may have the same name.
    total = every.groupBy("place", "relation", "constraint", "kind").agg(F.sum("violations").alias("violations"))
    return total.drop("place")


def _reported(place: int, constraint: Constraint, counted: DataFrame) -> DataFrame:
    known = F.col("n") if constraint.kind in ("exclude", "exclusion") else F.coalesce("n", F.lit(0))
    return counted.select(
        F.lit(place).alias("place"),
        F.lit(".".join(constraint.relation)).alias("relation"),
        F.lit(constraint.name).alias("constraint"),
        F.lit(constraint.kind).alias("kind"),
        known.cast("bigint").alias("violations"),
    )


_FOREIGN_KEY_SCHEMA = """
    name string, schema string, relation string, parent_schema string, parent string
"""


def foreign_keys_outside(
    spark: SparkSession,
    constraints: Iterable[Constraint],
    selected: Iterable[tuple[str, str]],
) -> DataFrame:
    """Foreign keys of selected relations whose parent is not selected, with a `warning`."""
    chosen = spark.createDataFrame(
        list(dict.fromkeys(selected)), "selected_schema string, selected_name string"
    )
    keys = spark.createDataFrame(
        [
            (c.name, *c.relation, *c.references)
            for c in constraints
            if c.kind == "foreign_key"
        ],
        _FOREIGN_KEY_SCHEMA,
    )

    def is_selected(schema: str, name: str) -> Column:
        return (keys[schema] == chosen["selected_schema"]) & (keys[name] == chosen["selected_name"])

    return (
        keys.join(chosen, is_selected("schema", "relation"), "left_semi")
        .join(chosen, is_selected("parent_schema", "parent"), "left_anti")
        .withColumn(
            "warning",
            F.format_string(
                "Foreign key %s on %s.%s references %s.%s, which is not selected",
                "name", "schema", "relation", "parent_schema", "parent",
            ),
        )
    )
