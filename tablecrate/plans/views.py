"""What a view is built on: direct edges from its analyzed plan, closure by recursion."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tablecrate.functions.names import backtick_path, spark_literal

_PART = r"(`(?:[^`]|``)+`|[^`.\s,()]+)"
_BRANCH = re.compile(r"[ :]*[+:]- ")
_VIEW = re.compile(rf"View \({_PART}\.{_PART}\.{_PART}, \[")
_CATALOG_RELATION = re.compile(rf"SubqueryAlias {_PART}\.{_PART}\.{_PART}\s*$")

EDGE_SCHEMA = "view_schema string, view_name string, schema string, name string"


def view_edges(spark: SparkSession, schema: str, name: str) -> DataFrame:
    """Direct dependencies of a view and of every view below it.

    The analyzed plan shows each catalog relation under the view that names it,
    subqueries and CTE bodies included.
    """
    text = spark.sql(f"EXPLAIN EXTENDED SELECT * FROM {backtick_path(schema, name)}").first()[0]
    analyzed = text.split("== Analyzed Logical Plan ==")[1].split("== Optimized Logical Plan ==")[0]
    edges = set()
    open_views: list[tuple[int, tuple[str, str]]] = []
    for line in analyzed.splitlines():
        branch = _BRANCH.match(line)
        if not branch and not line.startswith(("Project", "SubqueryAlias")):
            continue
        depth = branch.end() if branch else 0
        node = line[depth:]
        while open_views and open_views[-1][0] >= depth:
            open_views.pop()
        view = _VIEW.match(node)
        relation = _CATALOG_RELATION.match(node)
        if view:
            open_views.append((depth, (_plain(view[2]), _plain(view[3]))))
        elif relation and open_views:
            edges.add((*open_views[-1][1], _plain(relation[2]), _plain(relation[3])))
    return edge_rows(spark, sorted(edges))


def edge_rows(spark: SparkSession, edges: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Edges as an inline table: the planner then joins them without a shuffle."""
    if not edges:
        return spark.createDataFrame([], EDGE_SCHEMA)
    values = ", ".join(f"({', '.join(spark_literal(part) for part in edge)})" for edge in edges)
    return spark.sql(f"SELECT * FROM VALUES {values} AS edge(view_schema, view_name, schema, name)")


def dependency_order(spark: SparkSession, edges: DataFrame, schema: str, name: str) -> DataFrame:
    """Everything the view needs, in creation order: deepest first, then by name."""
    return spark.sql(
        """
        WITH RECURSIVE needed(schema, name, depth) AS (
            SELECT schema, name, 1 FROM {edges}
            WHERE view_schema = :schema AND view_name = :name
            UNION ALL
            SELECT e.schema, e.name, n.depth + 1
            FROM needed n JOIN {edges} e ON e.view_schema = n.schema AND e.view_name = n.name
        )
        SELECT schema, name, max(depth) AS depth FROM needed
        GROUP BY schema, name
        ORDER BY depth DESC, schema, name
        """,
        args={"schema": schema, "name": name},
        edges=edges,
    )


def dependencies(spark: SparkSession, schema: str, name: str) -> list[tuple[str, str]]:
    ordered = dependency_order(spark, view_edges(spark, schema, name), schema, name)
    return [(row["schema"], row["name"]) for row in ordered.collect()]


def _plain(part: str) -> str:
    return part[1:-1].replace("``", "`") if part.startswith("`") else part
