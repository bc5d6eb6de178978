"""From the config to the full, ordered list of objects to export.

The rules. A view kept as a view needs, in the snapshot, every relation below it as a plain
table: all rows and columns, under its own name. All views are closed over first; each
relation is then settled once, from the set of its requests: a plain request serves, without
one the relation is added, and a request that writes something else under that name is an
error. Tables that views need come first, deepest first; the rest follows as configured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tablecrate.config import ObjectConfig
from tablecrate.errors import CrateError
from tablecrate.operators.selection import full_table
from tablecrate.plans.views import dependencies
from tablecrate.sources import relations

PLAN_SCHEMA = """
    position int, source_schema string, source_name string, target_schema string,
    target_name string, export_as string, projection string, where string, order_by string,
    limit bigint, required_by int
"""

Name = tuple[str, str]


def is_plain_table(item: ObjectConfig) -> bool:
    selection = item.selection
    everything = selection.projection == "*" and not selection.has_clauses
    return item.export_as == "table" and everything and item.target_or_source == item.source


def closure(spark: SparkSession, objects: Sequence[ObjectConfig]) -> dict[Name, int]:
    """Every relation below an exported view, deepest first, with the first such view."""
    needed: dict[Name, int] = {}
    for number, item in enumerate(objects):
        if item.export_as != "view":
            continue
        kind = relations.get(spark, *item.source).kind
        if kind != "view":
            raise CrateError(f"objects[{number}]: {_dotted(item.source)} is a {kind}, and export_as='view' needs a view")
        for below in dependencies(spark, *item.source):
            needed.setdefault(below, number)
    return needed


def _plan(spark: SparkSession, objects: Sequence[ObjectConfig]) -> list[tuple[ObjectConfig, int | None]]:
    needed = closure(spark, objects)
    written: dict[Name, list[int]] = {}
    for number, item in enumerate(objects):
        written.setdefault(item.target_or_source, []).append(number)

    first: list[tuple[ObjectConfig, int | None]] = []
    settled: set[int] = set()
    for name, view in needed.items():
        requests = written.get(name, [])
        plain = [n for n in requests if is_plain_table(objects[n])]
        others = [n for n in requests if n not in plain]
        if others:
            raise CrateError(
                f"objects[{view}] needs {_dotted(name)} as a plain table, but objects[{others[0]}] writes"
                " something else under that name; give it a target of its own"
            )
        settled.update(plain)
        first.append((objects[plain[0]], None) if plain else (ObjectConfig(full_table(*name)), view))
    for name, numbers in written.items():
        if len(numbers) > 1 and name not in needed:
            raise CrateError(f"two objects would be written to {_dotted(name)}: {numbers}")
    rest = [(item, None) for number, item in enumerate(objects) if number not in settled]
    return first + rest


def _dotted(name: Name) -> str:
    return ".".join(name)


def expand(spark: SparkSession, objects: Sequence[ObjectConfig]) -> list[ObjectConfig]:
    return [item for item, _ in _plan(spark, objects)]


def describe_plan(spark: SparkSession, objects: Sequence[ObjectConfig]) -> DataFrame:
    """The dry run: what would be exported, without reading a row."""
    rows = [
        (
            position,
            *item.source,
            *item.target_or_source,
            item.export_as,
            item.selection.projection,
            item.selection.where,
            item.selection.order_by,
            item.selection.limit,
            view,
        )
        for position, (item, view) in enumerate(_plan(spark, objects), start=1)
    ]
    return spark.createDataFrame(rows, PLAN_SCHEMA)
