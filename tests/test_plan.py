from __future__ import annotations

import pytest

from fixture_tables import create
from tablecrate import CrateError, loads
from tablecrate.plans.export_plan import describe_plan, expand
from tablecrate.plans.views import dependencies, dependency_order, edge_rows


@pytest.fixture
def src(spark, schema):
    create(spark, schema)
    return schema


def _objects(src, *entries):
    texts = {
        "reefs": f"select = 'select * from {src}.reefs'",
        "deepest": f"select = 'select * from {src}.reefs where id > 1'",
        "renamed": f"select = 'select * from {src}.reefs'\ntarget_schema = 'x'\ntarget_name = 'y'",
        "some": f"select = 'select id from {src}.reefs'",
        "outer": f"select = 'select * from {src}.picks'\nexport_as = 'view'",
        "inner": f"select = 'select * from {src}.shallow'\nexport_as = 'view'",
        "inner_table": f"select = 'select * from {src}.shallow'",
        "items_view": f"select = 'select * from {src}.dives'\nexport_as = 'view'",
    }
    return loads("".join(f"[[objects]]\n{texts[entry]}\n" for entry in entries)).objects


def _names(planned):
    return [item.source[1] for item in planned]


def test_nested_views(spark, src):
    planned = expand(spark, _objects(src, "outer"))
    assert _names(planned) == ["reefs", "shallow", "picks"]
    assert [item.export_as for item in planned] == ["table", "table", "view"]


def test_compatible_entries_are_merged(spark, src):
    assert _names(expand(spark, _objects(src, "reefs", "outer"))) == ["reefs", "shallow", "picks"]
    assert _names(expand(spark, _objects(src, "outer", "reefs"))) == ["reefs", "shallow", "picks"]
    assert _names(expand(spark, _objects(src, "outer", "inner_table"))) == ["reefs", "shallow", "picks"]
    for entries in (("outer", "renamed"), ("renamed", "outer")):
        planned = expand(spark, _objects(src, *entries))
        assert sorted(_names(planned)) == ["picks", "reefs", "reefs", "shallow"]
        assert _names(planned)[:2] == ["reefs", "shallow"]


@pytest.mark.parametrize(
    ("entries", "message"),
    [
        (("deepest", "outer"), "as a plain table"),
        (("some", "outer"), "as a plain table"),
        (("inner", "outer"), "as a plain table"),
        (("outer", "deepest"), "as a plain table"),
        (("outer", "inner"), "as a plain table"),
        (("reefs", "deepest", "outer"), "as a plain table"),
        (("reefs", "deepest"), "two objects would be written"),
        (("items_view",), "needs a view"),
    ],
)
def test_conflicts(spark, src, entries, message):
    with pytest.raises(CrateError, match=message):
        expand(spark, _objects(src, *entries))


def test_missing_source(spark, src):
    objects = loads(f"[[objects]]\nselect = 'select * from {src}.nowhere'\nexport_as = 'view'").objects
    with pytest.raises(CrateError, match="does not exist"):
        expand(spark, objects)


def test_dry_run(spark, src):
    rows = describe_plan(spark, _objects(src, "outer")).orderBy("position").collect()
    assert [(row["source_name"], row["required_by"]) for row in rows] == [
        ("reefs", 0), ("shallow", 0), ("picks", None),
    ]


def test_edges_see_subqueries_and_ctes(spark, src):
    spark.sql(
        f"CREATE VIEW {src}.deep AS WITH dives AS (SELECT id FROM {src}.shallow)"
        f" SELECT * FROM dives WHERE id IN (SELECT id FROM {src}.spares)"
        f" OR EXISTS (SELECT 1 FROM {src}.picks o WHERE o.id = dives.id)"
    )
    assert dependencies(spark, src, "deep") == [
        (src, "reefs"), (src, "shallow"), (src, "picks"), (src, "spares"),
    ]
    spark.sql(f"CREATE VIEW {src}.constant AS SELECT 1 AS one")
    assert dependencies(spark, src, "constant") == []


def test_longest_path_decides(spark):
    edges = [("s", "top", "s", "a"), ("s", "top", "s", "b"), ("s", "b", "s", "a"), ("s", "a", "s", "it's")]
    found = dependency_order(spark, edge_rows(spark, edges), "s", "top").collect()
    assert [(row["name"], row["depth"]) for row in found] == [("it's", 3), ("a", 2), ("b", 1)]
