from __future__ import annotations

from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from tablecrate import CrateError, parse
from tablecrate.functions.names import double_quoted
from tablecrate.operators.selection import spark_text

# Each clause of the grammar with its canonical body, or None for a statement without it.
WHERES = (None, "depth >= 3", "kind = 'limit ''9''' or (\"order by\" is null)", "x in (select x from z.y limit 2)")
ORDERS = (None, "depth desc nulls last, 1", "case when kind = ',' then 1 else 0 end")
LIMITS = (None, 0, 12, 2**63 - 1)


@pytest.mark.parametrize("spacing", [" ", "\n\t", "  "])
@pytest.mark.parametrize("upper", [False, True])
def test_every_combination_of_clauses(spacing, upper):
    keyword = str.upper if upper else str.lower
    for where, order_by, limit in product(WHERES, ORDERS, LIMITS):
        text = f"{keyword('select')} * {keyword('from')} Reef.Soundings"
        text += f"{spacing}{keyword('where')}{spacing}{where}" if where else ""
        text += f"{spacing}{keyword('order')}{spacing}{keyword('by')}{spacing}{order_by}" if order_by else ""
        text += f"{spacing}{keyword('limit')} {limit}" if limit is not None else ""
        found = parse(text)
        assert found.source == ("reef", "soundings") and found.projection == "*"
        assert (found.where, found.order_by, found.limit) == (where, order_by, limit)
        assert found.has_clauses == (where is not None or order_by is not None or limit is not None)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab \"'.,()`*é", min_size=1, max_size=6), min_size=1, max_size=4, unique=True))
def test_any_quoted_name_survives(names):
    listed = ", ".join(map(double_quoted, names))
    schema, name = double_quoted(names[0]), double_quoted(names[-1])
    assert parse(f"select {listed} from {schema}.{name}").columns == tuple(names)
    assert parse(f"select * except ({listed}) from {schema} . {name}").excluded == tuple(names)
    assert parse(f"select * from {schema}.{name} limit 1").source == (names[0], names[-1])


def test_unquoted_names_fold():
    found = parse("select Depth, \"Kind\", _X1 from REEF.2024_dives")
    assert (found.columns, found.source) == (("depth", "Kind", "_x1"), ("reef", "2024_dives"))


COLUMNS = ["depth", "kind", "at"]


@pytest.mark.parametrize(
    ("projection", "kept"),
    [("*", COLUMNS), ("at, depth", ["at", "depth"]), ("* except (kind)", ["depth", "at"])],
)
def test_columns_that_are_kept(projection, kept):
    selection = parse(f"select {projection} from reef.dives")
    assert selection.effective_columns(COLUMNS) == kept
    assert selection.canonical_sql(kept).startswith("SELECT " + ", ".join(map(double_quoted, kept)) + " FROM ")


@pytest.mark.parametrize("listed", ["depth, at, depth", "nowhere", "depth, nowhere"])
@pytest.mark.parametrize("form", ["{}", "* except ({})"])
def test_lists_that_fit_no_table(form, listed):
    with pytest.raises(CrateError, match="nowhere|duplicated"):
        parse(f"select {form.format(listed)} from reef.dives").effective_columns(COLUMNS)


def test_nothing_left_and_equal_names():
    with pytest.raises(CrateError, match="no columns are left"):
        parse("select * except (depth, kind, at) from reef.dives").effective_columns(COLUMNS)
    twice = [*COLUMNS, "kind"]
    with pytest.raises(CrateError, match="duplicate column names"):
        parse("select * except (at) from reef.dives").effective_columns(twice)
    assert parse("select * except (kind) from reef.dives").effective_columns(twice) == ["depth", "at"]


GOOD = "select depth from reef.dives where depth > 1 order by depth limit 5"
# What one change makes of a good statement.
BREAKS = {
    "no verb": GOOD.removeprefix("select"),
    "other verb": GOOD.replace("select", "table", 1),
    "no source": "select depth",
    "bare source": GOOD.replace("reef.", ""),
    "alias": GOOD.replace("dives", "dives d"),
    "two sources": GOOD.replace("dives", "dives, reef.boats"),
    "join": GOOD.replace("where", "cross join reef.boats where"),
    "group": "select depth from reef.dives group by depth",
    "clause order": "select depth from reef.dives limit 5 where depth > 1",
    "clause twice": GOOD + " limit 6",
    "empty where": GOOD.replace("depth > 1 ", ""),
    "empty order": GOOD.replace("by depth", "by"),
    "empty limit": GOOD.replace("limit 5", "limit"),
    "open list": GOOD.replace("by depth", "by depth,"),
    "limit word": GOOD.replace("5", "all"),
    "limit sign": GOOD.replace("5", "-5"),
    "limit point": GOOD.replace("5", "5.0"),
    "limit sum": GOOD.replace("5", "2 + 3"),
    "limit size": GOOD.replace("5", str(2**63)),
    "second statement": GOOD + "; select 1",
    "expression": GOOD.replace("depth from", "depth * 2 from"),
    "renamed": GOOD.replace("depth from", "depth as d from"),
    "digit first": GOOD.replace("depth from", "2depth from"),
    "empty name": GOOD.replace("depth from", '"" from'),
    "open select": GOOD.replace("depth from", "depth, from"),
    "star and more": GOOD.replace("depth from", "*, depth from"),
    "except without list": GOOD.replace("depth from", "* except depth from"),
    "except nothing": GOOD.replace("depth from", "* except () from"),
}


@pytest.mark.parametrize("name", list(BREAKS))
def test_one_change_is_refused(name):
    parse(GOOD)
    with pytest.raises(CrateError):
        parse(BREAKS[name])


def _select(spark, text, data, columns):
    return [tuple(row) for row in parse(text).rows(spark.createDataFrame(data, columns)).collect()]


NULLABLE = [(1, 5), (2, None), (3, 9), (4, None)]


@pytest.mark.parametrize(
    ("order", "expected"),
    [
        ("v, id", [1, 3, 2, 4]),
        ("v desc, id", [2, 4, 3, 1]),
        ("v nulls first, id desc", [4, 2, 1, 3]),
        ("v desc nulls last, id", [3, 1, 2, 4]),
        ("v DESC NULLS LAST, id", [3, 1, 2, 4]),
        ("coalesce(v, 0) + 1 desc, id", [3, 1, 2, 4]),
        ("2, 1", [1, 3, 2, 4]),
        ("case when v is null then 'a, desc' else 'b' end, id", [2, 4, 1, 3]),
    ],
)
def test_null_order(spark, order, expected):
    for tail in ("", " limit 10"):
        rows = _select(spark, f"select id, v from a.b order by {order}{tail}", NULLABLE, "id int, v int")
        assert [row[0] for row in rows] == expected


@pytest.mark.parametrize("order", ["v descending", "v desc nulls", "v using >", "v asc desc"])
def test_stray_words_in_order_by_are_errors(spark, order):
    with pytest.raises((CrateError, ParseException)):
        _select(spark, f"select id from a.b order by {order}", NULLABLE, "id int, v int")


def test_filter_and_sort_use_unselected_columns(spark):
    rows = _select(
        spark, "select id from a.b where v is not null order by v desc limit 1", NULLABLE, "id int, v int"
    )
    assert rows == [(3,)]


def test_backslash_and_doubled_quote_are_standard(spark):
    data = [(1, "a\\nb"), (2, "a\nb"), (3, "order by 'limit'"), (4, "1-2")]
    columns = "id int, v string"
    assert _select(spark, r"select id from a.b where v = 'a\nb'", data, columns) == [(1,)]
    assert _select(spark, "select id from a.b where v = 'order by ''limit'''", data, columns) == [(3,)]
    assert _select(spark, r"select id from a.b where v rlike '^\d-\d$'", data, columns) == [(4,)]
    assert _select(spark, 'select id from a.b where "id" > 3', data, columns) == [(4,)]
    assert spark_text(r"""x = '\' and "a\b" > 1""") == r"""x = '\\' and "a\b" > 1"""


@pytest.mark.parametrize("limit", [0, 1, 99, 100, 101, 25_000, 2**31 + 5])
def test_one_promise_at_every_limit(spark, tmp_path, limit):
    """In order, in `collect()` and in the files of a write."""
    size = 30_000 if limit > 1_000 else 100
    source = spark.range(0, size, 1, 7).selectExpr("id", "id % 3 AS k")
    expected = sorted(((i, i % 3) for i in range(size)), key=lambda r: (-r[1], r[0]))[:limit]
    found = parse(f"select id, k from a.b order by k desc, id limit {limit}").rows(source)
    assert list(map(tuple, found.collect())) == expected
    found.write.parquet(str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    placed = written.orderBy("_metadata.file_name", "_metadata.row_index").collect()
    assert list(map(tuple, placed)) == expected
    if limit < 2**31:
        unordered = parse(f"select id from a.b limit {limit}").rows(source)
        assert unordered.distinct().count() == unordered.count() == min(limit, size)


@pytest.mark.parametrize("columns", ["id, k, pad", "k, pad"])
def test_hot_sort_key_is_spread(spark, tmp_path, columns):
    """A sort on one constant key must not end in one partition, not even if all rows
    are copies of one."""
    rows = spark.range(0, 20_000, 1, 4).selectExpr("id", "'same' AS k", "repeat('x', 50) AS pad")
    rows.write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    ordered = parse(f"select {columns} from a.b order by k").rows(source)
    assert ordered.columns == columns.split(", ")
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # joins what is this small
    spark.conf.set(key, "false")
    try:
        counted = ordered.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset(key)
    sizes = [row["count"] for row in counted]
    assert sum(sizes) == 20_000
    assert max(sizes) < 12_000


NOT_IN = [
    ("k not in (select v from {s}.listed where v < 3)", [3, 4]),
    ("k not in (select v from {s}.listed)", []),  # the list holds a NULL
    ("k not in (select v from {s}.listed where v > 99)", [None, 1, 2, 3, 4]),  # an empty list
    ("k > 0 and K Not  In (select v from {s}.listed where v = 1) and k < 4", [2, 3]),
    ("k between 2 and 4 and k not in (with w as (select 3 as x) select x from w)", [2, 4]),
    ("k + 1 not in (select v from {s}.listed where v = 2)", [2, 3, 4]),
    ("k not in (1, 2)", [3, 4]),
    ("k = 1 or k not in (select v from {s}.listed where v < 4)", [1, 3, 4]),
    ("k not in (select v from {s}.listed where v < 3 and v = k)", [3, 4, None]),  # refers to the row
    ("k is null and 'a and b not in (c)' not in (select 'x')", [None]),
]


@pytest.mark.parametrize(("where", "expected"), NOT_IN)
def test_not_in(spark, schema, where, expected):
    spark.createDataFrame([(k,) for k in (None, 1, 2, 3, 4)], "k int").write.saveAsTable(f"{schema}.t")
    spark.createDataFrame([(v,) for v in (1, 2, None)], "v int").write.saveAsTable(f"{schema}.listed")
    rows = parse(f"select k from {schema}.t where {where.format(s=schema)}").rows(spark.table(f"{schema}.t"))
    assert sorted((r["k"] for r in rows.collect()), key=str) == sorted(expected, key=str)
    if "or k" not in where and "v = k" not in where:
        assert "NestedLoop" not in rows._jdf.queryExecution().executedPlan().toString()
