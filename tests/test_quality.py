from __future__ import annotations

import random
from collections import Counter

import pytest

from tablecrate import CrateError
from tablecrate.config import Constraint
from tablecrate.operators import keys, quality
from tablecrate.operators.numbering import with_positions
from tablecrate.operators.reconcile import SPLIT_BITS, differing_buckets, reconcile


def _bag(df):
    return Counter(tuple(row) for row in df.collect())


def test_reconcile_against_brute_force(spark):
    rng = random.Random(3)
    # One row makes up a third of the left side and a different share of the right.
    left = [(1, "hot", 0.5)] * 400 + [(rng.randrange(50), rng.choice("abc"), None) for _ in range(800)]
    right = [(1, "hot", 0.5)] * 390 + [(rng.randrange(50), rng.choice("abc"), None) for _ in range(800)]
    columns = "k int, s string, d double"
    found = reconcile(
        spark.createDataFrame(left, columns).repartition(5), spark.createDataFrame(right, columns)
    )
    expected = Counter()
    for row, count in (Counter(left) - Counter(right)).items():
        expected[(*row, "left", count)] = 1
    for row, count in (Counter(right) - Counter(left)).items():
        expected[(*row, "right", count)] = 1
    assert _bag(found) == expected


def test_reconcile_tells_null_positions_apart(spark):
    left = spark.createDataFrame([(None, "a"), ("b", None)], "x string, y string")
    right = spark.createDataFrame([("a", None), ("b", None)], "x string, y string")
    assert _bag(reconcile(left, right)) == {
        (None, "a", "left", 1): 1, ("a", None, "right", 1): 1,
    }
    assert reconcile(left, left).collect() == []
    with pytest.raises(CrateError, match="cannot compare"):
        reconcile(left, right.select("y", "x"))


def test_scattered_differences_are_narrowed_down(spark):
    """Few rows besides the changed ones reach the last step, wherever the changes lie."""
    left = spark.range(300_000).selectExpr("id", "id % 97 AS v")
    right = left.selectExpr("id", "CASE WHEN id % 60 = 0 THEN v + 1 ELSE v END AS v")
    found = differing_buckets(left, right)
    assert 10_000 <= found.rows <= 14_000  # 5,000 changes on either side
    assert found.bits > 2 * SPLIT_BITS
    result = reconcile(left, right)
    assert result.count() == 10_000
    assert result.where("side = 'left'").agg({"id": "sum"}).first()[0] == sum(range(0, 300_000, 60))
    assert result.where("id % 60 <> 0 OR copies <> 1").count() == 0


def test_reconcile_where_everything_differs_or_repeats(spark):
    many = spark.range(20_000).selectExpr("1 AS v")
    few = spark.range(50).selectExpr("1 AS v")
    assert _bag(reconcile(many, few)) == {(1, "left", 19_950): 1}
    other = spark.range(20_000).selectExpr("id")
    found = differing_buckets(other, other.selectExpr("id + 20000"))
    assert found.rows == 40_000 and found.bits <= 4 * SPLIT_BITS
    empty = other.limit(0)
    assert reconcile(other, empty).count() == 20_000 and reconcile(empty, empty).count() == 0


@pytest.mark.parametrize("most_broadcast", [0, 1 << 20])
def test_reconcile_deals_by_size(spark, monkeypatch, most_broadcast):
    """Tasks by the rows they get, whatever the session says; copies beyond a task's share are
    counted where they are read."""
    from tablecrate.operators import reconcile as module

    monkeypatch.setattr(module, "PART_ROWS", 300)
    monkeypatch.setattr(module, "MOST_BROADCAST", most_broadcast)
    same = spark.range(0, 8_000, 1, 5).selectExpr("-1L AS id", "'hot' AS s", "0.0D AS d")
    more = spark.range(0, 4_000, 1, 3).selectExpr("-2L AS id", "'hot' AS s", "double('nan') AS d")
    left = spark.range(9_000).selectExpr("id", "CAST(id % 7 AS string) AS s", "CAST(id AS double) / 4 AS d")
    right = left.selectExpr("id", "CASE WHEN id % 9 > 0 THEN s END AS s", "d").unionAll(more)
    right = right.unionAll(same.selectExpr("id", "s", "-0.0D AS d"))
    left = left.unionAll(same).unionAll(more).unionAll(more)
    found = differing_buckets(left, right)
    assert (found.bits, found.count, found.rows) == (64, 2_001, 14_000)
    crowds = {(r["rows"], r["delta"]) for r in found.crowds.collect()}
    assert crowds == {(12_000, 4_000)}
    result = reconcile(left, right)
    if not most_broadcast:
        assert result.rdd.getNumPartitions() >= found.rows * 4 // 300
    rows = [tuple(r) for r in result.collect()]
    assert [r[3:] for r in rows if r[0] < 0] == [("left", 4_000)]
    plain = Counter(r for r in rows if r[0] >= 0)
    expected = [(i, str(i % 7) if side == "left" else None, i / 4, side, 1) for i in range(0, 9_000, 9) for side in ("left", "right")]
    assert plain == Counter(expected)


def test_reconcile_maps(spark):
    left = spark.createDataFrame([({"a": 1, "b": 2}, [{"x": 1}])], "m map<string,int>, n array<map<string,int>>")
    right = spark.createDataFrame([({"b": 2, "a": 1}, [{"x": 2}])], "m map<string,int>, n array<map<string,int>>")
    assert reconcile(left.select("m"), right.select("m")).collect() == []
    assert reconcile(left, right).count() == 2


def test_duplicate_keys(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a"), (2, "a")]
    found = quality.duplicate_keys(spark.createDataFrame(rows, "x int, y string"), ["x", "y"])
    assert _bag(found) == {(1, "a", 2): 1}


def test_check_passes_null(spark):
    rows = [(1,), (-1,), (None,)]
    assert _bag(quality.check_violations(spark.createDataFrame(rows, "x int"), "x > 0")) == {(-1,): 1}


def test_orphan_keys(spark):
    child = [(1, "a")] * 500 + [(9, "a")] * 300 + [(None, "a"), (1, None), (2, "b"), (3, "x")]
    parent = [(1, "a"), (2, "b"), (None, None)]
    found = quality.orphan_keys(
        spark.createDataFrame(child, "k int, s string"), ["k", "s"],
        spark.createDataFrame(parent, "pk int, ps string"), ["pk", "ps"],
    )
    assert _bag(found) == {(9, "a", 300): 1, (3, "x", 1): 1}
    same = spark.createDataFrame([(1, None), (2, 1), (3, 7)], "id int, parent int")
    assert _bag(quality.orphan_keys(same, ["parent"], same, ["id"])) == {(7, 1): 1}


def test_foreign_keys_outside(spark):
    declared = [
        Constraint(("s", "child"), "fk1", "foreign_key", ("a",), ("s", "parent"), ("b",)),
        Constraint(("s", "child"), "fk2", "foreign_key", ("a",), ("t", "parent"), ("b",)),
        Constraint(("s", "other"), "fk3", "foreign_key", ("a",), ("t", "parent"), ("b",)),
        Constraint(("s", "child"), "pk", "primary_key", ("a",)),
    ]
    found = quality.foreign_keys_outside(spark, declared, [("s", "child"), ("s", "parent"), ("s", "child")])
    assert [row["warning"] for row in found.collect()] == [
        "Foreign key fk2 on s.child references t.parent, which is not selected"
    ]


def test_positions(spark):
    df = spark.range(0, 1_000, 1, 8).selectExpr("id", "id % 2 AS k")
    found = with_positions(df, "p", [df["k"].desc(), df["id"].asc()]).collect()
    expected = sorted(range(1_000), key=lambda i: (-(i % 2), i))
    assert [row["id"] for row in sorted(found, key=lambda row: row["p"])] == expected
    assert sorted(row["p"] for row in found) == list(range(1_000))
    assert df.columns == ["id", "k"]
    assert with_positions(df.where("id < 0"), "p").count() == 0


def test_watermark(spark):
    df = spark.createDataFrame([(5, None), (-3, None)], "a long, b int")
    assert _bag(keys.key_watermark(df, ["a", "b"])) == {("a", 6): 1, ("b", 1): 1}


def test_nested_values_have_their_own_hashes(spark):
    """Values that Spark's hash runs together are told apart, and so are odd names."""
    from tablecrate.functions.digest import row_hash_sum
    from tablecrate.operators.reconcile import reconcile

    pairs = [
        ("array(1, null)", "array(null, 1)"), ("array(1, null)", "array(1)"),
        ("struct(1 AS a, CAST(null AS int) AS b)", "struct(CAST(null AS int) AS a, 1 AS b)"),
        ("array(array('a'), array('b'))", "array(array('a', 'b'))"), ("array(CAST(null AS int))", "null"),
        ("map('a', 1)", "map('a', CAST(null AS int))"),
    ]
    for one, other in pairs:
        left = spark.sql(f"SELECT 1 AS `o``dd`, 2 AS side, {one} AS v")
        right = spark.sql(f"SELECT 1 AS `o``dd`, 2 AS side, {other} AS v")
        assert left.agg(row_hash_sum(left)).first() != right.agg(row_hash_sum(right)).first()
        found = reconcile(left, right)
        assert found.columns == ["o`dd", "side", "v", "side_", "copies"]
        assert sorted(r["side_"] for r in found.collect()) == ["left", "right"]
        assert reconcile(left, left).collect() == []


def test_hash_sum_is_exact(spark):
    from tablecrate.functions.digest import hash_sum

    values = [-(1 << 63), (1 << 63) - 1, -1, 0, 1, 65_535, -65_536, 1 << 40]
    df = spark.createDataFrame([(v,) for v in values * 3], "h long")
    assert int(df.agg(hash_sum(df["h"])).first()[0]) == 3 * sum(values)


def test_check_text_is_that_of_a_where_clause(spark):
    df = spark.createDataFrame([("a1",), ("ab",), (None,)], "v string")
    assert [r["v"] for r in quality.check_violations(df, r"v rlike '^[a-z]\d$'").collect()] == ["ab"]


def test_constraints_of_one_name_stay_apart(spark, schema):
    spark.range(10).selectExpr("id", "id % 3 AS k").write.saveAsTable(f"{schema}.t")
    declared = [
        Constraint((schema, "t"), "same", "check", expression="id < 8"),
        Constraint((schema, "t"), "same", "check", expression="k > 0"),
        Constraint((schema, "t"), "same", "primary_key", columns=("k",)),
    ]
    report = quality.constraint_report(spark, declared).collect()
    assert sorted((r["kind"], r["violations"]) for r in report) == [("check", 2), ("check", 4), ("primary_key", 10)]
