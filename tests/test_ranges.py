"""The first n rows by ranges of the sort keys, against sorting everything."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tablecrate.operators import ranges
from tablecrate.operators.ranges import SortKey, first_rows
from tablecrate.operators.selection import parse

SCHEMA = "a int, b string, c double, id int"


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    rng = random.Random(3)
    rows = [
        (
            rng.choice([None, 1, 1, 1, 1, 2, 3, rng.randrange(50)]),
            rng.choice([None, "", "x", "x", f"s{rng.randrange(20)}"]),
            rng.choice([None, 0.0, float("nan"), float("inf"), rng.random()]),
            i,
        )
        for i in range(6_000)
    ]
    path = str(tmp_path_factory.mktemp("ranges") / "t")
    spark.createDataFrame(rows, SCHEMA).repartition(7).write.parquet(path)
    return rows, spark.read.parquet(path)


def place(value, descending: bool, nulls_first: bool):
    if value is None:
        return (0 if nulls_first else 2, 0)
    number = isinstance(value, float)
    key = ((1, 0) if value != value else (0, value)) if number else value
    return (1, Reversed(key) if descending else key)


class Reversed:
    def __init__(self, key):
        self.key = key

    def __lt__(self, other):
        return other.key < self.key

    def __eq__(self, other):
        return other.key == self.key


ORDERS = [
    [("a", False, False), ("b", True, True), ("c", False, False), ("id", False, False)],
    [("c", True, False), ("id", True, False)],
    [("b", False, True), ("a", True, False), ("id", False, False)],
    [("id", False, False)],
]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("n", [40, 2_999])
def test_against_a_full_sort(spark, data, monkeypatch, order, n):
    monkeypatch.setattr(ranges, "SAMPLE", 400)
    rows, df = data
    keys = [SortKey(F.col(name), down, first) for name, down, first in order]
    found = first_rows(df, keys, n)
    assert found.columns == df.columns
    index = {"a": 0, "b": 1, "c": 2, "id": 3}
    ranked = sorted(rows, key=lambda r: [place(r[index[name]], down, first) for name, down, first in order])
    assert {r["id"] for r in found.select("id").collect()} == {r[3] for r in ranked[:n]}


@pytest.mark.parametrize("n", [0, 1_500, 4_000, 5_999, 2**40])
def test_ties_are_cut_to_the_number(data, monkeypatch, n):
    """Thousands of rows share the last key."""
    monkeypatch.setattr(ranges, "SAMPLE", 300)
    rows, df = data
    found = first_rows(df, [SortKey(F.col("a"))], n)
    got = sorted((r["a"] is None, r["a"] or 0) for r in found.collect())
    assert got == sorted((r[0] is None, r[0] or 0) for r in rows)[:n]


def test_copies_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(ranges, "SAMPLE", 300)
    df = spark.range(0, 5_000, 1, 4).selectExpr("'same' AS k", "1 AS v")
    assert parse("select k from a.b order by v limit 1234").rows(df).count() == 1_234
    assert parse("select k from a.b limit 4321").rows(df).count() == 4_321


def test_no_task_reads_the_result_whole(spark, data, tmp_path):
    """Neither the plan nor the written files gather the rows of a limit."""
    path = str(tmp_path / "t")
    spark.range(0, 200_000, 1, 8).selectExpr("id", "id % 3 AS k").write.parquet(path)
    found = parse("select id, k from a.b order by k desc, id limit 150000").rows(spark.read.parquet(path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "SinglePartition" not in plan and "TakeOrdered" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 150_000 and max(sizes) < 75_000


def test_changing_rows_are_written_first(spark):
    df = spark.range(0, 3_000, 1, 4).select("id", F.rand().alias("r"))
    assert parse("select id from a.b order by r limit 777").rows(df).count() == 777


def test_the_first_key_reaches_the_files(spark, data):
    _, df = data
    found = first_rows(df, [SortKey(F.col("id"))], 50)
    found.collect()
    assert sorted(r["id"] for r in found.collect()) == list(range(50))


@pytest.mark.parametrize(
    "expression",
    [
        "timestamp_micros(id * 1234567891 - 4000000000000)", "timestamp_micros(id * 7 + 1635642000000000)",
        "cast(timestamp_micros(id * 1234567891) as timestamp_ntz)", "cast(date_add(date '1969-12-01', cast(id as int)) as date)",
        "cast(id - 50 as decimal(20, 3))", "cast(concat('k', lpad(id, 4, '0')) as binary)", "id % 2 = 0", "float(id) / 7",
        "array(id % 5, id)", "named_struct('a', timestamp_micros(id % 3), 'b', array(id))", "make_dt_interval(0, 0, 0, id)",
        "make_ym_interval(0, cast(id as int))",
    ],
)
def test_keys_of_every_type(spark, monkeypatch, expression):
    monkeypatch.setattr(ranges, "SAMPLE", 150)
    df = spark.range(0, 600, 1, 3).selectExpr("id", f"{expression} AS k")
    for down in (False, True):
        found = first_rows(df, [SortKey(F.col("k"), down), SortKey(F.col("id"))], 222).select("id").collect()
        expected = df.orderBy(F.col("k").desc() if down else F.col("k"), "id").limit(222).select("id").collect()
        assert sorted(found) == sorted(expected)
