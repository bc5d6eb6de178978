from __future__ import annotations

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from tablecrate.operators import profile as profiles
from tablecrate.reports.describe import profile_report

COLUMNS = "k int, s string, d double, b binary, dt date, a array<int>"


def _rows(count: int = 3_000) -> list[tuple]:
    """A third of all rows shares one key; other values are spread."""
    rng = random.Random(7)
    rows = []
    for i in range(count):
        hot = i % 3 == 0
        rows.append(
            (
                1 if hot else rng.randrange(500),
                None if rng.random() < 0.2 else ("hot" if hot else f"значение {rng.randrange(40)}"),
                rng.choice([0.0, -0.0, 1.5, float("nan"), None]),
                bytearray(b"x" * rng.randrange(4)),
                date(2020, 1, 1 + rng.randrange(5)),
                [1, rng.randrange(3)],
            )
        )
    return rows


@pytest.fixture(scope="module")
def data(spark):
    rows = _rows()
    return rows, spark.createDataFrame(rows, COLUMNS).repartition(5)


def _distinct(values):
    seen = set()
    for value in values:
        if isinstance(value, float):
            value = "nan" if value != value else value + 0.0
        elif isinstance(value, (list, bytearray)):
            value = tuple(value)
        seen.add(value)
    return len(seen)


WIDTHS = {"k": lambda v: 4, "s": lambda v: len(v.encode()), "d": lambda v: 8, "b": len, "dt": lambda v: 4,
          "a": lambda v: len(str(v).replace(" ", ""))}


@pytest.mark.parametrize("exact", [True, False])
def test_profile_against_brute_force(data, exact):
    rows, df = data
    measured = (profiles.profile_exact if exact else profiles.profile_approximate)(df)
    found = {row["column"]: row for row in measured.collect()}
    for index, name in enumerate(df.columns):
        values = [row[index] for row in rows if row[index] is not None]
        row = found[name]
        assert row["ordinal"] == index + 1 and row["rows"] == len(rows)
        assert row["null_fraction"] == pytest.approx(1 - len(values) / len(rows))
        assert row["distinct_values"] == pytest.approx(_distinct(values), rel=0 if exact else 0.05)
        width = sum(map(WIDTHS[name], values)) / len(values)
        assert row["average_width_bytes"] == pytest.approx(width)


@pytest.mark.parametrize("exact", [True, False])
def test_profile_of_nothing_and_of_nulls(spark, exact):
    measure = profiles.profile_exact if exact else profiles.profile_approximate
    nulls = measure(spark.createDataFrame([(None,), (None,)], "v string")).first()
    assert (nulls["null_fraction"], nulls["distinct_values"], nulls["average_width_bytes"]) == (1.0, 0.0, None)
    empty = measure(spark.createDataFrame([], "v string")).collect()
    assert all(row["rows"] == 0 and row["null_fraction"] is None for row in empty)


def _top(values, top):
    counts = Counter(str(v) for v in values if v is not None)
    return sorted(counts.items(), key=lambda item: (-item[1], item[0].encode()))[:top]


@pytest.mark.parametrize("top", [1, 3, 1_500])
def test_common_values_against_brute_force(data, top):
    rows, df = data
    found = profiles.common_values(df, top, ["k", "s"]).collect()
    for index, name in ((0, "k"), (1, "s")):
        mine = sorted((r["rank"], r["value"], r["rows"], r["frequency"]) for r in found if r["column"] == name)
        expected = _top([row[index] for row in rows], top)
        assert [(value, count) for _, value, count, _ in mine] == expected
        assert [rank for rank, *_ in mine] == list(range(1, len(expected) + 1))
        assert all(f == pytest.approx(c / len(rows)) for _, _, c, f in mine)


def test_binary_values_are_not_shown(data):
    _, df = data
    assert "b" not in {row["column"] for row in profiles.common_values(df, 2).collect()}


@pytest.mark.parametrize("columns", [["k"], ["u"], ["k", "u", "t", "z"]])
def test_common_values_without_counting_all(spark, monkeypatch, tmp_path, columns):
    """Few counters, so that the first summary proves little: near-unique columns, ties, long
    texts, and one value far ahead."""
    monkeypatch.setattr(profiles, "COUNTERS", 64)
    monkeypatch.setattr(profiles, "LEAST_CANDIDATES", 8)
    rng = random.Random(2)
    rows = [(1 if i % 3 == 0 else rng.randrange(900), i, f"{rng.randrange(2_500)} " * 40, i % 7) for i in range(4_000)]
    spark.createDataFrame(rows, "k int, u int, t string, z int").repartition(3).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = profiles.common_values(df, 4, columns).orderBy("ordinal", "rank").collect()
    for name in columns:
        mine = [(r["value"], r["rows"]) for r in found if r["column"] == name]
        assert mine == _top([row["kutz".index(name)] for row in rows], 4)
    cells = profiles._cells(df, ["u"])
    assert profiles.heavy_values(cells, 4).count() < 3_000  # of 4,000 values


def test_texts_are_made_only_of_candidates(spark, monkeypatch):
    """Counters read values as they are, and every type still has its common values exactly."""
    monkeypatch.setattr(profiles, "COUNTERS", 16)
    monkeypatch.setattr(profiles, "LEAST_CANDIDATES", 4)
    monkeypatch.setattr(profiles, "PART_HASHES", 100)
    df = spark.range(0, 900, 1, 4).selectExpr(
        "id AS l", "CAST(id % 70 AS tinyint) AS t", "CAST(id % 50 AS decimal(9,2)) / 8 AS m", "id % 5 = 0 AS o",
        "CASE id % 9 WHEN 0 THEN -0.0D WHEN 1 THEN 0.0D WHEN 2 THEN double('nan') WHEN 3 THEN NULL ELSE id / 64 END AS d",
        "CAST(id % 41 AS float) / 3 AS f", "date_add(DATE'1999-12-01', CAST(id % 61 AS int)) AS dt",
        "CASE WHEN id % 3 > 0 THEN TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 37) END AS n",
        "TIMESTAMP'2020-01-01 00:00:00' + make_dt_interval(0, 0, id % 53) AS ts", "array(id % 31, NULL) AS a",
        "if(id % 4 = 0, 'four', concat('s', id % 90)) AS s", "CAST(NULL AS string) AS none",
    )
    found = profiles.common_values(df, 1).select("ordinal", "rank", "value", "rows")
    every = profiles.value_counts(df).where("value IS NOT NULL").select("ordinal", "value", "rows")
    best = profiles._ranked(every, profiles._by_rows(), 1).select("ordinal", "rank", "value", "rows")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, best.collect()))
    plain = profiles._cells(df, ["l", "t", "m", "o", "d", "f", "dt", "n"])
    plan = profiles.counters(plain)._jdf.queryExecution().executedPlan().toString()
    assert "as string" not in plan


def test_counters_add_up(data):
    """The summaries of two parts make the summary of the whole."""
    _, df = data
    cells = profiles._cells(df, ["k", "s"])
    parts = [profiles.counters(cells.where(F.col("hash") % 2 == r)) for r in (0, 1, -1)]
    merged = parts[0].unionAll(parts[1]).unionAll(parts[2]).groupBy("ordinal", "counter").agg(F.sum("rows"))
    assert sorted(merged.collect()) == sorted(profiles.counters(cells).collect())


def test_ranks_are_trimmed_twice(data):
    _, df = data
    plan = profiles.common_values(df, 3, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [row_number") == 2


def test_enum_labels(data):
    rows, df = data
    labels = sorted({row[1] for row in rows if row[1] is not None}, key=str.encode)
    found = profiles.enum_labels(df, len(labels)).orderBy("position").collect()
    assert [(row["column"], row["position"], row["label"]) for row in found] == [
        ("s", position, label) for position, label in enumerate(labels, start=1)
    ]
    assert profiles.enum_labels(df, len(labels) - 1).count() == 0


def test_report_text(spark):
    profile = spark.createDataFrame(
        [(1, "a", 0.12345, 99.994, 7.5), (2, "b", 0.0, 1234.5, 8.0), (3, "c", 1.0, None, None)],
        "ordinal int, column string, null_fraction double, distinct_values double, average_width_bytes double",
    )
    assert [tuple(row)[2:] for row in profile_report(profile).orderBy("ordinal").collect()] == [
        ("12.35%", "~99.99", "8 bytes"), ("0.00%", "~1235", "8 bytes"), ("100.00%", "unknown", None),
    ]
