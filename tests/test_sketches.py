"""Stored statistics: merged sketches against counting everything."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from tablecrate import CrateError, describe, export_snapshot, load_snapshot, loads
from tablecrate.config import JobConfig, ObjectConfig
from tablecrate.operators import sketches
from tablecrate.operators.selection import parse
from tablecrate.sources import relations


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [(1 if i % 3 == 0 else rng.randrange(700), rng.choice([None, "a", "b", "é"]), i / 4) for i in range(3_000)]


def parts(spark, rows):
    df = [spark.createDataFrame(rows[i::3], "k int, s string, d double") for i in range(3)]
    return df, df[0].unionAll(df[1]).unionAll(df[2])


def test_merged_lists_keep_their_bounds(spark, rows, monkeypatch):
    """Lists far too short for all values: every count lies between the bounds."""
    monkeypatch.setattr(sketches, "CAPACITY", 5)
    batches, whole = parts(spark, rows)
    every = sketches.sketch(batches[0]).unionAll(sketches.sketch(batches[1])).unionAll(sketches.sketch(batches[2]))
    found = {r["column"]: r for r in sketches.merged(every).collect()}
    direct = {r["column"]: r for r in sketches.sketch(whole).collect()}
    for i, name in enumerate("ks"):
        counts = Counter(str(r[i]) for r in rows if r[i] is not None)
        listed = {v["value"]: v for v in found[name]["common"]}
        assert len(listed) == min(5, len(counts))
        for value, entry in listed.items():
            assert entry["rows"] <= counts[value] <= entry["rows"] + entry["extra"]
        assert all(n <= found[name]["bound"] for value, n in counts.items() if value not in listed)
        assert found[name]["common"][0]["value"] == counts.most_common(1)[0][0]
    assert found["s"]["bound"] == 0 and found["k"]["bound"] > 0
    for name in "ksd":
        assert (found[name]["rows"], found[name]["present"], found[name]["bytes"]) == (
            direct[name]["rows"], direct[name]["present"], direct[name]["bytes"]
        )
    estimates = lambda df: {r["column"]: r["distinct_values"] for r in sketches.summary(df).collect()}
    for name, estimate in estimates(sketches.sketch(whole)).items():
        assert estimates(sketches.merged(every))[name] == pytest.approx(estimate, rel=0.03)


def test_nothing_and_nulls(spark):
    empty = sketches.summary(sketches.merged(sketches.sketch(spark.createDataFrame([], "v string, n int"))), 2).collect()
    assert [(r["rows"], r["null_fraction"], r["median"], r["common"]) for r in empty] == [(0, None, None, [])] * 2
    nulls = spark.createDataFrame([(None, None), (None, 3)], "v string, n int")
    found = {r["column"]: r for r in sketches.summary(sketches.sketch(nulls), 2).collect()}
    assert found["v"]["null_fraction"] == 1.0 and found["v"]["average_width_bytes"] is None
    assert found["n"]["median"] == 3.0 and found["n"]["common"][0]["value"] == "3"


def test_append_adds_to_the_store(spark, rows, schema, target, tmp_path):
    df, whole = parts(spark, rows)
    df[0].write.saveAsTable(f"{schema}.t")
    item = ObjectConfig(parse(f"select * from {schema}.t"), target=(target, "t"))
    export_snapshot(spark, JobConfig(objects=(item,)), str(tmp_path / "snap"))
    load_snapshot(spark, str(tmp_path / "snap"), warehouse=str(tmp_path / "wh"))
    config = loads(f"[[objects]]\nselect = 'select * from {target}.t'\n")
    assert describe(spark, config, statistics=2).relations[0].statistics_status == "unavailable"
    relation = relations.get(spark, target, "t")
    with pytest.raises(CrateError, match="analyzed"):
        sketches.stored(spark, relation)
    sketches.analyze(spark, relation, spark.table(f"{target}.t"))
    sketches.analyze(spark, relation, spark.table(f"{target}.t"))  # in place of the first
    load_snapshot(spark, str(tmp_path / "snap"), mode="append")
    assert spark.table(f"{target}.t").count() == 2 * len(rows[0::3])
    # Even if its rows could not be read, the table is described.
    description = describe(spark, config, statistics=2).relations[0]
    assert description.row_estimate == 2 * len(rows[0::3])
    counts = Counter(r[1] for r in rows[0::3] if r[1])
    top = sorted(counts, key=lambda v: (-counts[v], v))[:2]
    common = description.statistics["s"].most_common_values
    assert [(v.value, v.frequency) for v in common] == [(v, pytest.approx(counts[v] / len(rows[0::3]))) for v in top]
