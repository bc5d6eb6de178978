from __future__ import annotations

from pathlib import Path

import pytest

from fixture_tables import DIVES_SCHEMA, config, create
from tablecrate import CrateError, export_snapshot, load_snapshot, loads, open_snapshot
from tablecrate.config import JobConfig, ObjectConfig, select_objects
from tablecrate.operators.keys import assign_keys
from tablecrate.operators.loading import compatibility, not_null_violations
from tablecrate.operators.reconcile import reconcile
from tablecrate.operators.selection import parse
from tablecrate.sinks.load import declare_not_null, next_values, purge_versions
from tablecrate.sources import manifests, relations


@pytest.fixture
def src(spark, schema):
    create(spark, schema)
    return schema


def _one(spark, out, select, target, name):
    item = ObjectConfig(parse(select), target=(target, name))
    export_snapshot(spark, JobConfig((item,)), out)
    return out


@pytest.mark.parametrize("data_format", ["binary", "csv"])
def test_replace_append_and_schema_only(spark, src, target, tmp_path, data_format):
    out, warehouse = str(tmp_path / "snap"), str(tmp_path / "wh")
    export_snapshot(spark, config(src, target, data_format=data_format), out)

    loaded = load_snapshot(spark, out, warehouse=warehouse, workers=3)
    assert {row["name"]: row["rows"] for row in loaded.collect()} == {
        "dives": 3, "deepest": 1, "plain": 3, "spares": 0,
    }
    dives = spark.table(f"{target}.dives")
    assert reconcile(spark.table(f"{src}.dives"), dives).count() == 0
    assert next_values(spark, target, "dives") == {"id": 32, "tag": 611}
    assert next_values(spark, target, "spares") == {"id": 1}
    assert next_values(spark, target, "deepest") == {"id": 10}
    defaults = {c.name: c.default for c in relations.get(spark, target, "dives").columns}
    assert defaults["site"] == "'unnamed'" and defaults["depth"] == "5"

    load_snapshot(spark, out, mode="append", warehouse=warehouse)
    assert spark.table(f"{target}.dives").count() == 6
    assert next_values(spark, target, "dives") == {"id": 32, "tag": 611}

    load_snapshot(spark, out, warehouse=warehouse)
    assert spark.table(f"{target}.dives").count() == 3
    load_snapshot(spark, out, mode="append", schema_only=True, warehouse=warehouse)
    assert spark.table(f"{target}.dives").count() == 3
    load_snapshot(spark, out, schema_only=True, warehouse=warehouse)
    assert [spark.table(f"{target}.{name}").count() for name in ("dives", "deepest")] == [0, 0]
    assert next_values(spark, target, "dives") == {"id": 1, "tag": 1}


def test_keys_continue_after_a_load(spark, src, target, tmp_path):
    out = str(tmp_path / "snap")
    export_snapshot(spark, config(src, target), out)
    load_snapshot(spark, out, warehouse=str(tmp_path / "wh"))
    start = next_values(spark, target, "dives")["id"]
    new = spark.createDataFrame([("b",), ("a",), ("c",)], "site string")
    keyed = assign_keys(new, "id", start, [new["site"].asc()])
    assert sorted(map(tuple, keyed.collect())) == [(32, "a"), (33, "b"), (34, "c")]


def test_append_sees_rows_written_in_between(spark, src, target, tmp_path):
    out, warehouse = str(tmp_path / "snap"), str(tmp_path / "wh")
    export_snapshot(spark, config(src, target), out)
    load_snapshot(spark, out, warehouse=warehouse)
    spark.sql(f"INSERT INTO {target}.dives (id, tag) VALUES (90, 1)")
    load_snapshot(spark, out, mode="append", warehouse=warehouse)
    assert next_values(spark, target, "dives") == {"id": 91, "tag": 611}


def test_damaged_payload_leaves_the_old_table(spark, src, target, tmp_path):
    out, warehouse = str(tmp_path / "snap"), str(tmp_path / "wh")
    for data_format in ("binary", "csv"):
        export_snapshot(spark, config(src, target, data_format=data_format), out)
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {target} LOCATION '{warehouse}/{target}'")
        spark.sql(f"DROP TABLE IF EXISTS {target}.dives")
        spark.sql(
            f"CREATE TABLE {target}.dives (marker STRING) USING parquet"
            f" LOCATION '{warehouse}/kept_{data_format}'"
        )
        spark.sql(f"INSERT INTO {target}.dives VALUES ('preserved')")
        item = open_snapshot(spark, out).manifest.objects[0]
        for file in Path(out, item.payload).glob("part-*"):
            file.write_bytes(b"invalid payload\n")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
        with pytest.raises(Exception):
            load_snapshot(spark, out, warehouse=warehouse)
        assert not list(Path(warehouse, target).glob("dives/*/*"))
        assert [row["marker"] for row in spark.table(f"{target}.dives").collect()] == ["preserved"]


def test_missing_rows_are_noticed(spark, src, target, tmp_path):
    spark.range(0, 100, 1, 4).write.saveAsTable(f"{src}.many")
    out = _one(spark, str(tmp_path / "snap"), f"select * from {src}.many", target, "many")
    item = open_snapshot(spark, out).manifest.objects[0]
    lost = sorted(Path(out, item.payload).glob("part-*"))[0]
    other = spark.range(0, 25).coalesce(1)  # as many rows, but other values
    other.write.parquet(str(tmp_path / "other"))
    lost.write_bytes(next((tmp_path / "other").glob("part-*")).read_bytes())
    lost.with_name(f".{lost.name}.crc").unlink(missing_ok=True)
    swapped = spark.read.parquet(f"{out}/{item.payload}").count()
    message = "checksum" if swapped == 100 else "row count"
    for mode in ("replace", "append"):
        if swapped == 100 and reconcile(
            spark.table(f"{src}.many"), spark.read.parquet(f"{out}/{item.payload}")
        ).count() == 0:
            lost.unlink()
            message = "row count"
        with pytest.raises(CrateError, match=message):
            load_snapshot(spark, out, mode=mode, warehouse=str(tmp_path / "wh"))
        assert relations.find(spark, target, "many") is None


def test_incomplete_snapshot(spark, src, target, tmp_path):
    out = _one(spark, str(tmp_path / "snap"), f"select * from {src}.dives", target, "dives")
    item = open_snapshot(spark, out).manifest.objects[0]
    Path(out, item.payload, "_SUCCESS").unlink()
    with pytest.raises(CrateError, match="not complete"):
        load_snapshot(spark, out, warehouse=str(tmp_path / "wh"))
    load_snapshot(spark, out, schema_only=True, warehouse=str(tmp_path / "wh"))
    assert spark.table(f"{target}.dives").count() == 0


def test_views_come_after_their_tables(spark, src, tmp_path):
    item = ObjectConfig(parse(f"select * from {src}.picks"), export_as="view")
    out = str(tmp_path / "snap")
    manifest = export_snapshot(spark, JobConfig((item,)), out)
    assert [o.source.name for o in manifest.objects] == ["reefs", "shallow", "picks"]
    before = spark.table(f"{src}.picks").collect()
    for name, kind in (("picks", "VIEW"), ("shallow", "VIEW"), ("reefs", "TABLE")):
        spark.sql(f"DROP {kind} {src}.{name}")
    load_snapshot(spark, out)
    assert spark.table(f"{src}.picks").collect() == before
    assert relations.get(spark, src, "shallow").kind == "table"
    assert relations.get(spark, src, "picks").kind == "view"
    load_snapshot(spark, out)  # replaces the view and the tables below it
    assert spark.table(f"{src}.picks").collect() == before
    with pytest.raises(CrateError, match="append mode does not support the view"):
        load_snapshot(spark, out, mode="append")


def test_view_keeps_the_meaning_of_its_text(base_spark, spark, src, tmp_path):
    """A view written in a session where "..." is a string still says so after a load."""
    base_spark.sql(f'CREATE VIEW {src}.quoted AS SELECT "a\\tb" AS v')
    item = ObjectConfig(parse(f"select * from {src}.quoted"), export_as="view")
    out = str(tmp_path / "snap")
    export_snapshot(spark, JobConfig((item,)), out)
    load_snapshot(spark, out)
    assert spark.table(f"{src}.quoted").collect() == [("a\tb",)]


def test_not_null(spark, src, target, tmp_path):
    out, warehouse = str(tmp_path / "snap"), str(tmp_path / "wh")
    export_snapshot(spark, config(src, target), out)
    load_snapshot(spark, out, warehouse=warehouse)
    before = spark.table(f"{target}.dives").count()
    spark.createDataFrame([(None, 1, "x", 1, None, None, None, None)], DIVES_SCHEMA).write.insertInto(
        f"{src}.dives"
    )
    export_snapshot(spark, config(src, target), out)
    for mode in ("replace", "append"):
        with pytest.raises(Exception, match="NULL in NOT NULL column id"):
            load_snapshot(spark, out, mode=mode, warehouse=warehouse)
        assert spark.table(f"{target}.dives").count() == before
    found = not_null_violations(spark.table(f"{src}.dives"), ["id", "depth"]).collect()
    assert [tuple(row) for row in found] == [("id", 1), ("depth", 0)]


def test_append_checks(spark, src, target, tmp_path):
    out, warehouse = str(tmp_path / "snap"), str(tmp_path / "wh")
    _one(spark, out, f"select id, site from {src}.dives", target, "t")
    spark.sql(f"CREATE SCHEMA {target} LOCATION '{warehouse}/{target}'")

    def recreate(columns):
        spark.sql(f"DROP TABLE IF EXISTS {target}.t")
        spark.sql(f"CREATE TABLE {target}.t ({columns}) USING parquet")

    for columns, message in (
        ("id BIGINT", "site is missing"),
        ("id INT, site STRING", "id is type differs"),
    ):
        recreate(columns)
        with pytest.raises(CrateError, match=message):
            load_snapshot(spark, out, mode="append", warehouse=warehouse)
        assert spark.table(f"{target}.t").count() == 0
    recreate("extra STRING DEFAULT 'web', site STRING, id BIGINT, note INT")
    load_snapshot(spark, out, mode="append", warehouse=warehouse)
    assert spark.table(f"{target}.t").where("id = 31").collect() == [("web", None, 31, None)]
    declare_not_null(spark, target, "t", ["note"])
    with pytest.raises(CrateError, match="note would be NULL"):
        load_snapshot(spark, out, mode="append", warehouse=warehouse)
    spark.sql(f"DROP TABLE {target}.t")
    spark.sql(f"CREATE VIEW {target}.t AS SELECT 1 AS id")
    with pytest.raises(CrateError, match="append needs a table"):
        load_snapshot(spark, out, mode="append", warehouse=warehouse)
    load_snapshot(spark, out, warehouse=warehouse)  # replace takes the view's place
    assert relations.get(spark, target, "t").kind == "table"


def test_compatibility_without_recorded_types(spark, src):
    report = compatibility(["id", "nope"], [], relations.get(spark, src, "dives"))
    assert report == [("id", None, "bigint", "ok"), ("nope", None, None, "missing")]


def test_batch_is_loaded_once(spark, src, target, tmp_path):
    out, warehouse = str(tmp_path / "snap"), str(tmp_path / "wh")
    _one(spark, out, f"select * from {src}.dives", target, "dives")
    for batch, rows in (("b1", 3), ("b1", 3), ("b2", 6), ("b2", 6)):
        load_snapshot(spark, out, mode="append", warehouse=warehouse, batch_id=batch)
        assert spark.table(f"{target}.dives").count() == rows
    spark.sql(f"ALTER TABLE {target}.dives SET TBLPROPERTIES ('tablecrate.batch.b3' = 'started')")
    with pytest.raises(CrateError, match="was interrupted"):
        load_snapshot(spark, out, mode="append", warehouse=warehouse, batch_id="b3")


def test_encrypted_load(spark, src, target, tmp_path):
    out = str(tmp_path / "snap")
    export_snapshot(spark, config(src, target), out, password="right")
    with pytest.raises(CrateError, match="password"):
        load_snapshot(spark, out, warehouse=str(tmp_path / "wh"))
    load_snapshot(spark, out, password="right", warehouse=str(tmp_path / "wh"))
    assert reconcile(spark.table(f"{src}.dives"), spark.table(f"{target}.dives")).count() == 0


def test_version_check(spark, src, target, tmp_path, monkeypatch):
    out = str(tmp_path / "snap")
    for data_format, allowed in (("binary", False), ("csv", True)):
        job = select_objects(f"select * from {src}.reefs", data_format=data_format)
        item = ObjectConfig(job.objects[0].selection, target=(target, "reefs"))
        monkeypatch.setattr("tablecrate.sinks.export.version_number", lambda _: 30_500)
        export_snapshot(spark, JobConfig((item,), job.general), out)
        monkeypatch.undo()
        if allowed:
            load_snapshot(spark, out, warehouse=str(tmp_path / "wh"))
        else:
            with pytest.raises(CrateError, match="major version 3"):
                load_snapshot(spark, out, warehouse=str(tmp_path / "wh"))
            load_snapshot(spark, out, schema_only=True, warehouse=str(tmp_path / "wh"))


def test_failed_swap_restores_the_old_table(spark, src, target, tmp_path, monkeypatch):
    from tablecrate.sinks import load

    out, warehouse = str(tmp_path / "snap"), str(tmp_path / "wh")
    _one(spark, out, f"select * from {src}.reefs", target, "reefs")
    load_snapshot(spark, out, warehouse=warehouse)
    spark.sql(f"INSERT INTO {target}.reefs VALUES (8, 'Kelp', 12)")
    create_table = load._create_table

    def forgetful(session, schema, name, *rest):
        create_table(session, schema, name, *rest)
        session.sql(f"DROP TABLE {schema}.`{name}`")

    # Other columns: a replace with the same ones has no swap.
    _one(spark, out, f"select * except (metres) from {src}.reefs", target, "reefs")
    monkeypatch.setattr(load, "_create_table", forgetful)
    with pytest.raises(Exception):
        load_snapshot(spark, out, warehouse=warehouse)
    assert spark.table(f"{target}.reefs").count() == 4


@pytest.mark.parametrize("columns", ["*", "* except (metres)"])
def test_a_killed_replace_is_finished_or_taken_back(spark, src, target, tmp_path, monkeypatch, columns):
    """Killed before each of its steps in turn: the rows are the old or the new ones, and
    properties are those of the rows again after the next load began."""
    from tablecrate.sinks import load

    class Killed(BaseException):
        pass

    old, new, warehouse = str(tmp_path / "old"), str(tmp_path / "new"), str(tmp_path / "wh")
    _one(spark, old, f"select * from {src}.reefs", target, "reefs")
    _one(spark, new, f"select {columns} from {src}.reefs limit 1", target, "reefs")
    own = f"{target}.reefs__old_notes"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {target} LOCATION '{warehouse}/{target}'")
    spark.sql(f"CREATE TABLE {own} (x INT) USING parquet LOCATION '{tmp_path}/own'")  # only looks like one set aside
    run, outcomes = load._run, []
    while not outcomes or outcomes[-1] != "done":
        load_snapshot(spark, old, warehouse=warehouse, batch_id="first")
        left = [len(outcomes)]

        def dying(session, statement):
            if left[0] == 0:
                raise Killed
            left[0] -= 1
            run(session, statement)

        monkeypatch.setattr(load, "_run", dying)
        try:
            load_snapshot(spark, new, warehouse=warehouse, batch_id="second")
            outcomes.append("done")
        except Killed:
            outcomes.append("killed")
        monkeypatch.setattr(load, "_run", run)
        if columns == "*":
            spark.catalog.refreshTable(f"{target}.reefs")
            assert spark.table(f"{target}.reefs").count() in (1, 3)  # readable at once
        load.recover(spark, target, "reefs")
        table = relations.get(spark, target, "reefs")
        rows = spark.table(f"{target}.reefs").count()
        batch = {3: "first", 1: "second"}[rows]
        assert [k for k in table.properties if k.startswith(load.BATCH_PROPERTY)] == [f"{load.BATCH_PROPERTY}.{batch}"]
        assert load.INTENT_PROPERTY not in table.properties
        names = {row["tableName"] for row in spark.sql(f"SHOW TABLES IN {target}").collect()}
        assert {name for name in names if "__old_" in name} == {"reefs__old_notes"}
    assert len(outcomes) >= 4 and rows == 1


def test_purge_keeps_the_current_version(spark, src, target, tmp_path):
    out, warehouse = str(tmp_path / "snap"), str(tmp_path / "wh")
    _one(spark, out, f"select * from {src}.reefs", target, "reefs")
    for _ in range(3):
        load_snapshot(spark, out, warehouse=warehouse)
    assert len(purge_versions(spark, target, "reefs")) == 2
    spark.catalog.refreshTable(f"{target}.reefs")
    assert spark.table(f"{target}.reefs").count() == 3
    assert purge_versions(spark, target, "reefs") == []


def test_all_modes_are_known(spark, tmp_path):
    with pytest.raises(CrateError, match="mode must be"):
        load_snapshot(spark, str(tmp_path), mode="merge")


def test_manifest_scan_over_many_snapshots(spark, src, tmp_path):
    for name in ("a", "b"):
        _one(spark, str(tmp_path / "snaps" / name), f"select * from {src}.reefs", "x", name)
    rows = manifests.manifest_objects(spark, f"{tmp_path}/snaps/*").orderBy("target").collect()
    assert [(row["target"], row["rows"]) for row in rows] == [("x.a", 3), ("x.b", 3)]


def test_view_keeps_its_namespace_and_settings(spark, schema, tmp_path):
    """Unqualified names, and another time zone; the originals are gone before the load."""
    creator = spark.newSession()
    creator.sql(f"USE {schema}")
    creator.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    creator.sql("CREATE TABLE tides (id INT, at TIMESTAMP) USING parquet")
    creator.sql("INSERT INTO tides VALUES (1, TIMESTAMP'2026-03-01 00:00:00Z')")
    creator.sql("CREATE VIEW by_hour AS SELECT id, hour(at) AS h FROM tides")
    before = spark.table(f"{schema}.by_hour").collect()
    job = loads(f"[[objects]]\nselect = 'select * from {schema}.by_hour'\nexport_as = 'view'")
    export_snapshot(spark, job, str(tmp_path / "snap"))
    spark.sql(f"DROP VIEW {schema}.by_hour")
    spark.sql(f"DROP TABLE {schema}.tides")
    load_snapshot(spark, str(tmp_path / "snap"), warehouse=str(tmp_path / "w"))
    assert spark.table(f"{schema}.by_hour").collect() == before
    assert before[0]["h"] == 9
