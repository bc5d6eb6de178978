from __future__ import annotations

import json
import os
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path

import pytest

from fixture_tables import DIVES, config, create
from tablecrate import CrateError, export_snapshot, load_snapshot, manifest_objects, open_snapshot, read_object
from tablecrate.__main__ import run
from tablecrate.config import General, JobConfig, ObjectConfig, select_objects
from tablecrate.operators.reconcile import reconcile
from tablecrate.operators.selection import parse
from tablecrate.reports.info import render_info
from tablecrate.session import sized_shuffles
from tablecrate.plans.pins import changed_inputs
from tablecrate.sinks.export import pinned_inputs, purge_runs
from tablecrate.sinks.load import find_object, read_ddl
from tablecrate.sources import ledger, manifests

TYPES = """
    k int, s string, b binary, y byte, h short, l long, f float, d double, m decimal(38,10),
    o boolean, dt date, ntz timestamp_ntz, ts timestamp, a array<string>,
    st struct<x: int, y: array<double>>, mp map<string, int>, iv interval day to second
"""
UTC = timezone.utc
ROWS = [
    (
        1, 'quote " comma , tab\t back\\slash \\n end\\', bytearray(range(200)), 1, 2, 2**62, 0.1, 1e-300,
        Decimal("1234567890123456789012345678.0123456789"), True, date(1, 1, 1),
        datetime(2026, 1, 2, 3, 4, 5, 678901), datetime(2026, 7, 2, 3, 4, 5, 678901, UTC),
        ["a", None, ""], (1, [0.1, None]), {"k": 1, "": None}, timedelta(days=1, microseconds=5),
    ),
    (2, "", bytearray(), -1, -2, -5, float("inf"), float("nan"), Decimal("-0.0000000001"), False,
     date(9999, 12, 31), datetime(1900, 1, 1), datetime(1969, 12, 31, tzinfo=UTC), [], (None, []), {},
     timedelta(0)),
    (3, "\\\\N", None, *[None] * 14),
    (4, "=", None, *[None] * 14),
    (5, " padded ", None, *[None] * 14),
    (6, "line\nbreak\r\nand\rreturn", None, *[None] * 14),
    (7, None, None, *[None] * 14),
    (8, "\\b\\n\\r", None, *[None] * 14),
    (9, "#comment", None, *[None] * 14),
    (10, '"', None, *[None] * 14),
    (11, "строка 漢字 🙂 \x00\x01", None, *[None] * 14),
    (12, "x" * 100_000, None, *[None] * 14),
]


@pytest.fixture
def typed(spark, schema):
    spark.createDataFrame(ROWS, TYPES).write.saveAsTable(f"{schema}.typed")
    return schema


@pytest.mark.parametrize("data_format", ["binary", "csv"])
@pytest.mark.parametrize("password", [None, "a passphrase"])
def test_every_type_survives(spark, typed, tmp_path, data_format, password):
    out = str(tmp_path / "snap")
    job = select_objects(f"select * from {typed}.typed", data_format=data_format)
    manifest = export_snapshot(spark, job, out, password=password)
    assert manifest.objects[0].rows == len(ROWS)
    snapshot = open_snapshot(spark, out, password)
    back = read_object(spark, snapshot, snapshot.manifest.objects[0])
    source = spark.table(f"{typed}.typed")
    assert [f.dataType.simpleString() for f in back.schema] == [
        f.dataType.simpleString() for f in source.schema
    ]
    assert reconcile(source, back).collect() == []


def test_manifest_facts(spark, schema, tmp_path):
    create(spark, schema)
    out = str(tmp_path / "snap")
    export_snapshot(spark, config(schema, "dst"), out)
    manifest = open_snapshot(spark, out).manifest
    by_name = {item.target.name: item for item in manifest.objects}
    assert [item.rows for item in manifest.objects] == [3, 1, 3, 0]
    assert by_name["plain"].column_names == ["id", "tag", "site", "depth", "cost", "started"]
    assert by_name["deepest"].selection.canonical_sql(["id", "site"]) == (
        f'SELECT "id", "site" FROM "{schema}"."dives" WHERE depth >= 10 ORDER BY depth desc LIMIT 1'
    )
    assert by_name["dives"].columns[5].type == "decimal(8,3)"
    assert by_name["dives"].required == ["id", "tag", "depth"]
    assert by_name["dives"].keys == ["id", "tag"]
    assert by_name["deepest"].keys == ["id"]
    assert by_name["dives"].payload.endswith(f"data/0001__{schema}.dives")
    assert manifest.consistent and manifest.inputs.files > 0
    rows = manifest_objects(spark, out).orderBy("position").collect()
    assert [(row["target"], row["rows"]) for row in rows] == [
        ("dst.dives", 3), ("dst.deepest", 1), ("dst.plain", 3), ("dst.spares", 0),
    ]


def test_workers_do_not_change_the_result(spark, schema, tmp_path):
    create(spark, schema)
    found = []
    for workers in (1, 3):
        out = str(tmp_path / f"snap{workers}")
        manifest = export_snapshot(spark, config(schema, "dst", concurrency=workers), out)
        found.append([(o.target, o.rows, o.checksum, o.select) for o in manifest.objects])
    assert found[0] == found[1]


def test_payload_keeps_the_order(spark, schema, tmp_path):
    spark.range(0, 5_000, 1, 4).selectExpr("id", "id % 10 AS k").write.saveAsTable(f"{schema}.t")
    out = str(tmp_path / "snap")
    job = select_objects(f"select * from {schema}.t order by k desc, id")
    export_snapshot(spark, job, out)
    snapshot = open_snapshot(spark, out)
    item = snapshot.manifest.objects[0]
    assert item.selection.order_by == "k desc, id"
    expected = sorted(range(5_000), key=lambda i: (-(i % 10), i))
    files = sorted(Path(f"{out}/{item.payload}").glob("part-*"))
    in_files = [row["id"] for f in files for row in spark.read.parquet(str(f)).collect()]
    assert in_files == expected
    ordered = read_object(spark, snapshot, item, ordered=True)
    assert [row["id"] for row in ordered.collect()] == expected


def test_encryption(spark, schema, tmp_path):
    create(spark, schema)
    out = str(tmp_path / "snap")
    export_snapshot(spark, config(schema, "dst"), out, password="right")
    assert manifests.is_encrypted(spark, out)
    text = Path(out, "manifest.json").read_text()
    assert "dives" not in text and "select" not in text
    with pytest.raises(CrateError, match="a password is needed"):
        open_snapshot(spark, out)
    with pytest.raises(CrateError, match="wrong password"):
        open_snapshot(spark, out, "wrong")
    snapshot = open_snapshot(spark, out, "right")
    item = find_object(snapshot, "dives")
    assert "CREATE TABLE" in read_ddl(spark, snapshot, item)
    assert "CREATE TABLE" not in Path(out, item.ddl).read_text()
    assert spark.read.parquet(f"{out}/{item.payload}").columns == ["sealed"]
    assert json.loads(render_info(snapshot, "json"))["payload"]["sealed"] is True


def test_key_is_not_in_plans(spark, schema, tmp_path):
    from tablecrate.functions import seal

    create(spark, schema)
    key = bytes(range(32))
    dives = spark.table(f"{schema}.dives")
    plan = dives.select(seal.seal_row(dives, key))._jdf.queryExecution().toString()
    assert key.hex().upper() not in plan.upper()


def test_info(spark, schema, tmp_path):
    create(spark, schema)
    out = str(tmp_path / "snap")
    export_snapshot(spark, config(schema, "dst", data_format="csv"), out)
    snapshot = open_snapshot(spark, out)
    text = render_info(snapshot, "text", objects=True)
    assert text.startswith(f"{out}: 4 objects, ") and "\ncsv, layout " in text
    line = next(line for line in text.splitlines() if line.startswith("dst.deepest"))
    assert line.split()[:4] == ["dst.deepest", f"{schema}.dives", "table", "2"]
    assert "dst.deepest" not in render_info(snapshot, "text")
    parsed = json.loads(render_info(snapshot, "json", objects=True))
    assert len(parsed["objects"]) == 4
    assert "objects" not in json.loads(render_info(snapshot, "json"))


def test_failed_export_leaves_the_former_snapshot(spark, schema, tmp_path):
    create(spark, schema)
    out = str(tmp_path / "snap")
    export_snapshot(spark, config(schema, "dst"), out)
    before = Path(out, "manifest.json").read_text()
    bad = select_objects(
        f"select * from {schema}.dives", f"select * from {schema}.reefs where id / (id - 1) > 0", attempts=1
    )
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        export_snapshot(spark, bad, out)
    assert Path(out, "manifest.json").read_text() == before
    assert len([p for p in Path(out).iterdir() if p.is_dir()]) == 1
    assert read_object(spark, open_snapshot(spark, out), open_snapshot(spark, out).manifest.objects[0]).count() == 3


def test_purge_keeps_the_published_run(spark, schema, tmp_path):
    create(spark, schema)
    out = str(tmp_path / "snap")
    for password in (None, "p", "p"):
        export_snapshot(spark, config(schema, "dst"), out, password=password)
    assert len(purge_runs(spark, out)) == 2
    snapshot = open_snapshot(spark, out, "p")
    assert read_object(spark, snapshot, snapshot.manifest.objects[0]).count() == 3
    assert purge_runs(spark, out) == []


def test_large_limits_leave_no_scratch(spark, schema, tmp_path):
    spark.range(0, 60_000, 1, 4).write.saveAsTable(f"{schema}.t")
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT id, id % 7 AS k FROM {schema}.t")
    scratch = Path(spark.conf.get("spark.checkpoint.dir", "/tmp"), "tablecrate")

    def numbered():
        return {p.name for p in scratch.glob("numbered-*")}

    before = numbered()
    job = select_objects(
        f"select * from {schema}.t limit 20000", f"select * from {schema}.v order by k, id limit 30000"
    )
    manifest = export_snapshot(spark, job, str(tmp_path / "snap"))
    assert [item.rows for item in manifest.objects] == [20_000, 30_000]
    assert numbered() <= before


def test_shuffles_grow_with_the_input(spark):
    key = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(key)
    with sized_shuffles(spark, 100 * 2**30):
        assert spark.conf.get(key) == "400"
    with sized_shuffles(spark, 0):
        assert spark.conf.get(key) == usual
    assert spark.conf.get(key) == usual


def test_unfinished_folder_is_not_a_snapshot(spark, tmp_path):
    with pytest.raises(CrateError, match="no manifest"):
        open_snapshot(spark, str(tmp_path / "nothing"))


def test_changed_source_is_noticed(spark, schema, tmp_path, monkeypatch):
    from tablecrate.sinks import export

    spark.range(10).write.parquet(str(tmp_path / "files"))
    spark.sql(f"CREATE TABLE {schema}.t USING parquet LOCATION '{tmp_path}/files'")
    write = export.payload.write

    def touching_write(*arguments):
        write(*arguments)
        for file in (tmp_path / "files").glob("part-*"):
            os.utime(file, (1, 1))

    monkeypatch.setattr(export.payload, "write", touching_write)
    job = select_objects(f"select * from {schema}.t")
    with pytest.raises(CrateError, match="changed during the export"):
        export_snapshot(spark, job, str(tmp_path / "snap"))
    assert not (tmp_path / "snap" / "manifest.json").exists()
    loose = select_objects(f"select * from {schema}.t", consistent_snapshot=False)
    assert not export_snapshot(spark, loose, str(tmp_path / "snap")).consistent


def test_files_added_later_are_not_read(spark, schema, tmp_path, monkeypatch):
    from tablecrate.sinks import export

    spark.range(10).write.parquet(str(tmp_path / "files"))
    spark.sql(f"CREATE TABLE {schema}.t USING parquet LOCATION '{tmp_path}/files'")
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT * FROM {schema}.t")
    write = export.payload.write

    def adding_write(*arguments):
        spark.range(5).write.mode("append").parquet(str(tmp_path / "files"))
        write(*arguments)

    monkeypatch.setattr(export.payload, "write", adding_write)
    job = select_objects(f"select * from {schema}.t", f"select * from {schema}.v")
    manifest = export_snapshot(spark, job, str(tmp_path / "snap"))
    assert [item.rows for item in manifest.objects] == [10, 10]


def test_attempts(spark, schema, tmp_path, monkeypatch):
    from tablecrate.sinks import export

    create(spark, schema)
    write, calls = export.payload.write, []

    def flaky_write(*arguments):
        calls.append(arguments[1])
        if len(calls) < 3:
            raise OSError("no space")
        write(*arguments)

    monkeypatch.setattr(export.payload, "write", flaky_write)
    job = JobConfig(
        (ObjectConfig(parse(f"select * from {schema}.dives")),), General(attempts=3, retry_delay_ms=0)
    )
    with pytest.warns(UserWarning, match="attempt 2 failed: no space"):
        manifest = export_snapshot(spark, job, str(tmp_path / "snap"))
    assert len(set(calls)) == 3 and manifest.objects[0].payload in calls[2]
    calls.clear()
    single = JobConfig(job.objects, General(attempts=1))
    with pytest.raises(OSError, match="no space"):
        export_snapshot(spark, single, str(tmp_path / "snap2"))


def test_attempt_timeout(spark, schema, tmp_path):
    spark.range(0, 4).selectExpr("id").write.saveAsTable(f"{schema}.t")
    slow = f"select id from {schema}.t where (select count(*) from range(0, 100000000000, 1, 4)) > id"
    job = select_objects(slow, attempts=1, attempt_timeout_ms=1500)
    with pytest.raises(Exception, match="(?i)cancel"):
        export_snapshot(spark, job, str(tmp_path / "snap"))


def test_rows_are_the_fixture(spark, schema):
    create(spark, schema)
    rows = [tuple(row) for row in spark.table(f"{schema}.dives").orderBy("id").collect()]
    assert rows == sorted(DIVES)


def test_pinned_paths_are_taken_literally(spark, schema, tmp_path):
    values = ["a b", "50%", "[x]", "é*", "{1,2}", "q?"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, part string")
    place = str(tmp_path / "parted")
    rows.write.partitionBy("part").parquet(place)
    spark.sql(f"CREATE TABLE {schema}.parted USING parquet LOCATION '{place}'")
    spark.sql(f"MSCK REPAIR TABLE {schema}.parted")
    out = str(tmp_path / "snap")
    manifest = export_snapshot(spark, select_objects(f"select * from {schema}.parted"), out)
    assert manifest.consistent and manifest.inputs.files == len(values)
    assert manifest.objects[0].rows == len(values)


def test_sources_without_files_are_not_called_consistent(spark, schema, tmp_path):
    spark.sql(f"CREATE VIEW {schema}.dice AS SELECT rand() AS r")
    manifest = export_snapshot(spark, select_objects(f"select * from {schema}.dice"), str(tmp_path / "s"))
    assert not manifest.consistent


@pytest.mark.parametrize("data_format", ["binary", "csv"])
@pytest.mark.parametrize("password", [None, "a passphrase"])
def test_damaged_files_are_named(spark, schema, tmp_path, data_format, password):
    spark.range(0, 3_000, 1, 5).selectExpr("id", "id * 7 AS v").write.saveAsTable(f"{schema}.t")
    out = str(tmp_path / "snap")
    job = select_objects(f"select * from {schema}.t", data_format=data_format, file_ledger=True)
    export_snapshot(spark, job, out, password=password)
    snapshot = open_snapshot(spark, out, password)
    total = {row["folder"]: row for row in ledger.fold(ledger.read(spark, snapshot)).collect()}
    assert total[""]["rows"] == 3_000 and total[""]["files"] >= 3
    assert total[""]["checksum"] == total[f"{schema}.t"]["checksum"]
    assert ledger.damaged_files(spark, snapshot).count() == 0

    folder = Path(out, snapshot.manifest.objects[0].payload)
    for checksum in folder.glob(".*.crc"):  # another reader's check would speak first
        checksum.unlink()
    cut, gone, twin, *_ = sorted(p for p in folder.iterdir() if p.name.startswith("part-"))
    cut.write_bytes(cut.read_bytes()[:-40])
    (folder / f"zz-{twin.name}").write_bytes(twin.read_bytes())
    gone.unlink()
    found = {row["file"]: row for row in ledger.damaged_files(spark, snapshot).collect()}
    assert {name: row["status"] for name, row in found.items() if name != cut.name} == {
        gone.name: "missing", f"zz-{twin.name}": "unlisted"
    }
    assert found[cut.name]["status"] in ("unreadable", "changed")
    assert found[cut.name]["bytes_before"] - found[cut.name]["bytes_after"] == 40
    said = run(["verify", "--in", out, *(["--password", password] if password else [])], spark)
    assert [json.loads(line)["file"] for line in said.splitlines()] == sorted(found)


def test_a_load_names_the_damaged_file(spark, schema, tmp_path):
    spark.range(0, 100, 1, 2).write.saveAsTable(f"{schema}.t")
    out = str(tmp_path / "snap")
    export_snapshot(spark, select_objects(f"select * from {schema}.t", file_ledger=True), out)
    snapshot = open_snapshot(spark, out)
    gone = min(Path(out, snapshot.manifest.objects[0].payload).glob("part-*"))
    gone.unlink()
    with pytest.raises(CrateError, match=f"row count is [0-9]+.*{gone.name} is missing"):
        load_snapshot(spark, out, warehouse=str(tmp_path / "warehouse"))
    assert spark.table(f"{schema}.t").count() == 100
    plain = str(tmp_path / "plain")
    export_snapshot(spark, select_objects(f"select * from {schema}.t"), plain)
    with pytest.raises(CrateError, match="no file ledger"):
        ledger.damaged_files(spark, open_snapshot(spark, plain))


@pytest.mark.parametrize("password", [None, "a passphrase"])
def test_pinned_inputs_are_kept(spark, schema, tmp_path, password):
    spark.range(0, 100, 1, 3).write.saveAsTable(f"{schema}.t")
    out = str(tmp_path / "snap")
    export_snapshot(spark, select_objects(f"select * from {schema}.t"), out, password=password)
    pinned = pinned_inputs(spark, open_snapshot(spark, out, password))
    assert changed_inputs(spark, pinned).count() == 0
    files = sorted(Path(row["path"].removeprefix("file:")) for row in pinned.collect())
    assert len(files) == 3 and sum(row["bytes"] for row in pinned.collect()) == sum(f.stat().st_size for f in files)
    files[0].unlink()
    os.utime(files[1], (1, 1))
    assert {Path(row["path"]).name: row["status"] for row in changed_inputs(spark, pinned).collect()} == {
        files[0].name: "missing", files[1].name: "changed"
    }
    unpinned = str(tmp_path / "unpinned")
    job = select_objects(f"select * from {schema}.t", consistent_snapshot=False)
    spark.sql(f"REFRESH TABLE {schema}.t")
    export_snapshot(spark, job, unpinned)
    with pytest.raises(CrateError, match="without pinned inputs"):
        pinned_inputs(spark, open_snapshot(spark, unpinned))
