from __future__ import annotations

import json
import os
import warnings

import pytest

from fixture_tables import create
from tablecrate import CrateError, describe, loads, render
from tablecrate.__main__ import run
from tablecrate.reports.render import fenced, inline_code
from tablecrate.sources import relations


@pytest.fixture
def src(spark, schema):
    create(spark, schema)
    spark.sql(
        f"CREATE TABLE {schema}.bottles (id INT, dive_id BIGINT, gas STRING) USING parquet"
        f" TBLPROPERTIES ('{relations.LABELS_PROPERTY}' = '{{\"gas\": [\"air\", \"mix`\"]}}')"
    )
    spark.sql(f"INSERT INTO {schema}.bottles SELECT id, 4, 'air' FROM range(9)")
    return schema


def _config(src, *names):
    objects = "".join(f"[[objects]]\nselect = 'select * from {src}.{name}'\n" for name in names)
    return loads(
        objects + f"[[constraints]]\nrelation = '{src}.bottles'\nname = 'z_fk'\nkind = 'foreign_key'\n"
        f"columns = ['dive_id']\nreferences = '{src}.dives'\nreferenced_columns = ['id']\n"
        f"[[constraints]]\nrelation = '{src}.bottles'\nname = 'a_check'\nkind = 'check'\nexpression = 'id >= 0'\n"
        f"[[constraints]]\nrelation = '{src}.bottles'\nname = 'pk'\nkind = 'primary_key'\ncolumns = ['id']\n"
    )


def test_markdown(spark, src):
    text = render(describe(spark, _config(src, "dives", "bottles", "picks")), "markdown")
    assert f"| `{src}.dives` | table | 8 |" in text
    assert f"## `{src}.dives`\n\n````text\nLogged by hand:\n```\nsee the slate\n````" in text
    assert "| `site` | string | default `'unnamed'` |  | `Diver's own name` |" in text
    assert "| `depth` | int | not null, default `5` |" in text
    assert "| `gas` | string |  | `air` `` mix` `` |" in text
    constraints = [line for line in text.splitlines() if line.startswith("- ")]
    assert [line.split()[1] for line in constraints] == ["`pk`", "`z_fk`", "`a_check`"]
    assert "```sql\nSELECT id, upper(title)" in text
    assert "\n> " not in text and not text.endswith("\n\n")
    assert text == render(describe(spark, _config(src, "dives", "bottles", "picks")), "markdown")


def test_warning_and_hidden_comments(spark, src):
    description = describe(spark, _config(src, "bottles"), include_comments=False)
    assert description.warnings == [
        f"Foreign key z_fk on {src}.bottles references {src}.dives, which is not selected"
    ]
    assert "\n> Foreign key z_fk" in render(description, "markdown")
    assert "-- ! Foreign key z_fk" in render(description, "sql")
    quiet = describe(spark, _config(src, "dives"), include_comments=False)
    for output_format in ("markdown", "sql", "json"):
        assert "Diver" not in render(quiet, output_format)


def test_sql(spark, src):
    text = render(describe(spark, _config(src, "dives", "bottles"), statistics=2, source="compute"), "sql")
    assert f"COMMENT ON COLUMN \"{src}\".\"dives\".\"site\" IS 'Diver''s own name';" in text
    assert "-- about 9 rows" in text
    assert (
        "-- gas: one of 'air', 'mix`'; null 0.00%; distinct ~1.00; width 3 bytes; 'air' 100.00%" in text
    )


def test_computed_statistics(spark, src):
    description = describe(spark, _config(src, "bottles", "dives"), statistics=2, source="compute", exact=True)
    tree = json.loads(render(description, "json"))
    bottles, dives = tree["relations"]
    gas = next(c for c in bottles["columns"] if c["name"] == "gas")
    assert gas["statistics"] == {
        "null_fraction": 0.0, "estimated_distinct": 1.0, "average_width_bytes": 3,
        "most_common_values": [{"value": "air", "frequency": 1.0}],
    }
    ids = next(c for c in bottles["columns"] if c["name"] == "id")
    assert [v["value"] for v in ids["statistics"]["most_common_values"]] == ["0", "1"]
    photo = next(c for c in dives["columns"] if c["name"] == "photo")
    assert "most_common_values" not in photo["statistics"]
    assert bottles["row_estimate"] == 9 and bottles["statistics_status"] == "available"


def test_catalog_statistics_touch_no_rows(spark, src):
    config = _config(src, "bottles", "picks")
    before = describe(spark, config, statistics="basic")
    assert [item.statistics_status for item in before.relations] == ["unavailable", "unavailable"]
    assert "No statistics" in render(before, "markdown")
    spark.sql(f"ANALYZE TABLE {src}.bottles COMPUTE STATISTICS FOR ALL COLUMNS")
    bottles, view = describe(spark, config, statistics="basic").relations
    assert bottles.statistics["gas"].estimated_distinct == 1.0
    assert bottles.row_estimate == 9 and bottles.statistics["gas"].most_common_values == []
    assert view.statistics_status == "unavailable"
    assert "statistics" not in render(describe(spark, config), "json")


def test_bad_requests(spark, src):
    config = _config(src, "bottles")
    for statistics in (0, -1, "many", True):
        with pytest.raises(CrateError):
            describe(spark, config, statistics=statistics)
    with pytest.raises(CrateError):
        render(describe(spark, config), "html")
    with pytest.raises(CrateError, match="does not exist"):
        describe(spark, _config(src, "nowhere"))


def test_fences():
    assert inline_code("a") == "`a`"
    assert inline_code("a`b") == "``a`b``"
    assert inline_code("`a``") == "``` `a`` ```"
    assert fenced("x ```` y", "sql") == "`````sql\nx ```` y\n`````"


def test_command_line(base_spark, spark, src, tmp_path, monkeypatch):
    monkeypatch.delenv("PASSWORD", raising=False)
    file, out = tmp_path / "job.toml", tmp_path / "snap"
    file.write_text(
        f"[[objects]]\nselect = 'select * from {src}.dives order by id'\ntarget_schema = '{src}'\n"
        "target_name = 'dives_copy'\n"
    )
    common = ["--config", str(file)]
    plan = run(["--dry-run", "export", *common, "--out", str(out)], base_spark)
    assert json.loads(plan)["target_name"] == "dives_copy" and not out.exists()
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        said = run(["export", *common, "--out", str(out), "--attempts", "1", "--password", "p"], base_spark)
    assert said.startswith("exported 1 objects, 3 rows")
    with pytest.raises(CrateError):
        run(["info", "--in", str(out)], base_spark)
    with pytest.raises(CrateError, match="empty"):
        run(["info", "--in", str(out), "--password", ""], base_spark)
    monkeypatch.setenv("PASSWORD", "p")
    assert "dives_copy" in run(["info", "--in", str(out), "--objects"], base_spark)
    assert "dives_copy" in run(["--dry-run", "import", "--in", str(out)], base_spark)
    assert not spark.catalog.tableExists(f"{src}.dives_copy")
    assert json.loads(run(["import", "--in", str(out)], base_spark))["rows"] == 3
    assert spark.table(f"{src}.dives_copy").count() == 3
    report = tmp_path / "deep" / "schema.json"
    assert run(["describe", *common, "--format", "json", "--out", str(report)], base_spark) == ""
    assert json.loads(report.read_text())["relations"][0]["name"] == "dives"
    assert os.listdir(report.parent) == ["schema.json"]
    assert run(["--dry-run", "describe", *common], base_spark) == f"{src}.dives\n"
    with pytest.raises(CrateError):
        run(["describe", *common, "--statistics=0"], base_spark)
