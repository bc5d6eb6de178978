from __future__ import annotations

import json
from dataclasses import asdict, replace

import pytest

from tablecrate import CrateError
from tablecrate.sources.manifests import Inputs, Manifest, ManifestObject, ObjectColumn, Place, ViewDefinition, parse

TIDES = ManifestObject(
    source=Place("coast", "tides"), target=Place("archive", "tides"), kind="table",
    select="select * except (raw) from coast.tides order by at", ddl="r/ddl/1.sql", payload="r/data/1", rows=3,
    columns=[ObjectColumn("at", "timestamp", required=True, key=True), ObjectColumn("m", "double", labels=["x"])],
)
DAILY = replace(TIDES, target=Place("archive", "daily"), kind="view", rows=None, view=ViewDefinition("SELECT 1", "c.s"))
WHOLE = Manifest("2026-03-04T00:00:00+00:00", 40102, "user=me", "csv", True, [TIDES, DAILY], Inputs(2, 90, "-7"))


def text(manifest: Manifest = WHOLE, **changes) -> str:
    return json.dumps(asdict(manifest) | changes)


def test_reads_what_it_wrote():
    assert parse(text(), "m") == WHOLE
    assert [(o.export_as, o.has_data, o.keys, o.required) for o in WHOLE.objects] == [
        ("table", True, ["at"], ["at"]), ("view", False, ["at"], ["at"]),
    ]
    assert TIDES.selection.order_by == "at" and TIDES.column_names == ["at", "m"]


def test_later_additions_are_passed_over():
    raw = json.loads(text()) | {"later": 1}
    raw["objects"][0] |= {"another": [2]}
    raw["objects"][0]["columns"][0] |= {"third": None}
    assert parse(json.dumps(raw), "m") == WHOLE


@pytest.mark.parametrize("broken", ["{", "[]", "{}", '{"layout": 3}', text(objects=[{"kind": "table"}]), text(objects=3)])
def test_not_a_manifest(broken):
    with pytest.raises(CrateError, match="m is not a manifest"):
        parse(broken, "m")


def test_another_layout():
    with pytest.raises(CrateError, match="has layout 2; this version reads layout 3"):
        parse(text(layout=2), "m")


def test_all_that_is_unsound_is_named():
    nameless = replace(TIDES, target=Place("a", "b"), columns=[])
    twice = replace(TIDES, target=Place("a", "c"), columns=TIDES.columns * 2)
    with pytest.raises(CrateError) as refused:
        parse(text(replace(WHOLE, payload_format="tar", objects=[TIDES, TIDES, nameless, twice])), "m")
    for part in ("payload is 'tar'", "several objects go to archive.tides", "a.b has no columns", "a.c has no columns"):
        assert part in str(refused.value)
    with pytest.raises(CrateError, match="lists nothing"):
        parse(text(replace(WHOLE, objects=[])), "m")
