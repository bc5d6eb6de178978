from __future__ import annotations

import pytest

from tablecrate import CrateError, loads
from tablecrate.config import Constraint

OBJECT = "[[objects]]\nselect = 'select * from public.orders'\n"


def test_defaults():
    config = loads(OBJECT)
    general = config.general
    assert (general.data_format, general.consistent_snapshot) == ("binary", True)
    assert (general.attempts, general.retry_delay_ms, general.attempt_timeout_ms) == (3, 1000, 0)
    assert general.workers({}) == 1
    assert config.objects[0].export_as == "table"
    assert config.connection is None


def test_worker_precedence():
    environment = {"TABLECRATE_CONCURRENCY": "5"}
    assert loads(OBJECT).general.workers(environment) == 5
    from_config = loads("[general]\nconcurrency = 2\n" + OBJECT).general
    assert from_config.workers(environment) == 2
    assert from_config.override(concurrency=7).workers(environment) == 7
    assert from_config.override(concurrency=None).workers(environment) == 2
    with pytest.raises(CrateError):
        loads(OBJECT).general.workers({"TABLECRATE_CONCURRENCY": "many"})


@pytest.mark.parametrize(
    "general",
    [
        "compression = 'gzip'", "data_format = 'json'", "attempts = 0", "attempts = -1",
        "retry_delay_ms = -1", "attempt_timeout_ms = -5", "concurrency = 0",
        "consistent_snapshot = 'yes'",
    ],
)
def test_bad_general(general):
    with pytest.raises(CrateError):
        loads(f"[general]\n{general}\n{OBJECT}")


@pytest.mark.parametrize(
    "body",
    [
        "", "[general]\n", "not toml", "[[objects]]\nselect = ' '",
        "[[objects]]\nselect = 'select * from orders'",
        OBJECT + "target_schema = 'a'", OBJECT + "target_name = 'a'",
        OBJECT + "target_schema = 'a'\ntarget_name = 'b-c'",
        OBJECT + "target_schema = ''\ntarget_name = 'b'",
        OBJECT + "export_as = 'index'",
        "[[objects]]\nselect = 'select id from a.v'\nexport_as = 'view'",
        "[[objects]]\nselect = 'select * from a.v limit 1'\nexport_as = 'view'",
    ],
)
def test_bad_objects(body):
    with pytest.raises(CrateError):
        loads(body)


def test_target_keeps_case_and_sources_are_unique():
    config = loads(OBJECT + "target_schema = 'Arc'\ntarget_name = '1_x'\n" + OBJECT)
    assert config.objects[0].target == ("Arc", "1_x")
    assert config.unique_sources() == [("public", "orders")]


def test_connection():
    environment = {"H": "db.example.com", "PGUSER": "reader"}
    raw = "[connection]\nhost = '{H}'\nport = 6543\ndbname = 'sales'\npassword = '{NONE}'\n"
    connection = loads(raw + OBJECT, environment).connection
    assert connection.options(environment) == {
        "url": "jdbc:postgresql://db.example.com:6543/sales", "user": "reader",
    }
    assert loads("[connection]\nhost = '{NONE}'\n" + OBJECT, {}).connection is None
    for bad in ("host = '{H'", "port = 0", "port = 'x'", "port = 70000"):
        with pytest.raises(CrateError):
            loads(f"[connection]\n{bad}\n{OBJECT}", environment)


def test_constraints():
    raw = OBJECT + (
        "[[constraints]]\nrelation = 'a.child'\nname = 'fk'\nkind = 'foreign_key'\n"
        "columns = ['x']\nreferences = 'a.parent'\nreferenced_columns = ['y']\n"
        "[[constraints]]\nrelation = 'a.child'\nname = 'ck'\nkind = 'check'\nexpression = 'x > 0'\n"
    )
    foreign, check = loads(raw).constraints
    assert foreign == Constraint(("a", "child"), "fk", "foreign_key", ("x",), ("a", "parent"), ("y",))
    assert foreign.definition == "FOREIGN KEY (x) REFERENCES a.parent(y)"
    assert check.definition == "CHECK (x > 0)"
    for bad in ("kind = 'index'", "kind = 'unique'", "kind = 'foreign_key'\ncolumns = ['x']", "kind = 'check'"):
        with pytest.raises(CrateError):
            loads(OBJECT + f"[[constraints]]\nrelation = 'a.b'\nname = 'n'\n{bad}\n")
