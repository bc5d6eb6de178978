"""The JDBC reader's options. No database is started: a recording session stands in."""

from __future__ import annotations

from types import SimpleNamespace

from tablecrate.sources.jdbc import Connection, KeyRange, read_relation


class Recorder:
    def __init__(self, bounds=None):
        self.seen, self.bounds, self.loads = {}, bounds, []

    @property
    def read(self):
        self.seen = {}
        return self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **values):
        self.seen |= values
        return self

    def option(self, name, value):
        self.seen[name] = value
        return self

    def load(self):
        self.loads.append(dict(self.seen))
        return SimpleNamespace(first=lambda: self.bounds)


OPTIONS = Connection(dbname="sales").options({"PGHOST": "h", "PGUSER": "u", "PGPASSWORD": "p"})


def test_connection_defaults():
    assert OPTIONS == {"url": "jdbc:postgresql://h:5432/sales", "user": "u", "password": "p"}
    assert Connection(user="me").options({})["url"] == "jdbc:postgresql://localhost:5432/me"
    assert Connection(url="jdbc:x:y").options({}) == {"url": "jdbc:x:y"}


def test_one_statement_without_a_range():
    session = Recorder()
    read_relation(session, OPTIONS, "s", 'Odd"Name')
    assert session.loads[-1]["dbtable"] == '"s"."Odd""Name"'
    assert "partitionColumn" not in session.loads[-1]


def test_ranges_ask_for_missing_bounds():
    session = Recorder(bounds=(1, 90))
    read_relation(session, OPTIONS, "s", "t", KeyRange("id", 8))
    assert session.loads[0]["query"] == 'SELECT MIN("id") AS low, MAX("id") AS high FROM "s"."t"'
    last = session.loads[-1]
    assert (last["partitionColumn"], last["lowerBound"], last["upperBound"]) == ('"id"', "1", "90")
    assert last["numPartitions"] == 8
    given = Recorder()
    read_relation(given, OPTIONS, "s", "t", KeyRange("id", 8, "5", "6"))
    assert len(given.loads) == 1 and given.loads[0]["lowerBound"] == "5"


def test_empty_relation_needs_no_ranges():
    session = Recorder(bounds=(None, None))
    read_relation(session, OPTIONS, "s", "t", KeyRange("id", 8))
    assert "partitionColumn" not in session.loads[-1]
