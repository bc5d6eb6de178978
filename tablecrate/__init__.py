"""Table snapshots, loads and profiles as Spark jobs."""

from tablecrate.config import JobConfig, load, loads, select_objects
from tablecrate.errors import CrateError
from tablecrate.operators.selection import Selection, parse
from tablecrate.reports.describe import describe
from tablecrate.reports.render import render
from tablecrate.session import job_session
from tablecrate.sinks.export import export_snapshot
from tablecrate.sinks.load import load_snapshot, read_object
from tablecrate.sources.manifests import manifest_objects, open_snapshot

__all__ = [
    "CrateError",
    "JobConfig",
    "Selection",
    "describe",
    "export_snapshot",
    "job_session",
    "load",
    "load_snapshot",
    "loads",
    "manifest_objects",
    "open_snapshot",
    "parse",
    "read_object",
    "render",
    "select_objects",
]
