"""Session settings the selection text relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from tablecrate.errors import CrateError
from tablecrate.sources.files import MetadataFiles

# Fixed values. In selection text "name" is an identifier, not a string. The redaction
# pattern keeps 256-bit keys out of EXPLAIN output.
JOB_CONF = {
    "spark.sql.parser.escapedStringLiterals": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.redaction.string.regex": "(?i)(0x|X')[0-9a-f]{64}'?",
    # INT96 would lose the time-zone-less meaning of timestamps.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


# Compressed source bytes per shuffle partition: a few times as much in memory, and sorts
# spill. The ceiling keeps the number of shuffle blocks in hand.
BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024
MOST_SHUFFLE_PARTITIONS = 50_000
LEAST_PART_ROWS = 1 << 17  # fewer are not worth a task

_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def job_session(spark: SparkSession, *, case_sensitive: bool = False) -> SparkSession:
    """A sibling session with the settings of `spark` plus `JOB_CONF`.

    The caller's own session is left alone. The sibling shares its SparkContext and
    catalog, but not its temporary views.
    """
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and child.conf.isModifiable(key):
            child.conf.set(key, value)
    for key, value in JOB_CONF.items():
        child.conf.set(key, value)
    if case_sensitive:
        child.conf.set("spark.sql.caseSensitive", "true")
    return child


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder that every executor can reach."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise CrateError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.gettempdir()
    path = f"{root.rstrip('/')}/tablecrate/{label}-{uuid.uuid4().hex}"
    made = _SCOPE.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders made inside, for work that is finished when it ends."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in made:
            MetadataFiles(spark).delete_tree(path)


def row_parts(spark: SparkSession, rows: int, most: int) -> int:
    """Tasks for a shuffle of so many rows, of which one task shall get `most`: the session's
    partitions or more, but fewer where rows are few."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // most), min(usual, rows // LEAST_PART_ROWS))


@contextmanager
def sized_shuffles(spark: SparkSession, source_bytes: int) -> Iterator[None]:
    """Enough shuffle partitions for this much input. Adaptive execution joins partitions
    that turn out small, but it cannot split those of a sort or an aggregate."""
    key = "spark.sql.shuffle.partitions"
    usual = int(spark.conf.get(key))
    wanted = min(-(-source_bytes // BYTES_PER_SHUFFLE_PARTITION), MOST_SHUFFLE_PARTITIONS)
    spark.conf.set(key, str(max(usual, wanted)))
    try:
        yield
    finally:
        spark.conf.set(key, str(usual))
