"""Consistent input: prove that no source file changed while many objects were read.

A DataFrame keeps the file list it was analyzed with, so analyzing all objects before
the first write pins what they read. One row a pinned file (path, bytes, time) is written as
a table; at the end executors compare it with a new listing of the same folders.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.errors import CrateError
from tablecrate.functions.digest import row_hash_sum
from tablecrate.sources.payload import read as read_rows
from tablecrate.sources.payload import write as write_rows

_MOST_NAMED = 5
_GLOB_SIGNS = re.compile(r"([*?\[\]{}\\])")
_FOLDER = r"/[^/]*$"
SCHEMA = (
    T.StructType()
    .add("path", T.StringType())
    .add("bytes", T.LongType())
    .add("modified", T.TimestampType())
)


@dataclass(frozen=True)
class Pin:
    files: int
    bytes: int
    fingerprint: str
    table: str  # folder of the pinned files' rows


def literal_path(path: str) -> str:
    """A path that Spark takes as it is, without globbing."""
    return _GLOB_SIGNS.sub(r"\\\1", path)


def plain_path(uri: str) -> str:
    """A path to load from the URI of an input file: decoded, and taken literally."""
    return literal_path(unquote(uri))


def _listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Sizes and times are listed by Spark and no file is opened: the content column is
    pruned away. Folders named `x=y` stay plain folders."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def pin(spark: SparkSession, sources: Iterable[DataFrame], table: str, key: bytes | None = None) -> Pin:
    """Write down (path, size, modification time) of all source files, once each.

    The paths come from the file index the driver has anyway, and pass it here only.
    """
    paths = sorted({plain_path(uri) for df in sources for uri in df.inputFiles()})
    listing = _listing(spark, paths) if paths else spark.createDataFrame([], SCHEMA)
    write_rows(listing, table, "binary", key)
    pinned = read_pins(spark, table, key)
    found = pinned.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        row_hash_sum(pinned).cast("string").alias("fingerprint"),
    ).first()
    return Pin(found["files"], found["bytes"], found["fingerprint"], table)


def read_pins(spark: SparkSession, table: str, key: bytes | None = None) -> DataFrame:
    """path, bytes, modified: the source files a snapshot was read from."""
    return read_rows(spark, table, SCHEMA, "binary", key)


def changed_inputs(spark: SparkSession, pinned: DataFrame) -> DataFrame:
    """path, status ("missing" or "changed") of pinned files that are not as they were.
    Only folder names come to the driver."""
    folders = pinned.select(F.regexp_replace("path", _FOLDER, "").alias("folder")).distinct().collect()
    if not folders:
        return spark.createDataFrame([], "path string, status string")
    now = _listing(spark, sorted(literal_path(row["folder"]) for row in folders)).distinct()
    joined = pinned.alias("p").join(now.alias("n"), "path", "left")
    same = F.col("p.bytes").eqNullSafe(F.col("n.bytes")) & F.col("p.modified").eqNullSafe(F.col("n.modified"))
    status = F.when(F.col("n.bytes").isNull(), "missing").otherwise("changed")
    return joined.where(~same).select("path", status.alias("status"))


def require_unchanged(spark: SparkSession, before: Pin, key: bytes | None = None) -> None:
    try:
        found = changed_inputs(spark, read_pins(spark, before.table, key)).limit(_MOST_NAMED).collect()
    except PySparkException as error:
        raise CrateError("a source file disappeared during the export: its folder is gone") from error
    if found:
        gone = any(row["status"] == "missing" for row in found)
        names = ", ".join(sorted(row["path"] for row in found))
        what = "a source file disappeared" if gone else "the source files changed"
        raise CrateError(f"{what} during the export: {names}")
