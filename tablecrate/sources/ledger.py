"""A digest of each payload file, and what of it no longer holds.

One row a file: name, bytes, rows and the checksum of what the file stores (Parquet rows, text
lines, or sealed rows as they lie there, so an encrypted snapshot needs no password for it).
Executors compute, store and compare these rows. `fold` adds them up by folder; the digest of
a folder is the sum of those below it, so equal folders need no look at their files.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.errors import CrateError
from tablecrate.functions.digest import row_hash_sum
from tablecrate.sources import payload, relations
from tablecrate.sources.files import MetadataFiles
from tablecrate.sources.manifests import ManifestObject, Snapshot

SCHEMA = "object string, file string, bytes bigint, rows bigint, checksum decimal(38,0)"


def ledger_path(data_path: str) -> str:
    """Where the ledger of a payload folder is: `run/data/x` has `run/files/x`."""
    run, _, stem = data_path.split("/", 2)
    return f"{run}/files/{stem}"


def _file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _stored_rows(
    spark: SparkSession, path: str, schema: T.StructType, data_format: str, sealed: bool
) -> DataFrame:
    """The rows as the files store them. Files that cannot be read give no rows, or only
    those before the damage."""
    reader = spark.read.option("ignoreCorruptFiles", True)
    if data_format == "csv":
        return reader.text(path, lineSep="\n")  # a record is a line
    return reader.schema(payload.sealed_schema(data_format) if sealed else schema).parquet(path)


def take(
    spark: SparkSession, path: str, schema: T.StructType, data_format: str, sealed: bool, name: str
) -> DataFrame:
    """The ledger of one payload folder as it is now. Every file that lies there has a row;
    `rows` and `checksum` are 0 for a file without readable rows."""
    try:
        listed = spark.read.format("binaryFile").load(path).select(
            _file_name(F.col("path")).alias("file"), F.col("length").alias("bytes")
        )
    except PySparkException:  # the folder is gone
        return spark.createDataFrame([], SCHEMA)
    rows = _stored_rows(spark, path, schema, data_format, sealed)
    digests = rows.groupBy(_file_name(F.col("_metadata.file_path")).alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), row_hash_sum(rows).alias("checksum")
    )
    return listed.join(digests, "file", "left").select(
        F.lit(name).alias("object"),
        "file",
        "bytes",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("checksum", F.lit(0)).cast("decimal(38,0)").alias("checksum"),
    )


def fold(ledger: DataFrame) -> DataFrame:
    """folder, files, bytes, rows, checksum: each object, and `` for all of them. Groups are
    objects, so only one row an object and task is shuffled."""
    return (
        ledger.select(F.explode(F.array(F.col("object"), F.lit(""))).alias("folder"), "*")
        .groupBy("folder")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("bytes").alias("bytes"),
            F.sum("rows").alias("rows"),
            F.sum("checksum").alias("checksum"),
        )
    )


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """object, file, status, and bytes and rows before and after, of every file that is not
    the same: "missing", "unlisted" (the ledger does not know it), "unreadable" (it had rows
    and gives none) or "changed"."""
    joined = before.alias("b").join(after.alias("a"), ["object", "file"], "full_outer")
    same = F.lit(True)
    for name in ("bytes", "rows", "checksum"):
        same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    return joined.where(~same).select(
        "object",
        "file",
        F.when(F.col("a.rows").isNull(), "missing")
        .when(F.col("b.rows").isNull(), "unlisted")
        .when((F.col("a.rows") == 0) & (F.col("b.rows") > 0), "unreadable")
        .otherwise("changed")
        .alias("status"),
        F.col("b.bytes").alias("bytes_before"),
        F.col("a.bytes").alias("bytes_after"),
        F.col("b.rows").alias("rows_before"),
        F.col("a.rows").alias("rows_after"),
    )


def write(
    spark: SparkSession, out: str, data_path: str, schema: T.StructType, data_format: str, sealed: bool,
    name: str,
) -> None:
    found = take(spark, f"{out}/{data_path}", schema, data_format, sealed, name)
    found.write.parquet(f"{out}/{ledger_path(data_path)}")


def has_ledger(spark: SparkSession, snapshot: Snapshot, item: ManifestObject) -> bool:
    place = f"{snapshot.path}/{ledger_path(item.payload)}/_SUCCESS"
    return item.has_data and MetadataFiles(spark).exists(place)


def read(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """The stored ledger of all objects that have one."""
    paths = [
        f"{snapshot.path}/{ledger_path(item.payload)}"
        for item in snapshot.manifest.objects
        if has_ledger(spark, snapshot, item)
    ]
    if not paths:
        raise CrateError(f"{snapshot.path} has no file ledger; export with general.file_ledger = true")
    return spark.read.schema(SCHEMA).parquet(*paths)


def damaged_files(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """Files that differ from the ledger stored at export (see `compare`); reads the payload
    once. No rows: every file is as it was."""
    before = read(spark, snapshot)
    after = spark.createDataFrame([], SCHEMA)
    for item in snapshot.manifest.objects:
        if has_ledger(spark, snapshot, item):
            after = after.unionAll(_now(spark, snapshot, item))
    return compare(before, after)


def _now(spark: SparkSession, snapshot: Snapshot, item: ManifestObject) -> DataFrame:
    schema = T.StructType(
        [T.StructField(c.name, relations.type_from_text(c.type)) for c in item.columns]
    )
    form = snapshot.manifest.payload_format
    return take(
        spark, f"{snapshot.path}/{item.payload}", schema, form, snapshot.encrypted, ".".join(item.target)
    )


def damage_of(spark: SparkSession, snapshot: Snapshot, item: ManifestObject, most: int = 5) -> str:
    """The first damaged files of one object, for an error message; "" without a ledger."""
    if not has_ledger(spark, snapshot, item):
        return ""
    stored = spark.read.schema(SCHEMA).parquet(f"{snapshot.path}/{ledger_path(item.payload)}")
    found = compare(stored, _now(spark, snapshot, item)).orderBy("file").limit(most).collect()
    return "".join(f"; {row['file']} is {row['status']}" for row in found)
