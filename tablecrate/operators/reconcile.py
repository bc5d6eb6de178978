"""Compare two tables as bags of rows.

A row belongs to the bucket that the leading bits of its hash name. Buckets are compared by
row count and hash sum; where those that differ hold many rows, these rows are counted by whole
hash. The first step shuffles one digest a bucket and task, the second a hash a row of differing
buckets. The last step counts the rows themselves whose hash differs. Whatever is dealt by hash
goes to as many tasks as its rows ask for, so a task's memory does not grow with the tables.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.errors import CrateError
from tablecrate.functions.digest import comparable, hash_sum, holds_map, row_hash
from tablecrate.functions.names import backtick
from tablecrate.session import row_parts, scratch_dir

HASH_BITS = 64
SPLIT_BITS = 16  # of the first buckets
FEW_ROWS = 4  # a differing bucket holds two rows at least, unless one side lacks it whole
PART_ROWS = 5 << 19  # hashes that one task counts, or four times the rows
MOST_BROADCAST = 1 << 20  # buckets


@dataclass(frozen=True)
class Differing:
    """Buckets of `bits` bits whose digests differ, one row each (`__bucket`, `rows`)."""

    bits: int
    buckets: DataFrame
    count: int
    rows: int  # of both sides, in these buckets
    most: int  # rows of the largest
    crowds: DataFrame | None = None  # hashes with too many rows for a task, differing or not
    searched: int = 0  # rows of the first buckets that differ


def _bucket(hashes: Column, bits: int) -> Column:
    # A shifted hash is never NULL. A modulo might be, and the optimizer would then push
    # an "is not NULL" with the whole hash expression down and track it column by column.
    return F.shiftrightunsigned(hashes, HASH_BITS - bits)


def _hashed(df: DataFrame, bits: int) -> DataFrame:
    columns = [
        comparable(df, field.name).alias(field.name)
        if holds_map(field.dataType)
        else df[backtick(field.name)]
        for field in df.schema
    ]
    return df.select(*columns, _bucket(row_hash(df), bits).alias("__bucket"))


def _hashes(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select(row_hash(left).alias("__hash"), F.lit(True).alias("__left")).unionAll(
        right.select(row_hash(right).alias("__hash"), F.lit(False).alias("__left"))
    )


def _written(found: DataFrame, bits: int, columns: str) -> tuple[Differing, DataFrame]:
    """What is found, and all that is written: `found` is made once, and its size is known."""
    spark = found.sparkSession
    path = scratch_dir(spark, "buckets")
    found.write.parquet(path)
    held = spark.read.schema(T.StructType.fromDDL(columns)).parquet(path)
    buckets = held.where("delta <> 0") if "delta" in held.columns else held
    total = buckets.agg(F.count(F.lit(1)).alias("buckets"), F.sum("rows").alias("rows"), F.max("rows").alias("most")).first()
    return Differing(bits, buckets.select("__bucket", "rows"), total["buckets"], total["rows"] or 0, total["most"] or 0), held


def _compared(hashes: DataFrame, bits: int) -> Differing:
    """One aggregate of both sides by bucket; it holds 2^`bits` entries a task at most."""
    of_left = F.col("__left")
    digests = hashes.groupBy(_bucket(F.col("__hash"), bits).alias("__bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(of_left).alias("left_rows"),
        hash_sum(F.when(of_left, F.col("__hash"))).alias("left_sum"),
        hash_sum(F.when(~of_left, F.col("__hash"))).alias("right_sum"),
    )
    same = (F.col("rows") == 2 * F.col("left_rows")) & (F.col("left_sum") == F.col("right_sum"))
    return _written(digests.where(~same).select("__bucket", "rows"), bits, "__bucket bigint, rows bigint")[0]


def _parts(spark: SparkSession, rows: int) -> int:
    return row_parts(spark, rows, PART_ROWS)


def _split(hashes: DataFrame, found: Differing) -> Differing:
    """The whole hashes that differ, among rows of buckets that do.

    Hashes are dealt as they are: in aggregates before the shuffle nearly each would be an
    entry. Only in buckets far above the mean, where copies meet, a hash is first counted
    apart for each task that read it.
    """
    limit = max(PART_ROWS, 16 * found.rows // found.count)
    first = F.broadcast(found.buckets)  # 2^SPLIT_BITS rows at most
    inside = hashes.join(first, _bucket(hashes["__hash"], found.bits) == first["__bucket"])
    share = F.when(F.col("rows") > limit, F.spark_partition_id() + 1).otherwise(0)
    inside = inside.select(
        F.col("__hash").alias("__bucket"), F.when(F.col("__left"), 1).otherwise(-1).alias("delta"), share.alias("share")
    )
    parts = _parts(hashes.sparkSession, found.rows)
    counts = [F.count(F.lit(1)).alias("rows"), F.sum("delta").alias("delta")]
    sums = [F.sum("rows").alias("rows"), F.sum("delta").alias("delta")]
    if found.most > limit:
        apart = inside.repartition(parts, "__bucket", "share").groupBy("__bucket", "share").agg(*counts)
        some = apart.where("delta <> 0 OR share > 0").select("__bucket", "rows", "delta")
        counted = some.repartition(parts, "__bucket").groupBy("__bucket").agg(*sums)
    else:
        counted = inside.drop("share").repartition(parts, "__bucket").groupBy("__bucket").agg(*counts)
    kept = counted.where((F.col("delta") != 0) | (F.col("rows") > limit)).select("__bucket", "rows", "delta")
    finer, held = _written(kept, HASH_BITS, "__bucket bigint, rows bigint, delta bigint")
    crowds = held.where(F.col("rows") > limit) if found.most > limit else None
    return replace(finer, crowds=crowds, searched=found.rows)


def differing_buckets(left: DataFrame, right: DataFrame) -> Differing:
    """Hash buckets whose row count or hash sum differs: of `SPLIT_BITS` bits if they hold few
    rows each, else of the whole hash. Each of the two steps reads both tables once."""
    hashes = _hashes(left, right)
    found = _compared(hashes, SPLIT_BITS)
    return _split(hashes, found) if found.rows > FEW_ROWS * found.count else found


def _balances(rows: DataFrame, names: list[str]) -> DataFrame:
    columns = [rows[backtick(name)] for name in names]
    return rows.groupBy(*columns).agg(F.sum("__delta").alias("__delta")).where(F.col("__delta") != 0)


def _counted(tagged: DataFrame, found: Differing, names: list[str]) -> DataFrame:
    """Rows of differing buckets that one side has more often. The buckets are broadcast if
    there are not too many; else rows are dealt by hash, save those of crowds: few hashes."""
    if found.count <= MOST_BROADCAST:
        return _balances(tagged.join(F.broadcast(found.buckets), "__bucket", "left_semi"), names)
    spark, buckets, crowded = tagged.sparkSession, found.buckets, None
    if found.crowds is not None:
        crowds = F.broadcast(found.crowds.select("__bucket"))
        differing = F.broadcast(found.crowds.where("delta <> 0").select("__bucket"))
        crowded = tagged.join(differing, "__bucket", "left_semi")
        tagged = tagged.join(crowds, "__bucket", "left_anti")
        buckets = buckets.join(crowds, "__bucket", "left_anti")
    # The rows follow the partitions of the buckets.
    dealt = buckets.repartition(_parts(spark, found.searched), "__bucket").hint("shuffle_hash")
    rest = tagged.join(dealt, "__bucket", "left_semi")
    rest = rest.repartition(_parts(spark, 4 * found.rows), *[rest[backtick(name)] for name in names])
    balances = _balances(rest, names)
    return balances if crowded is None else balances.unionAll(_balances(crowded, names))


def _unused(df: DataFrame, name: str) -> str:
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side that the other lacks: the columns, `side` ("left" or "right") and
    how many `copies` are missing on the other side. Tables that have such columns get
    `side_` and `copies_` (with as many underscores as it takes).

    Digests per hash bucket come first and shuffle next to nothing (`differing_buckets`).
    Only rows of differing buckets are then counted by value. Copies stay a number: a row
    missing a billion times is one result row. Both tables are read several times, so
    their rows must be the same each time.
    """
    if left.columns != right.columns:
        raise CrateError(f"cannot compare columns {left.columns} with {right.columns}")
    side, copies = _unused(left, "side"), _unused(left, "copies")
    found = differing_buckets(left, right)
    tagged = _hashed(left, found.bits).withColumn("__delta", F.lit(1)).unionAll(
        _hashed(right, found.bits).withColumn("__delta", F.lit(-1))
    )
    return _counted(tagged, found, left.columns).select(
        *[F.col(backtick(name)) for name in left.columns],
        F.when(F.col("__delta") > 0, "left").otherwise("right").alias(side),
        F.abs("__delta").alias(copies),
    )
