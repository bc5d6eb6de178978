"""Consecutive row numbers over a whole DataFrame without a one-task window."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.functions.names import backtick
from tablecrate.session import scratch_dir

_MARK = "__partition_row"
_ROW_BITS = 33  # layout of monotonically_increasing_id(): partition above, row below


def with_positions(df: DataFrame, name: str, order: list[Column] | None = None) -> DataFrame:
    """Add `name`: 0, 1, 2, ... in `order` (or in the rows' present order).

    A range sort spreads the rows, each partition numbers its own, and the partition
    sizes give the starting points. The numbered rows are written to the shared scratch
    folder first: a lost executor must not renumber rows that others already counted.
    """
    spark = df.sparkSession
    ordered = df.orderBy(*order) if order else df
    path = scratch_dir(spark, "numbered")
    ordered.withColumn(_MARK, F.monotonically_increasing_id()).write.parquet(path)
    marked = spark.read.schema(
        T.StructType([*df.schema.fields, T.StructField(_MARK, T.LongType())])
    ).parquet(path)

    partition = F.shiftright(_MARK, _ROW_BITS)
    sizes = marked.groupBy(partition.alias("__partition")).agg(F.count(F.lit(1)).alias("__rows"))
    # One row per partition of the numbered data, so this window and broadcast stay small.
    before = Window.orderBy("__partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "__partition", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start")
    )
    within = F.col(_MARK).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        marked.withColumn("__partition", partition)
        .join(F.broadcast(starts), "__partition")
        .select(*[marked[backtick(c)] for c in df.columns], (F.col("__start") + within).alias(name))
    )


def reads_files(df: DataFrame) -> bool:
    """Whether the rows come straight from files, not through a view, a join or JDBC."""
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return False
    return True
