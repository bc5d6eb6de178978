"""Statistics of columns as sketches that merge: what two batches of rows have apart, their
merged sketches say about both.

A sketch has a row for each column: rows, present values, their bytes, a distinct-count sketch
(HLL), a quantile sketch of numbers (KLL) and the `CAPACITY` most frequent values with exact
counts, besides a bound that no value outside the list exceeds. When lists merge, counts add
up, a value that one list lacks may have its bound more there (`extra`), and what falls off
the list raises the bound. A list with bound 0 and no extra is exact.

Stores lie in a hidden folder of a table's own location, so a replaced table takes its store
along and readers of the table never see it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.errors import CrateError
from tablecrate.functions import textform
from tablecrate.functions.names import backtick
from tablecrate.operators import profile
from tablecrate.sources.files import MetadataFiles
from tablecrate.sources.relations import Relation

CAPACITY = 128
FOLDER = "_statistics"
SCHEMA = """
    ordinal int, column string, rows bigint, present bigint, bytes double, distinct binary,
    quantiles binary, common array<struct<value: string, rows: bigint, extra: bigint>>, bound bigint
"""


def sketch(rows: DataFrame) -> DataFrame:
    """One row a column: counts and sketches in one aggregate, frequent values in another."""
    measures = [F.count(F.lit(1)).alias("rows")]
    columns = []
    for i, field in enumerate(rows.schema):
        value, kind = rows[backtick(field.name)], field.dataType
        hashed = F.xxhash64(textform.to_text(value, kind) if textform.is_nested(kind) else value)
        fixed = profile._fixed_width(kind)
        width = F.lit(fixed) if fixed is not None else profile._width(value, kind)
        measures += [
            F.count(value).alias(f"present_{i}"),
            F.sum(F.when(value.isNotNull(), width.cast("double"))).alias(f"bytes_{i}"),
            F.hll_sketch_agg(F.when(value.isNotNull(), hashed), profile.SKETCH_LOG2_REGISTERS).alias(f"distinct_{i}"),
        ]
        numeric = isinstance(kind, T.NumericType)
        if numeric:
            measures.append(F.kll_sketch_agg_double(value.cast("double")).alias(f"quantiles_{i}"))
        columns.append(
            F.struct(
                F.lit(i + 1).alias("ordinal"), F.lit(field.name).alias("column"), F.col("rows"),
                F.col(f"present_{i}").alias("present"), F.coalesce(f"bytes_{i}", F.lit(0.0)).alias("bytes"),
                F.col(f"distinct_{i}").alias("distinct"),
                (F.col(f"quantiles_{i}") if numeric else F.lit(None).cast("binary")).alias("quantiles"),
            )
        )
    counted = rows.agg(*measures).select(F.inline(F.array(*columns)))
    shown = [f.name for f in rows.schema if not isinstance(f.dataType, T.BinaryType)]
    listed = profile.common_values(rows, CAPACITY + 1, shown).select("column", "rank", "value", "rows")
    entry = F.struct("value", "rows", F.lit(0).cast("bigint").alias("extra"))
    lists = listed.groupBy(F.col("column").alias("of")).agg(
        F.collect_list(F.when(F.col("rank") <= CAPACITY, entry)).alias("common"),
        F.coalesce(F.max(F.when(F.col("rank") > CAPACITY, F.col("rows"))), F.lit(0)).alias("bound"),
    )
    joined = counted.join(lists, F.col("column") == F.col("of"), "left")
    empty = F.array().cast("array<struct<value: string, rows: bigint, extra: bigint>>")
    return joined.select(
        "ordinal", "column", "rows", "present", "bytes", "distinct", "quantiles",
        F.coalesce("common", empty).alias("common"), F.coalesce("bound", F.lit(0)).alias("bound"),
    )


def merged(sketches: DataFrame) -> DataFrame:
    """The sketches of several batches as one, in the same columns."""
    totals = sketches.groupBy("ordinal", "column").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.sum("bytes").alias("bytes"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.sum("bound").alias("missed"),
    )
    listed = sketches.select(F.col("ordinal").alias("of"), "bound", F.inline("common"))
    values = listed.groupBy("of", "value").agg(
        F.sum("rows").alias("rows"), F.sum("extra").alias("known_extra"), F.sum("bound").alias("own_bound")
    )
    values = values.join(totals.select(F.col("ordinal").alias("of"), "missed"), "of")
    # In batches whose list lacks the value it may have as many rows as their bound.
    extra = F.col("known_extra") + F.col("missed") - F.col("own_bound")
    place = Window.partitionBy("of").orderBy(F.col("rows").desc(), F.col("value"))
    ranked = values.withColumn("extra", extra).withColumn("place", F.row_number().over(place))
    stays = F.col("place") <= CAPACITY
    lists = ranked.groupBy("of").agg(
        F.array_sort(F.collect_list(F.when(stays, F.struct("place", "value", "rows", "extra")))).alias("ranked"),
        F.max(F.when(~stays, F.col("rows") + F.col("extra"))).alias("dropped"),
    )
    joined = totals.join(lists, F.col("ordinal") == F.col("of"), "left")
    fields = lambda x: F.struct(x["value"].alias("value"), x["rows"].alias("rows"), x["extra"].alias("extra"))
    common = F.coalesce(F.transform("ranked", fields), F.array().cast(T.ArrayType(_entry())))
    return joined.select(
        "ordinal", "column", "rows", "present", "bytes", "distinct", "quantiles", common.alias("common"),
        F.greatest("missed", F.coalesce("dropped", F.lit(0))).alias("bound"),
    )


def _entry() -> T.StructType:
    return T.StructType.fromDDL("value string, rows bigint, extra bigint")


def summary(sketches: DataFrame, top: int = 0) -> DataFrame:
    """What a profile shows, from merged sketches: no rows of the table are read. `common` has
    the `top` first values with the least number of rows they have."""
    return sketches.select(
        "ordinal", "column", "rows",
        F.try_divide(F.col("rows") - F.col("present"), F.col("rows")).alias("null_fraction"),
        F.hll_sketch_estimate("distinct").cast("double").alias("distinct_values"),
        F.try_divide("bytes", F.col("present")).alias("average_width_bytes"),
        F.when(F.kll_sketch_get_n_double("quantiles") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5))).alias("median"),
        F.slice("common", 1, top).alias("common"),
        ((F.col("bound") == 0) & ~F.exists("common", lambda x: x["extra"] > 0)).alias("common_is_exact"),
    )


def _folder(relation: Relation) -> str:
    if relation.kind != "table" or relation.location is None:
        raise CrateError(f"{relation.schema}.{relation.name} has no place for statistics")
    return f"{relation.location.rstrip('/')}/{FOLDER}"


def has_store(spark: SparkSession, relation: Relation) -> bool:
    if relation.kind != "table" or relation.location is None:
        return False
    return bool(_batches(spark, relation))


def _batches(spark: SparkSession, relation: Relation) -> list[str]:
    files, folder = MetadataFiles(spark), _folder(relation)
    return [f"{folder}/{b}" for b in files.subfolders(folder) if files.exists(f"{folder}/{b}/_SUCCESS")]


def add_batch(spark: SparkSession, relation: Relation, rows: DataFrame) -> None:
    """Put the sketches of more rows beside those of the table."""
    sketch(rows).coalesce(1).write.parquet(f"{_folder(relation)}/{uuid.uuid4().hex}")


def analyze(spark: SparkSession, relation: Relation, rows: DataFrame) -> None:
    """Sketch the whole table anew; older batches go once the new one is there."""
    old = _batches(spark, relation)
    add_batch(spark, relation, rows)
    for path in old:
        MetadataFiles(spark).delete_tree(path)


def stored(spark: SparkSession, relation: Relation) -> DataFrame:
    """The merged sketches of all batches."""
    paths = _batches(spark, relation)
    if not paths:
        raise CrateError(f"{relation.schema}.{relation.name} has not been analyzed")
    return merged(spark.read.schema(SCHEMA).parquet(*paths))
