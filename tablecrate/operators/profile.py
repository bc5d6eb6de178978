"""Column statistics: null fraction, distinct values, width, common values, labels.

Exact figures come from one shared step: unpivot the columns and count equal values.
Partial aggregation runs before the shuffle, so a value held by a third of all rows costs
one entry per task. The approximate mode keeps to one aggregate and moves no values. Common
values come from a summary of counters, whose bound tells which values to count exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.functions import textform
from tablecrate.functions.names import backtick
from tablecrate.session import row_parts, scratch_dir

# 2^14 registers: about 0.8 % standard error, 16 KB per column and task.
SKETCH_LOG2_REGISTERS = 14
# Shares of a column's values that are trimmed on their own before they are ranked.
SHARES = 256
# Counters of a column's summary of values.
COUNTERS = 1 << 16
LEAST_CANDIDATES = 256
# Hashes that one task counts.
PART_HASHES = 1 << 20

# Bytes of one value, by type.
_FIXED_WIDTHS: dict[type[T.DataType], int] = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
    T.DateType: 4,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DayTimeIntervalType: 8,
    T.YearMonthIntervalType: 4,
}


_HASHED_AS_THEY_ARE = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampNTZType,
)


def _fixed_width(data_type: T.DataType) -> int | None:
    if isinstance(data_type, T.DecimalType):
        return 8 if data_type.precision <= 18 else 16
    return _FIXED_WIDTHS.get(type(data_type))


def _width(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.octet_length(column)
    return F.octet_length(textform.to_text(column, data_type))


def _value_text(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        column = column + F.lit(0.0).cast(data_type)  # -0.0 and 0.0 are one value
    return textform.to_text(column, data_type)


def _chosen(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else df.columns


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(ordinal, value, width, rows): every distinct value of every column as text, NULL
    included."""
    cells = []
    for ordinal, name in enumerate(_chosen(df, columns), start=1):
        data_type = df.schema[name].dataType
        column = df[backtick(name)]
        fixed = _fixed_width(data_type)
        cells.append(
            F.struct(
                F.lit(ordinal).alias("ordinal"),
                _value_text(column, data_type).alias("value"),
                (F.lit(fixed) if fixed is not None else _width(column, data_type)).alias("width"),
            )
        )
    return (
        df.select(F.inline(F.array(*cells)))
        .groupBy("ordinal", "value", "width")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _with_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    name_of = F.element_at(F.array(*[F.lit(name) for name in names]), F.col("ordinal"))
    return df.withColumn("column", name_of)


def profile_exact(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(ordinal, column, rows, null_fraction, distinct_values, average_width_bytes)."""
    return summarize(value_counts(df, columns), _chosen(df, columns))


def summarize(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    present = F.when(F.col("value").isNotNull(), F.col("rows"))
    summary = counts.groupBy("ordinal").agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(present), F.lit(0)).alias("__present"),
        F.count("value").alias("distinct_values"),
        F.sum(present * F.col("width")).alias("__bytes"),
    )
    return _with_names(summary, names).select(
        "ordinal",
        "column",
        "rows",
        ((F.col("rows") - F.col("__present")) / F.col("rows")).alias("null_fraction"),
        F.col("distinct_values").cast("double").alias("distinct_values"),
        F.try_divide(F.col("__bytes"), F.col("__present")).alias("average_width_bytes"),
    )


def profile_approximate(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    log2_registers: int = SKETCH_LOG2_REGISTERS,
) -> DataFrame:
    """Same columns as `profile_exact`, from one aggregate: nothing but sketches is
    shuffled, however many distinct values there are."""
    names = _chosen(df, columns)
    measures = [F.count(F.lit(1)).alias("rows")]
    widths: dict[int, Column] = {}
    for i, name in enumerate(names):
        data_type = df.schema[name].dataType
        column = df[backtick(name)]
        hashed = F.xxhash64(
            textform.to_text(column, data_type) if textform.is_nested(data_type) else column
        )
        sketch = F.hll_sketch_agg(F.when(column.isNotNull(), hashed), log2_registers)
        fixed = _fixed_width(data_type)
        measures += [
            F.count(column).alias(f"present_{i}"),
            F.hll_sketch_estimate(sketch).alias(f"distinct_{i}"),
        ]
        if fixed is None:
            widths[i] = F.col(f"width_{i}")
            measures.append(F.avg(_width(column, data_type)).alias(f"width_{i}"))
        else:
            widths[i] = F.when(F.col(f"present_{i}") > 0, F.lit(float(fixed)))
    measured = df.agg(*measures)
    rows_of = [
        F.struct(
            F.lit(i + 1).alias("ordinal"),
            F.lit(name).alias("column"),
            F.col("rows"),
            F.try_divide(F.col("rows") - F.col(f"present_{i}"), F.col("rows")).alias("null_fraction"),
            F.col(f"distinct_{i}").cast("double").alias("distinct_values"),
            widths[i].alias("average_width_bytes"),
        )
        for i, name in enumerate(names)
    ]
    return measured.select(F.inline(F.array(*rows_of)))


def _ranked(counts: DataFrame, order: Sequence[Column], top: int) -> DataFrame:
    """The first `top` rows of every ordinal, with `rank`. Each of `SHARES` shares of an
    ordinal's rows is trimmed to `top` first, so a column with billions of values never
    meets in one task."""
    share = F.pmod(F.xxhash64("value"), F.lit(SHARES))
    first = Window.partitionBy("ordinal", share).orderBy(*order)
    trimmed = counts.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    within = Window.partitionBy("ordinal").orderBy(*order)
    return trimmed.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= top)


def _by_rows() -> list[Column]:
    return [F.col("rows").desc(), F.col("value").asc()]


def _value_hash(column: Column, data_type: T.DataType) -> Column:
    """Equal for equal texts; of the value itself where values and texts differ together."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.xxhash64(column + F.lit(0.0).cast(data_type))
    if isinstance(data_type, _HASHED_AS_THEY_ARE):
        return F.xxhash64(column)
    return F.xxhash64(_value_text(column, data_type))


def _cells(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(ordinal, value, hash): every value of every column as text, without NULLs. Texts are
    made only where a query asks for them, and after its joins by hash."""
    kinds = [df.schema[name].dataType for name in names]
    held = [df[backtick(name)].alias(f"c{i}") for i, name in enumerate(names)]
    each = df.select(*held, F.explode(F.array(*[F.lit(i + 1) for i in range(len(names))])).alias("ordinal"))

    def of_column(form: Callable[[Column, T.DataType], Column]) -> Column:
        found = F
        for i, kind in enumerate(kinds):
            found = found.when(F.col("ordinal") == i + 1, form(F.col(f"c{i}"), kind))
        return found

    present = each.where(of_column(lambda column, _: column.isNotNull()))
    return present.select("ordinal", of_column(_value_text).alias("value"), of_column(_value_hash).alias("hash"))


def counters(cells: DataFrame, columns: Sequence[str] = ("ordinal",)) -> DataFrame:
    """A summary of values that can be merged by adding: rows of each of `COUNTERS` classes of
    hashes. No value of a class has more rows than the class."""
    return cells.groupBy(*columns, F.col("hash").bitwiseAND(F.lit(COUNTERS - 1)).alias("counter")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def heavy_values(cells: DataFrame, top: int) -> DataFrame:
    """(ordinal, value, rows): exact counts of values among which are the `top` most frequent
    ones of each ordinal, ties in value order.

    The summary of counters comes first. The values of the largest counters are counted
    exactly; the least of their `top` best shows which other counters could still hold a
    better value. Where there are such, a wider summary (a counter a hash) does the same, and
    only values are counted that its bound does not rule out: those of counters with more rows
    than the least of the best, and those that precede it in value order. So neither all
    values nor long texts are shuffled, whatever a column holds.
    """
    summary = _written(counters(cells), "counters")
    asked = max(4 * top, LEAST_CANDIDATES)
    place = Window.partitionBy("ordinal").orderBy(F.col("rows").desc(), "counter")
    ranked = summary.withColumn("place", F.row_number().over(place))  # at most COUNTERS rows an ordinal
    # At most `asked` counters a column. Two ints make a key that is looked up as one long.
    chosen = ranked.where(F.col("place") <= asked).select("ordinal", F.col("counter").cast("int").alias("counter"))
    counter = F.col("hash").bitwiseAND(F.lit(COUNTERS - 1)).cast("int").alias("counter")
    counted = _written(
        cells.select("*", counter)
        .join(F.broadcast(chosen), ["ordinal", "counter"], "left_semi")
        .groupBy("ordinal", "value")
        .agg(F.count(F.lit(1)).alias("rows")),
        "candidates",
    )
    others = {r["ordinal"]: r["rows"] for r in ranked.where(F.col("place") == asked + 1).collect()}
    if not others:
        return counted
    best = _ranked(counted, _by_rows(), top).where(F.col("rank") == top)
    least = {r["ordinal"]: (r["rows"], r["value"]) for r in best.collect()}  # a row a column
    # Over `asked` counters hold over `top` values, so every such column has a least one.
    left = [ordinal for ordinal, most in others.items() if most >= least[ordinal][0]]
    if not left:
        return counted
    rest = cells.where(F.col("ordinal").isin(left))
    # Nearly each hash would be an entry of an aggregate before the shuffle, so they are dealt
    # as they are; those of the largest counters, which may crowd a task, are counted already.
    rows = summary.where(F.col("ordinal").isin(left)).agg(F.sum("rows")).first()[0]
    hashes = rest.select("ordinal", "hash", counter).join(F.broadcast(chosen), ["ordinal", "counter"], "left_anti")
    dealt = hashes.select("ordinal", "hash").repartition(row_parts(cells.sparkSession, rows, PART_HASHES), "ordinal", "hash")
    wide = dealt.groupBy("ordinal", "hash").agg(F.count(F.lit(1)).alias("rows"))
    more, early = F.lit(False), F.lit(False)
    for ordinal in left:
        fewest, last = least[ordinal]
        more = more | ((F.col("ordinal") == ordinal) & (F.col("rows") > fewest))
        early = early | ((F.col("ordinal") == ordinal) & (F.col("value") < F.lit(last)))
    # Written first, so that its size is known when the join is planned.
    above = _written(wide.where(more).select("ordinal", "hash"), "above").withColumn("above", F.lit(True))
    found = rest.join(above, ["ordinal", "hash"], "left").where(F.col("above").isNotNull() | early)
    both = counted.unionAll(found.groupBy("ordinal", "value").agg(F.count(F.lit(1)).alias("rows")))
    return both.groupBy("ordinal", "value").agg(F.max("rows").alias("rows"))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def common_values(
    df: DataFrame, top: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """(column, rank, value, rows, frequency): the `top` most frequent values of each
    column, ties in value order. NULL is left out but counts in the denominator; binary
    columns are not shown."""
    names = [
        name
        for name in _chosen(df, columns)
        if not isinstance(df.schema[name].dataType, T.BinaryType)
    ]
    total = df.agg(F.count(F.lit(1))).scalar()
    ranked = _ranked(heavy_values(_cells(df, names), top), _by_rows(), top)
    return _with_names(ranked, names).select(
        "ordinal", "column", "rank", "value", "rows", (F.col("rows") / total).alias("frequency")
    )


def enum_labels(
    df: DataFrame, max_labels: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """(column, position, label): the values of each string column that has at most
    `max_labels` of them, in sort order."""
    names = [
        name
        for name in _chosen(df, columns)
        if isinstance(df.schema[name].dataType, T.StringType)
    ]
    counts = value_counts(df, names).where(F.col("value").isNotNull())
    # One more than allowed is enough to know that a column has too many.
    first = _ranked(counts, [F.col("value").asc()], max_labels + 1)
    labels = (
        first.groupBy("ordinal")
        .agg(F.array_sort(F.collect_list("value")).alias("labels"))
        .where(F.size("labels") <= max_labels)
    )
    return (
        _with_names(labels, names)
        .select("column", F.posexplode("labels").alias("position", "label"))
        .withColumn("position", F.col("position") + 1)
    )
