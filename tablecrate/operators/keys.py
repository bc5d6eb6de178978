"""Generated keys: the high-water mark of each key column, and keys for new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecrate.functions.names import backtick
from tablecrate.operators.numbering import with_positions


def next_value(column: Column) -> Column:
    """Aggregate: largest value plus one; 1 when there is none."""
    return F.coalesce(F.max(column).cast("bigint") + 1, F.lit(1).cast("bigint"))


def key_watermark(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, next_value) for every key column, in one pass over those columns."""
    marks = df.agg(*[next_value(df[backtick(name)]).alias(f"k{i}") for i, name in enumerate(columns)])
    pairs = [
        F.struct(F.lit(name).alias("column"), F.col(f"k{i}").alias("next_value"))
        for i, name in enumerate(columns)
    ]
    return marks.select(F.inline(F.array(*pairs)))


def assign_keys(
    df: DataFrame, column: str, start: int | Column, order: Sequence[Column] = ()
) -> DataFrame:
    """Give new rows consecutive keys from `start`, in `order`. `start` may be a scalar
    subquery over the target table."""
    numbered = with_positions(df, "__position", list(order) or None)
    first = F.lit(start).cast("bigint") if isinstance(start, int) else start
    key = (first + F.col("__position")).alias(column)
    return numbered.select(key, *[numbered[backtick(c)] for c in df.columns if c != column])
