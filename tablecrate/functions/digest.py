"""Order-independent row digests: one long per row, one decimal per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.functions.names import backtick


def holds_map(data_type: T.DataType) -> bool:
    """Whether values need `comparable` before they can be hashed or grouped."""
    if isinstance(data_type, T.ArrayType):
        return holds_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(holds_map(field.dataType) for field in data_type)
    return isinstance(data_type, (T.MapType, T.VariantType))


def comparable(df: DataFrame, name: str) -> Column:
    """The column in a form that can be hashed, grouped and compared.

    Maps and variants have no order or equality in Spark, so they are turned into
    sorted entries or JSON.
    """
    data_type = df.schema[name].dataType
    column = df[backtick(name)]
    if isinstance(data_type, T.VariantType):
        return F.to_json(column)
    if isinstance(data_type, T.MapType) and not holds_map(data_type.valueType):
        return F.array_sort(F.map_entries(column))
    if holds_map(data_type):
        return F.to_json(column, {"ignoreNullFields": "false"})
    return column


def hash_parts(value: Column, data_type: T.DataType) -> list[Column]:
    """What to hash of a value so that different values differ.

    Spark's hash skips NULLs and runs nested values together, so (NULL, 'a') would equal
    ('a', NULL) and [[a], [b]] equal [[a, b]]. The null flag is hashed at every level; an array
    adds its size and one hash for each element, a struct the parts of its fields.
    """
    if isinstance(data_type, T.ArrayType):
        each = F.transform(value, lambda x: F.xxhash64(*hash_parts(x, data_type.elementType)))
        return [value.isNull(), F.size(value), each]
    if isinstance(data_type, T.StructType):
        fields = [p for f in data_type for p in hash_parts(value.getField(f.name), f.dataType)]
        return [value.isNull(), *fields]
    return [value.isNull(), value]


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a whole row."""
    parts: list[Column] = []
    for field in df.schema:
        value = comparable(df, field.name)
        kind = field.dataType
        if isinstance(kind, T.MapType) and not holds_map(kind.valueType):
            entry = T.StructType().add("key", kind.keyType).add("value", kind.valueType)
            kind = T.ArrayType(entry)
        elif holds_map(kind):
            kind = T.StringType()  # JSON
        parts += hash_parts(value, kind)
    return F.xxhash64(*parts)


_QUARTER = 16


def hash_sum(row_hashes: Column) -> Column:
    """Aggregate: the sum of 64-bit hashes, exact. Sums of 16-bit quarters are plain longs
    (good for 10^14 rows) and meet in one decimal at the end."""
    total = F.lit(0).cast("decimal(38,0)")
    for i in range(64 // _QUARTER):
        part = F.shiftright(row_hashes, i * _QUARTER)
        if i < 64 // _QUARTER - 1:
            part = part.bitwiseAND(F.lit((1 << _QUARTER) - 1))
        weight = F.lit(1 << (i * _QUARTER)).cast("decimal(16,0)")
        total = total + F.coalesce(F.sum(part), F.lit(0)).cast("decimal(20,0)") * weight
    return total.cast("decimal(38,0)")


def row_hash_sum(df: DataFrame) -> Column:
    """Aggregate: sum of row hashes. It does not depend on row order, and unlike an
    exclusive-or it sees duplicated rows."""
    return hash_sum(row_hash(df))
