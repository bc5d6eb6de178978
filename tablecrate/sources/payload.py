"""Payload files of one object: Parquet or CSV, plain or encrypted row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.functions.names import backtick
from tablecrate.functions import seal, textform

COMPRESSION = "zstd"

_SEALED = "sealed"

_CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "lineSep": "\n",
    "encoding": "UTF-8",
    "nullValue": textform.NULL_MARKER,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Spark's text writers have no zstd without a native library. A gzip file is read by one
# task, so its size is that of one write task's share.
_CSV_WRITE_OPTIONS = {**_CSV_OPTIONS, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write(df: DataFrame, path: str, data_format: str, key: bytes | None = None) -> None:
    if key is not None:
        sealed = seal.seal_row(df, key)
        df = df.select((textform.one_line_base64(sealed) if data_format == "csv" else sealed).alias(_SEALED))
    elif data_format == "csv":
        df = df.select(
            *[
                textform.to_field(df[backtick(field.name)], field.dataType).alias(field.name)
                for field in df.schema
            ]
        )
    writer = df.write.mode("errorifexists")
    if data_format == "csv":
        writer.options(**_CSV_WRITE_OPTIONS).csv(path)
    else:
        writer.option("compression", COMPRESSION).parquet(path)


def sealed_schema(data_format: str) -> T.StructType:
    """What an encrypted payload stores: one column."""
    kind = T.StringType() if data_format == "csv" else T.BinaryType()
    return T.StructType([T.StructField(_SEALED, kind)])


def read(
    spark: SparkSession, path: str, schema: T.StructType, data_format: str, key: bytes | None = None
) -> DataFrame:
    """Rows with the manifest's schema; text or bytes that do not fit fail the job."""
    is_csv = data_format == "csv"
    if key is not None:
        stored = sealed_schema(data_format)
    elif is_csv:
        stored = T.StructType([T.StructField(field.name, T.StringType()) for field in schema])
    else:
        stored = schema
    reader = spark.read.schema(stored)
    source = (
        reader.options(mode="FAILFAST", **_CSV_OPTIONS).csv(path) if is_csv else reader.parquet(path)
    )
    if key is not None:
        sealed = F.col(_SEALED)
        return seal.open_rows(source, F.unbase64(sealed) if is_csv else sealed, schema, key)
    if not is_csv:
        return source
    return source.select(
        *[
            textform.from_field(source[backtick(field.name)], field.dataType).alias(field.name)
            for field in schema
        ]
    )
