"""Exact text form of every column type, shared by CSV payloads and encryption."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the CSV payload: the NULL marker, and the character put before every
# string so that NULL, '' and a string equal to the marker stay three different things.
NULL_MARKER = r"\\N"
STRING_TAG = "="
# Backslash goes first when writing and last when reading; every backslash in the
# written text then starts exactly one escape.
_ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))

_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def one_line_base64(column: Column) -> Column:
    """Spark breaks base64 text into lines of 76 characters; CSV records must not break."""
    return F.translate(F.base64(column), "\r\n", "")


def to_text(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.BinaryType):
        return one_line_base64(column)
    if isinstance(data_type, T.TimestampType):
        return F.date_format(column, _INSTANT)
    if is_nested(data_type):
        return F.to_json(column, _JSON_OPTIONS)
    return column.cast("string")


def from_text(column: Column, data_type: T.DataType) -> Column:
    """Inverse of `to_text`. Text that is not a value of the type fails the job."""
    if isinstance(data_type, T.BinaryType):
        return F.unbase64(column)
    if isinstance(data_type, T.VariantType):
        return F.parse_json(column)
    if is_nested(data_type):
        return F.from_json(column, data_type, {"mode": "FAILFAST", **_JSON_OPTIONS})
    return column.cast(data_type)


def to_field(column: Column, data_type: T.DataType) -> Column:
    """CSV field: strings are tagged, and line breaks are escaped so that one record is
    one line and readers can split large files."""
    text = to_text(column, data_type)
    if not isinstance(data_type, T.StringType):
        return text
    for raw, escaped in _ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit(STRING_TAG), text)


def from_field(column: Column, data_type: T.DataType) -> Column:
    if not isinstance(data_type, T.StringType):
        return from_text(column, data_type)
    body = F.substr(column, F.lit(2))
    for raw, escaped in reversed(_ESCAPES):
        body = F.replace(body, F.lit(escaped), F.lit(raw))
    return body
