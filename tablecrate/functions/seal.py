"""Passphrase encryption: AES-256-GCM by Spark, key by scrypt."""

from __future__ import annotations

import base64
import hashlib
import os

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.functions.names import backtick
from tablecrate.errors import CrateError
from tablecrate.functions import textform

SALT_BYTES = 16
KEY_BYTES = 32


def new_salt() -> bytes:
    return os.urandom(SALT_BYTES)


def derive_key(password: str, salt: bytes) -> bytes:
    return hashlib.scrypt(
        password.encode(), salt=salt, n=2**15, r=8, p=1, maxmem=2**26, dklen=KEY_BYTES
    )


def password_from(argument: str | None, environment: dict[str, str]) -> str | None:
    """An explicit password wins; an empty one is an error. PASSWORD is the fallback,
    where empty means none."""
    if argument is not None:
        if not argument:
            raise CrateError("the password must not be empty")
        return argument
    return environment.get("PASSWORD") or None


def seal(plain: Column, key: bytes) -> Column:
    """Text to encrypted binary. A fresh random IV per value: equal texts look different."""
    return F.aes_encrypt(plain.cast("binary"), F.lit(bytearray(key)), F.lit("GCM"))


def unseal(sealed: Column, key: bytes) -> Column:
    return F.aes_decrypt(sealed, F.lit(bytearray(key)), F.lit("GCM")).cast("string")


def seal_row(df: DataFrame, key: bytes) -> Column:
    """A whole row as one encrypted value. Setting up the cipher costs far more than the
    bytes, and one value also hides which columns are NULL and how long each one is."""
    texts = [
        textform.to_text(df[backtick(field.name)], field.dataType).alias(f"c{i}")
        for i, field in enumerate(df.schema)
    ]
    return seal(F.to_json(F.struct(*texts)), key)


def open_rows(sealed: DataFrame, column: Column, schema: T.StructType, key: bytes) -> DataFrame:
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema))])
    opened = sealed.select(
        F.from_json(unseal(column, key), texts, {"mode": "FAILFAST"}).alias("row")
    )
    return opened.select(
        *[
            textform.from_text(F.col(f"row.c{i}"), field.dataType).alias(field.name)
            for i, field in enumerate(schema)
        ]
    )


def seal_text(spark: SparkSession, text: str, key: bytes) -> str:
    """Encrypt one small metadata text (manifest, DDL)."""
    sealed = spark.range(1).select(seal(F.lit(text), key)).first()[0]
    return base64.b64encode(bytes(sealed)).decode()


def open_text(spark: SparkSession, sealed: str, key: bytes) -> str:
    column = F.lit(bytearray(base64.b64decode(sealed)))
    try:
        return spark.range(1).select(unseal(column, key)).first()[0]
    except PySparkException as error:
        raise CrateError("wrong password, or the snapshot is damaged") from error
