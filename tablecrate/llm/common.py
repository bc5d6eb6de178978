"""What several of the text operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecrate.session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared scratch folder and read again: its lineage is cut, and a
    lost executor cannot change what later steps see."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; a null key is in no fold (-1)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(-1))


def unused(df: DataFrame, *wanted: str) -> list[str]:
    """Names like `wanted` that no column of `df` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    return [w if w.lower() not in taken else f"{w}_{uuid.uuid4().hex[:8]}" for w in wanted]


# Copies of a row that very many rows may ask for.
SPREAD = 64


def with_facts(rows: DataFrame, facts: DataFrame, on: str, key: str, spread: Column) -> DataFrame:
    """`rows`, each with the columns of the row of `facts` whose `key` is its `on` (null is a
    value like others; none: nulls), without `key`.

    `facts` has one row a key and is copied `SPREAD` times; rows take a copy by the hash of
    `spread`, so that a key which most rows share is asked for in as many places.
    """
    copy, wanted = unused(rows, "__copy", "__wanted")
    copies = facts.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    asked = rows.withColumn(wanted, F.pmod(F.xxhash64(spread), F.lit(SPREAD)).cast("int"))
    same = asked[on].eqNullSafe(copies[key]) & (asked[wanted] == copies[copy])
    return asked.join(copies, same, "left").drop(copies[key], copies[copy], asked[wanted])


# Fixed value: the white space between words, blank and the five controls from tab on.
_WORD_SPACE = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words of a text, in order: runs of anything but ASCII white space; null has none."""
    blanked = F.translate(F.coalesce(text, F.lit("")), _WORD_SPACE, " " * len(_WORD_SPACE))
    return F.array_remove(F.split(blanked, " "), "")


def without_space(text: Column) -> Column:
    """A text without the white space between words."""
    return F.translate(F.coalesce(text, F.lit("")), " " + _WORD_SPACE, "")
