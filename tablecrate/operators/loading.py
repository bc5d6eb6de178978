"""Checks between the rows of a snapshot and the table they are meant for."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecrate.functions.names import backtick
from tablecrate.sources.relations import Relation


def require_not_null(df: DataFrame, columns: Iterable[str], label: str) -> DataFrame:
    """The same rows, but a NULL in one of `columns` fails the job that reads them.

    File tables accept NULL in a NOT NULL column, so the check rides along in the
    write itself instead of costing a pass of its own.
    """
    guarded = set(columns)

    def checked(name: str) -> Column:
        column = df[backtick(name)]
        if name not in guarded:
            return column
        message = F.lit(f"NULL in NOT NULL column {name} of {label}")
        return F.when(column.isNotNull(), column).otherwise(F.raise_error(message)).alias(name)

    return df.select(*[checked(name) for name in df.columns]) if guarded else df


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, violations) for every NOT NULL column, in one pass."""
    counts = df.agg(
        *[F.count_if(df[backtick(name)].isNull()).alias(f"c{i}") for i, name in enumerate(columns)]
    )
    pairs = [
        F.struct(F.lit(name).alias("column"), F.col(f"c{i}").alias("violations"))
        for i, name in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*pairs)))


COMPAT_SCHEMA = "column string, expected string, actual string, status string"


def compatibility(
    columns: Sequence[str], types: Sequence[str], target: Relation
) -> list[tuple[str, str | None, str | None, str]]:
    """Rows of `COMPAT_SCHEMA`: each required column against the target table. Extra
    target columns are fine. Without recorded types only names are compared."""
    actual = {column.name: column.type_text for column in target.columns}
    expected = dict(zip(columns, types)) if len(types) == len(columns) else {}
    report = []
    for name in columns:
        wanted, found = expected.get(name), actual.get(name)
        if found is None:
            status = "missing"
        elif wanted is not None and wanted != found:
            status = "type differs"
        else:
            status = "ok"
        report.append((name, wanted, found, status))
    return report
