"""Number formats of the profile report, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(fraction: Column) -> Column:
    return F.format_string("%.2f%%", fraction.cast("double") * 100)


def distinct_estimate(value: Column) -> Column:
    number = value.cast("double")
    return (
        F.when(number.isNull(), "unknown")
        .when(number >= 100, F.format_string("~%.0f", number))
        .otherwise(F.format_string("~%.2f", number))
    )
