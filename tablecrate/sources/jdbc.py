"""A database as the source: one relation read over JDBC, in parallel key ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablecrate.errors import CrateError
from tablecrate.functions.names import double_quoted, double_quoted_path

_DEFAULT_PORT = 5432


@dataclass(frozen=True)
class Connection:
    """Values left out here fall back to the environment, then to defaults."""

    host: str | None = None
    port: int | None = None
    dbname: str | None = None
    user: str | None = None
    password: str | None = None
    url: str | None = None

    def options(self, environment: dict[str, str]) -> dict[str, str]:
        host = self.host or environment.get("PGHOST") or "localhost"
        port = self.port or int(environment.get("PGPORT") or _DEFAULT_PORT)
        user = self.user or environment.get("PGUSER")
        dbname = self.dbname or environment.get("PGDATABASE") or user
        password = self.password or environment.get("PGPASSWORD")
        if not self.url and not dbname:
            raise CrateError("the connection needs a dbname or a user")
        options = {"url": self.url or f"jdbc:postgresql://{host}:{port}/{dbname}"}
        if user:
            options["user"] = user
        if password:
            options["password"] = password
        return options


@dataclass(frozen=True)
class KeyRange:
    """How to split one relation: `column` is cut into `partitions` ranges. With no
    bounds given, the database is asked for the smallest and largest value."""

    column: str
    partitions: int
    lower: str | None = None
    upper: str | None = None


def read_relation(
    spark: SparkSession,
    options: dict[str, str],
    schema: str,
    name: str,
    key_range: KeyRange | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Filters, columns and limits of the later plan are pushed into the database.

    Each partition opens its own connection, so several partitions do not share one
    database snapshot; without `key_range` the whole relation is one statement.
    """
    reader = (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", double_quoted_path(schema, name))
        .option("fetchsize", fetch_size)
    )
    if key_range is None:
        return reader.load()
    lower, upper = key_range.lower, key_range.upper
    if lower is None or upper is None:
        column = double_quoted(key_range.column)
        bounds = (
            spark.read.format("jdbc")
            .options(**options)
            .option(
                "query",
                f"SELECT MIN({column}) AS low, MAX({column}) AS high"
                f" FROM {double_quoted_path(schema, name)}",
            )
            .load()
            .first()
        )
        lower = lower if lower is not None else bounds[0]
        upper = upper if upper is not None else bounds[1]
    if lower is None or upper is None:  # no rows
        return reader.load()
    return (
        reader.option("partitionColumn", double_quoted(key_range.column))
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", key_range.partitions)
        .load()
    )
