from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tablecrate.session import job_session  # noqa: E402


@pytest.fixture(scope="session")
def base_spark(tmp_path_factory) -> SparkSession:
    root = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("FATAL")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def spark(base_spark) -> SparkSession:
    return job_session(base_spark)


@pytest.fixture
def schema(spark, tmp_path) -> str:
    """A new, empty catalog schema."""
    name = f"s_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{tmp_path}/{name}'")
    return name


@pytest.fixture
def target(tmp_path) -> str:
    """The name of a schema that loads create."""
    return f"d_{uuid.uuid4().hex[:12]}"
