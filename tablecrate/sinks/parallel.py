"""Several objects at once: their Spark jobs are submitted from a few driver threads."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def in_parallel(spark: SparkSession, job: Callable, inputs: Sequence, workers: int) -> list:
    """Results in input order. After a failure no further object is started."""
    if workers == 1 or len(inputs) <= 1:
        return [job(value) for value in inputs]
    with ThreadPoolExecutor(workers) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job), value) for value in inputs]
        try:
            return [future.result() for future in futures]
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise
