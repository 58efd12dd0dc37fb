"""Independent jobs at the same time, so that small tables do not queue behind large ones."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

Result = TypeVar("Result")


def together(spark: SparkSession, jobs: dict[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run the jobs from one thread each; Spark shares its executors among them.

    Returns the results by name, or raises what the first failing job raised
    once the jobs already running are done.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()
        }
        return {name: job.result() for name, job in running.items()}
