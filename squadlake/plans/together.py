"""Independent writes at the same time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

JOBS_AT_ONCE = 4


def run_together(spark: SparkSession, actions: Iterable[Callable[[], None]]) -> None:
    """Submit actions from a few threads, so that small jobs fill the tail of large ones.

    The first error is raised once the running actions have ended.
    """
    submit = inheritable_thread_target(spark)(lambda action: action())
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        list(pool.map(submit, actions))
