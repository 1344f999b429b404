"""Running independent writes side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

MOST_AT_ONCE = 8


def run_all(spark: SparkSession, steps: Sequence[Callable[[], Any]]) -> list[Any]:
    """Run Spark jobs side by side, so that small ones do not wait for large ones.

    All are tried; then the first error is raised. Returns their results in order.
    """
    if not steps:
        return []
    # Job properties are passed on: stopping a stream stops its writes too.
    carry = inheritable_thread_target(spark)
    with ThreadPoolExecutor(min(len(steps), MOST_AT_ONCE)) as pool:
        running = [pool.submit(carry(step)) for step in steps]
    return [step.result() for step in running]
