"""Independent Spark actions submitted at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *steps: Callable[[], Any], keep_errors: bool = False) -> list[Any]:
    """Results in the order given; the first failing step, in that order, raises. With ``keep_errors`` an exception is
    a step's result instead.

    Each step only waits for its own jobs, so small ones need not queue behind
    each other. All steps are finished when this returns or raises.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    if keep_errors:
        return [step.exception() or step.result() for step in running]
    return [step.result() for step in running]
