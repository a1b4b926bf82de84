"""Running independent Spark jobs side by side."""

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def side_by_side(spark: SparkSession, action: Callable, items: Iterable) -> list:
    """Results of ``action`` per item, in order; the jobs share the executors, so one's tail does not idle them.

    The first failure is raised once all have ended.
    """
    items = list(items)
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(action), item) for item in items]
    return [job.result() for job in started]
