"""Several fits at once: a bounded number of driver threads, a scheduler pool for each."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
IN_FLIGHT = 8
#: Bytes that a row takes in a fit of trees (its objects, sample, residual and the predictions before and
#: after a tree), and each of its slots.
ROW_BYTES, SLOT_BYTES = 240, 4
#: The same of a fit over binned blocks, which keeps a code for each feature.
BLOCK_ROW_BYTES = 40


def cache_room(spark: SparkSession) -> int:
    """Bytes that the executors may cache. The driver's share is not named: the largest is left out."""
    shares = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    rooms = []
    while shares.hasNext():
        rooms.append(int(shares.next()._1()))
    return rooms[0] if len(rooms) == 1 else sum(rooms) - max(rooms)


def fits_in_memory(spark: SparkSession, rows: int, slots: int, in_flight: int = IN_FLIGHT, row_bytes: int = ROW_BYTES) -> int:
    """How many of ``in_flight`` fits may run side by side with what they cache in memory, one at least.

    Each fit caches its own rows and reads them at every step: rows that go to disk cost more than
    fits that wait, and large fits fill the executors one by one.
    """
    need = rows * (row_bytes + SLOT_BYTES * slots)
    return max(1, min(in_flight, cache_room(spark) // max(1, need)))


def run_together(spark: SparkSession, jobs: Sequence[Callable[[], T]], in_flight: int = IN_FLIGHT) -> list[T]:
    """The results of ``jobs`` in their order, at most ``in_flight`` of them running.

    An iterative fit runs many short jobs with a wait on the driver after each; side by side they
    fill the executors. Where the session schedules fairly, each fit has a pool of its own. The
    first failure is raised; what has not begun then is left out.
    """

    def in_pool(number: int, job: Callable[[], T]) -> Callable[[], T]:
        def run() -> T:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{number % in_flight}")
            return job()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max(1, min(in_flight, len(jobs)))) as threads:
        running = [threads.submit(in_pool(i, job)) for i, job in enumerate(jobs)]
        done, waiting = wait(running, return_when=FIRST_EXCEPTION)
        for future in waiting:
            future.cancel()
        for future in done:
            if future.exception():
                raise future.exception()
        return [future.result() for future in running]
