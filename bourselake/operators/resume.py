"""Resuming: what is not written yet, what is missing at the end, bounded rounds."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "disclosure_index"


def not_written(listed: DataFrame, written: DataFrame, key: str = KEY) -> DataFrame:
    """Listed rows whose key isn't written; only keys of the written side are read."""
    return listed.join(written.select(key), key, "left_anti")


def distinct_keys(rows: DataFrame, key: str = KEY) -> DataFrame:
    return rows.select(key).distinct()


def attempt_counts(failures: DataFrame, key: str = KEY, most: int = 3) -> DataFrame:
    """key, attempts, given_up."""
    return failures.groupBy(key).agg(F.count("*").alias("attempts")).withColumn("given_up", F.col("attempts") >= most)


def completeness(listed: DataFrame, written: DataFrame, key: str = KEY) -> DataFrame:
    """One row: listed, missing, complete. The missing keys themselves are `missing_keys`, a distributed table."""
    state = distinct_keys(listed, key).join(distinct_keys(written, key).withColumn("_there", F.lit(1)), key, "left")
    return state.agg(F.count("*").alias("listed"), F.count_if(F.col("_there").isNull()).alias("missing"), (F.count_if(F.col("_there").isNull()) == 0).alias("complete"))


def missing_keys(listed: DataFrame, written: DataFrame, failures: DataFrame | None = None, key: str = KEY) -> DataFrame:
    """The keys that are listed and not written, in order; with attempts and given_up (see attempt_counts) of `failures`."""
    missing = distinct_keys(not_written(listed, written, key), key)
    if failures is not None:
        missing = missing.join(attempt_counts(failures, key), key, "left").select(key, F.coalesce("attempts", F.lit(0).cast("long")).alias("attempts"), F.coalesce("given_up", F.lit(False)).alias("given_up"))
    return missing.orderBy(key)


def in_rounds(
    listed: Callable[[], DataFrame], written: Callable[[], DataFrame], process: Callable[[DataFrame, int], None], rounds: int = 3, key: str = KEY,
    wait: float = 0, failed_lists: Callable[[], int] = lambda: 0, pause: Callable[[float], None] = time.sleep,
) -> int:
    """Processes what isn't written, then up to `rounds` times more what is left; the number of rows left.

    Before each further round it waits `wait` seconds and lists again, so that what has landed since is seen; it goes on
    while rows are left or lists couldn't be read.
    """
    for n in range(rounds + 1):
        if n:
            pause(wait)
        todo = not_written(listed(), written(), key)
        if not todo.isEmpty():
            process(todo, n)
        elif not failed_lists():
            return 0
    return not_written(listed(), written(), key).count()
