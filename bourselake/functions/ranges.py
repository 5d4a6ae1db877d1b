"""Day ranges: months of a range, equal parts, names of ranges, membership."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_ranges(ranges: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Each closed range cut at month ends, as `first` and `last`, `newest` counting from the newest; start > end gives none."""
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))
    out = ranges.where(F.col(start) <= F.col(end)).select("*", F.posexplode(F.reverse(months)).alias("newest", "_month"))
    return out.select(*ranges.columns, "newest", F.greatest("_month", start).alias("first"), F.least(F.last_day("_month"), end).alias("last"))


def equal_parts(ranges: DataFrame, parts: int, start: str = "start", end: str = "end") -> DataFrame:
    """Each closed range in `parts` day-aligned parts, as near to equal as days allow; an empty part has last < first."""
    days = F.datediff(end, start) + 1
    at = lambda i: F.date_add(start, F.floor(days * i / parts).cast("int"))
    out = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    return out.select(*ranges.columns, "part", at(F.col("part")).alias("first"), F.date_sub(at(F.col("part") + 1), 1).alias("last"))


def range_id(first: Column, last: Column) -> Column:
    return F.concat_ws("_", F.date_format(first, "yyyy-MM-dd"), F.date_format(last, "yyyy-MM-dd"))


def in_date_range(time: Column, first: datetime.date, last: datetime.date) -> Column:
    """Whether the day of `time` lies in the closed range, written so that files can be pruned."""
    return (time >= F.lit(first).cast("timestamp_ntz")) & (time < F.lit(last + datetime.timedelta(days=1)).cast("timestamp_ntz"))


def since(time: Column, start: datetime.datetime, catch_up_minutes: int = 10) -> Column:
    """Whether `time` is not before the start less the catch-up minutes."""
    return time >= F.lit(start - datetime.timedelta(minutes=catch_up_minutes)).cast("timestamp_ntz")
