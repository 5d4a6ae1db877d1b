"""History backfill: all disclosures of a watchlist in a range of days that aren't written yet, in bounded rounds."""

from __future__ import annotations

import argparse
import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranges import in_date_range
from ..operators.listing import list_fields, month_counts, on_watchlist
from ..operators.records import records
from ..operators.resume import completeness, in_rounds, missing_keys
from ..sources.keys import KeyTable
from ..sources.listing import failed_lists, quarantine, read_lists, read_watchlist
from ..sources.pages import parse_pages, read_pages
from ..sources.records import write_batch
from ..sources.tables import checkpoint


def listed(listing: DataFrame, watchlist: DataFrame, first: datetime.date, last: datetime.date, url_template: str) -> DataFrame:
    rows = list_fields(listing, url_template).where(in_date_range(F.col("publish_date"), first, last))
    return on_watchlist(rows, watchlist, F.col("stock_code"), F.col("related_stocks"), "disclosure_index").dropDuplicates(["disclosure_index"])


class Backfill:
    """One range of days: what is listed, what of it is written, and the rounds that write the rest.

    Records go to a folder per run and round, their keys to the table beside them (KeyTable). by_day: lists lie in
    folders ``day=yyyy-MM-dd``, of which only those of the range are read.
    """

    def __init__(self, spark: SparkSession, landed: str, out: str, first: datetime.date, last: datetime.date, url_template: str, by_day: bool = False):
        self.spark, self.landed, self.out = spark, landed, out
        self.first, self.last, self.url_template, self.by_day = first, last, url_template, by_day
        self.run, self.keys = f"backfill-{uuid.uuid4().hex}", KeyTable(spark, out)
        self.keys.repair()
        self.list_again()

    def list_again(self) -> DataFrame:
        """Reads what is listed by now."""
        lists = read_lists(self.spark, f"{self.landed}/listing", (self.first, self.last) if self.by_day else None)
        self.failed = checkpoint(failed_lists(lists))
        listing, _ = quarantine(lists.where("not failed").drop("file", "failed"))
        self.rows = checkpoint(listed(listing, read_watchlist(self.spark, f"{self.landed}/watchlist"), self.first, self.last, self.url_template))
        return self.rows

    def written(self) -> DataFrame:
        return self.keys.read()

    def months(self) -> DataFrame:
        """month, listed, to_fetch, newest first."""
        there = self.written().select("disclosure_index").distinct().withColumn("_there", F.lit(1))
        return month_counts(self.rows.join(there, "disclosure_index", "left"), "publish_date", F.col("_there").isNull()).orderBy(F.desc("month"))

    def process(self, todo: DataFrame, results: DataFrame, number: int = 0) -> None:
        """Writes what is complete, newest first within each file, and then its keys."""
        pages = read_pages(self.spark, f"{self.landed}/pages").join(todo.select("disclosure_index"), "disclosure_index", "left_semi")
        done = checkpoint(records(todo, checkpoint(parse_pages(pages)), results).sortWithinPartitions(F.desc("publish_date")))
        write_batch(done, self.out, self.run, number)
        self.keys.add(done, self.run, number)

    def rounds(self, results: Callable[[], DataFrame], most: int, wait: float = 0) -> int:
        """Writes what is complete and not written, then up to `most` times, `wait` seconds apart, what has been listed and
        has landed since; the number of rows left."""
        return in_rounds(self.list_again, self.written, lambda todo, n: self.process(todo, results(), n), most, wait=wait, failed_lists=lambda: self.failed.count())

    def missing(self) -> DataFrame:
        return missing_keys(self.rows, self.written())

    def report(self) -> DataFrame:
        """One row: listed, missing, failed_lists, complete (nothing is missing and every list could be read)."""
        failed = self.failed.count()
        return completeness(self.rows, self.written()).select("listed", "missing", F.lit(failed).cast("long").alias("failed_lists"), (F.col("complete") & F.lit(failed == 0)).alias("complete"))


def run(spark: SparkSession, landed: str, out: str, first: datetime.date, last: datetime.date, url_template: str, results: DataFrame, rounds: int = 0) -> DataFrame:
    """Writes what is complete and not written, then up to `rounds` times what has landed since; the completeness report."""
    job = Backfill(spark, landed, out, first, last, url_template)
    job.rounds(lambda: results, rounds)
    return completeness(job.rows, job.written())


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("landed", "out", "results", "url_template"):
        parser.add_argument(f"--{name}", required=True)
    for name in ("start", "end"):
        parser.add_argument(f"--{name}", type=datetime.date.fromisoformat, required=True)
    parser.add_argument("--rounds", type=int, default=3)
    parser.add_argument("--wait", type=float, default=300, help="seconds between rounds")
    parser.add_argument("--by_day", action="store_true", help="lists lie in folders day=yyyy-MM-dd")
    parser.add_argument("--missing", help="where to write the missing keys, in order")
    a = parser.parse_args()
    spark = SparkSession.builder.appName("backfill").getOrCreate()
    job = Backfill(spark, a.landed, a.out, a.start, a.end, a.url_template, a.by_day)
    job.months().show(1000)
    job.rounds(lambda: spark.read.parquet(a.results), a.rounds, a.wait)
    job.report().show(truncate=False)
    if a.missing:
        job.missing().write.mode("overwrite").json(a.missing)


if __name__ == "__main__":
    main()
