"""Live watch: appends each new disclosure of a watchlist once its page and attachments are landed.

Page and attachments may land after the listing row: such a row is tried again, see `append_until_done`.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.listing import list_fields, on_watchlist
from ..operators.records import records
from ..sources.keys import KeyTable
from ..sources.listing import read_watchlist, stream_listing
from ..sources.pages import parse_pages, read_pages
from ..sources.records import write_batch
from ..sources.tables import checkpoint as cut
from ..streaming.progress import write_delays
from ..streaming.retry import PAUSE_SECONDS
from ..streaming.watch import append_until_done, catch_up


def run(spark: SparkSession, landed: str, out: str, checkpoint: str, start: datetime.datetime, url_template: str, results: str, trigger: dict | None = None, pause: float = PAUSE_SECONDS) -> StreamingQuery:
    """Records go to `out`, their keys to the table beside it (KeyTable), publish-to-write delays to `out`_delays."""
    rows = list_fields(stream_listing(spark, f"{landed}/listing"), url_template)
    rows = catch_up(on_watchlist(rows, read_watchlist(spark, f"{landed}/watchlist"), F.col("stock_code"), F.col("related_stocks"), "disclosure_index"), "publish_date", start)
    keys = KeyTable(spark, out)
    keys.repair()
    recent = keys.read().where(F.col("day").isNull() | (F.col("day") >= F.lit(start.date() - datetime.timedelta(days=1))))

    def build(new: DataFrame) -> DataFrame:
        pages = read_pages(spark, f"{landed}/pages").join(new.select("disclosure_index"), "disclosure_index", "left_semi")
        return records(new, cut(parse_pages(pages)), spark.read.parquet(results))

    def write(done: DataFrame, run: str, number: int) -> None:
        write_batch(done.coalesce(4), out, run, number)
        keys.add(done, run, number)
        write_delays(done, "publish_date", f"{out}_delays", run, number)

    return append_until_done(rows, "disclosure_index", build, write, checkpoint, trigger, F.col("publish_date"), pause=pause, written=recent.select(F.col("disclosure_index").alias("key")))
