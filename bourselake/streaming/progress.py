"""What a running stream tells: publish-to-write delays of its batches, and when it has come far enough to be stopped."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.values import ZONE, publish_delay_seconds

DELAYS = "records long, least double, mean double, most double"


def write_delays(done: DataFrame, time: str, path: str, run: str, batch: int, zone: str = ZONE, now: Column | None = None) -> dict:
    """Writes each record's key columns and delay from `time` to `now`, and counts the batch's delays on the way.

    The rows are in `path`/run=…/batch=…; records, least, mean and most of them in `path`_batches, a row per batch.
    """
    seen = Observation("delays")
    delays = done.select("disclosure_index", time, publish_delay_seconds(F.col(time), F.current_timestamp() if now is None else now, zone).alias("delay_seconds"))
    counted = delays.observe(seen, F.count("*").alias("records"), *[f("delay_seconds").cast("double").alias(n) for f, n in ((F.min, "least"), (F.avg, "mean"), (F.max, "most"))])
    counted.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch}")
    row = seen.get
    found = done.sparkSession.createDataFrame([tuple(row.get(f.split()[0]) for f in DELAYS.split(", "))], DELAYS)
    found.coalesce(1).write.mode("overwrite").parquet(f"{path}_batches/run={run}/batch={batch}")
    return row


class Progress(StreamingQueryListener):
    """Hears every batch of one query: its input rows so far, and whether `enough` of them says that it may stop."""

    def __init__(self, enough: Callable[[int, dict], bool]):
        self.enough, self.rows, self.batches, self.observed = enough, 0, 0, []
        self.reached, self.id = threading.Event(), None

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if self.id not in (None, str(progress.id)):
            return
        self.rows += progress.numInputRows
        self.batches += progress.numInputRows > 0
        observed = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        self.observed.append(observed)
        if self.enough(self.rows, observed):
            self.reached.set()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.reached.set()


def run_until(spark: SparkSession, start: Callable[[], StreamingQuery], enough: Callable[[int, dict], bool], seconds: float, meanwhile: Callable[[Progress], None] | None = None) -> Progress:
    """Starts a query that doesn't end by itself and stops it, between two batches, once its input rows are `enough`; after
    `seconds` in any case. `meanwhile` is called while it runs. What fails in the query is raised."""
    heard = Progress(enough)
    spark.streams.addListener(heard)
    query = start()
    heard.id = str(query.id)
    try:
        if meanwhile:
            meanwhile(heard)
        heard.reached.wait(seconds)
        query.processAllAvailable()
    finally:
        query.stop()
        spark.streams.removeListener(heard)
    if query.exception():
        raise query.exception()
    return heard
