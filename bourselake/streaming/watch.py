"""The live watch: overlapping listing snapshots in, each disclosure out once."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.ranges import since
from ..functions.values import ZONE, publish_delay_seconds
from ..sources.tables import checkpoint as cut
from .retry import GROUPS, KEEP_SECONDS, MAX_FAILURES, PAUSE_SECONDS, TRY, attempts, use_timers

#: A listing shows an item until a minute past the end of its day; nothing is later than that.
LATENESS = "1 day 1 minute"
#: Outcomes of a batch in one file.
OUTCOMES = 1_000_000


def once_each(stream: DataFrame, time: str, key: str, lateness: str = LATENESS, zone: str = ZONE) -> DataFrame:
    """The first of each key's rows. `time` is wall-clock time in `zone`; state is kept as long as rows may be late."""
    if dict(stream.dtypes)[time] == "timestamp_ntz":  # watermarks need instants
        stream = stream.withColumn("event_time", F.to_utc_timestamp(F.col(time).cast("timestamp"), zone))
    else:
        stream = stream.withColumn("event_time", F.col(time))
    return stream.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark([key]).drop("event_time")


def catch_up(stream: DataFrame, time: str, start: datetime.datetime, minutes: int = 10) -> DataFrame:
    return stream.where(since(F.col(time), start, minutes))


def append_once(stream: DataFrame, key: str, written: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None, order: Column | None = None) -> StreamingQuery:
    """Appends rows whose key isn't written yet, oldest first within a batch if `order` is given.

    Together with the checkpoint this makes a batch that is run again write nothing twice. `trigger`: by default all
    that has landed, then stop; ``{"processingTime": "5 minutes"}`` flushes periodically.
    """

    def batch(rows: DataFrame, number: int) -> None:
        new = rows.dropDuplicates([key]).join(written().select(key), key, "left_anti")
        write(new if order is None else new.orderBy(order), number)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def write_batch(rows: DataFrame, path: str, run: str, batch: int) -> None:
    """A batch's rows in a folder of their own; a batch that is done again replaces them, also by none."""
    rows.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch}")


def there(spark: SparkSession, path: str) -> bool:
    """Whether a table of files has been written."""
    try:
        spark.read.text(f"{path}/_SUCCESS")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream with this checkpoint: made once, and kept beside the checkpoint."""
    path = f"{checkpoint}/run"
    if not there(spark, path):
        spark.createDataFrame([(uuid.uuid4().hex,)], "run string").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("run string").parquet(path).first()[0]


def append_until_done(
    stream: DataFrame, key: str, build: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, str, int], None], checkpoint: str, trigger: dict | None = None,
    order: Column | None = None, most: int = MAX_FAILURES, pause: float = PAUSE_SECONDS, keep: float = KEEP_SECONDS, written: DataFrame | None = None, groups: int = GROUPS,
) -> StreamingQuery:
    """Appends what `build` makes of the rows, each key once; a row of which it makes nothing yet (its page hasn't landed,
    say) is tried again when `pause` seconds are over, `most` times in all. Then it is left to the backfill.

    The stream hears its own outcomes: each batch leaves the keys that it tried in `checkpoint`/outcomes, which the next
    batches read beside the listing, and `retry.attempts` holds every key's row, attempts and timer. So nothing of the
    output is read to find what is due. A key is under way until its outcome is heard, and its state goes `keep` seconds
    after it was last listed. Keys in `written` (column key) are taken as done when the stream begins. Time is that of the
    batch: timers need batches to go on, and those come with every listing snapshot, also with one that has nothing new.
    Joins in `build` broadcast only what it marks with `broadcast`, as nothing tells the size of a batch before it is made.
    A batch that is done again tries the same keys, and `write` gets the same run and number, to replace what it wrote.
    """
    spark, outcomes, schema = stream.sparkSession, f"{checkpoint}/outcomes", stream.schema
    use_timers(spark)
    run = run_name(spark, checkpoint)
    if not there(spark, f"{outcomes}/none"):  # kept as it is: a batch that is done again reads the same files
        spark.createDataFrame([], "key long, ok boolean").coalesce(1).write.mode("overwrite").parquet(f"{outcomes}/none")
    listed = stream.select(F.col(key).alias("key"), F.lit(None).cast("boolean").alias("ok"), F.to_json(F.struct(*stream.columns)).alias("row"))
    heard = spark.readStream.schema("key long, ok boolean").option("recursiveFileLookup", True).parquet(outcomes).withColumn("row", F.lit(None).cast("string"))
    events = listed.unionByName(heard).withColumn("time", F.current_timestamp()).withWatermark("time", "0 seconds")

    def batch(changes: DataFrame, number: int) -> None:
        # rows that timers bring are planned as none, so a join would send them all through the driver
        changes.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        due = cut(changes.where(F.col("status") == TRY).select(F.from_json("row", schema).alias("row")).select("row.*"))
        rows = due.count()
        if not rows:
            return
        done = cut(build(due))
        write(done if order is None else done.orderBy(order), run, number)
        tried = due.select(F.col(key).alias("key")).join(done.select(F.col(key).alias("key"), F.lit(True).alias("ok")), "key", "left")
        write_batch(tried.select("key", F.coalesce("ok", F.lit(False)).alias("ok")).repartition(1 + rows // OUTCOMES), outcomes, run, number)

    changes = attempts(events, most, pause, keep, written, groups)
    return changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def write_delay(rows: DataFrame, time: str, now: Column, zone: str = ZONE) -> DataFrame:
    return rows.withColumn("delay_seconds", publish_delay_seconds(F.col(time), now, zone))
