"""Streams: attempts with timers, batches that are done again, keys beside records, delays and stops."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from bourselake.operators import resume
from bourselake.sources import keys, records
from bourselake.streaming import progress, retry, watch

EVENT = "key long, time timestamp, ok boolean, row string"
AT = datetime.datetime(2024, 1, 1, 12)


def minutes(n):
    return AT + datetime.timedelta(minutes=n)


class Attempted:
    """A stream of attempts that goes on from its checkpoint with every call."""

    def __init__(self, spark, tmp_path, **more):
        self.spark, self.path, self.more, self.out = spark, str(tmp_path), more, []
        retry.use_timers(spark)

    def __call__(self, *events):
        self.spark.createDataFrame([(*e, None)[:4] if len(e) == 3 else e for e in events], EVENT).coalesce(1).write.mode("append").parquet(f"{self.path}/in")
        stream = self.spark.readStream.schema(EVENT).parquet(f"{self.path}/in").withWatermark("time", "0 seconds")
        got = []
        write = lambda rows, n: got.extend((r.key, r.status, r.attempts, r.row) for r in rows.collect())
        query = retry.attempts(stream, **self.more).writeStream.foreachBatch(write).option("checkpointLocation", f"{self.path}/state").trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        self.states = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        return sorted(got, key=str)


def test_attempts_follow_timers_and_state_goes(spark, tmp_path):
    run = Attempted(spark, tmp_path, keep=3600)
    assert run((1, minutes(0), None, "one"), (2, minutes(0), None, "two"), (1, minutes(0), None, "again")) == [(1, "try", 0, "one"), (2, "try", 0, "two")]
    assert run((1, minutes(1), False), (2, minutes(1), True)) == [(1, "waiting", 1, None), (2, "done", 0, None)]
    assert run((9, minutes(4), None, "x")) == [(9, "try", 0, "x")]  # five minutes aren't over
    assert run((9, minutes(7), True), (2, minutes(7), False)) == [(1, "try", 1, "one"), (9, "done", 0, None)]
    assert run((1, minutes(8), False), (1, minutes(14), False), (1, minutes(15), True)) == [(1, "given_up", 3, None)]
    held = run.states
    assert run((8, minutes(200), None, "y")) == [(8, "try", 0, "y")]
    assert run.states < held  # keys 1, 2 and 9 ended an hour after their last events


def test_keys_that_are_written_are_not_tried(spark, tmp_path):
    run = Attempted(spark, tmp_path, written=spark.createDataFrame([(1,), (1,), (3,)], "key int"))
    assert run((1, minutes(0), None, "one"), (2, minutes(0), None, "two")) == [(2, "try", 0, "two")]
    assert run((3, minutes(1), None, "three"), (2, minutes(1), True)) == [(2, "done", 0, None)]


def test_keys_of_a_group_have_their_own_timers(spark, tmp_path):
    run = Attempted(spark, tmp_path, keep=3600, groups=1, written=spark.createDataFrame([(5,)], "key long"))
    assert run((1, minutes(0), None, "one"), (2, minutes(0), None, "two"), (5, minutes(0), None, "five"), (None, minutes(0), None, "none")) == [(1, "try", 0, "one"), (2, "try", 0, "two"), (None, "try", 0, "none")]
    assert run((1, minutes(1), False), (2, minutes(3), False), (None, minutes(3), True)) == [(1, "waiting", 1, None), (2, "waiting", 1, None), (None, "done", 0, None)]
    assert run((9, minutes(7), None, "x")) == [(1, "try", 1, "one"), (9, "try", 0, "x")]
    assert run((9, minutes(9), True)) == [(2, "try", 1, "two"), (9, "done", 0, None)]
    assert run.states == 2  # one value holds all keys, another those without a key
    assert run((1, minutes(65), False), (1, minutes(65), None, "one")) == [(1, "waiting", 2, None)]  # 5, 2 and the one without a key have ended
    assert run((8, minutes(69), None, "y"), (2, minutes(69), None, "new")) == [(2, "try", 0, "new"), (8, "try", 0, "y")]
    assert run((8, minutes(200), True)) == [(1, "try", 2, "one"), (8, "done", 0, None)]
    assert run.states == 1


def test_a_batch_done_again_replaces_what_it_wrote(spark, tmp_path, monkeypatch):
    """The stream dies after a batch's records and before its keys; the next run does the batch again."""
    path, out = str(tmp_path), str(tmp_path / "out")
    table = keys.KeyTable(spark, out, buckets=4)
    spark.createDataFrame([(i, "t") for i in range(6)], "disclosure_index long, title string").coalesce(1).write.parquet(f"{path}/in")
    stream = lambda: spark.readStream.schema("disclosure_index long, title string").parquet(f"{path}/in")
    fail = [True]

    def write(done, run, number):
        records.write_batch(done, out, run, number)
        if fail.pop() if fail else False:
            raise OSError("lost")
        table.add(done, run, number)

    start = lambda: watch.append_until_done(stream(), "disclosure_index", lambda due: due.where("disclosure_index <> 5"), write, f"{path}/state", pause=0)
    with pytest.raises(Exception, match="lost"):
        start().awaitTermination(120)
    start().awaitTermination(120)
    lines = lambda: sorted(json.loads(r.value)["disclosure_index"] for r in spark.read.text(out, recursiveFileLookup=True).collect())
    assert lines() == [0, 1, 2, 3, 4] == sorted(r.disclosure_index for r in table.read().collect())
    before = sorted(spark.read.text(out, recursiveFileLookup=True).inputFiles())
    start().awaitTermination(120)  # key 5 is tried again and fails; no key that is done comes back
    assert lines() == [0, 1, 2, 3, 4] and {*before} <= {*spark.read.text(out, recursiveFileLookup=True).inputFiles()}


def test_a_batch_is_not_broadcast(spark, tmp_path):
    """Rows that timers bring are planned as none, however many they are."""
    path, plans, tried = str(tmp_path), [], []
    rows = spark.createDataFrame([(i,) for i in range(4)], "disclosure_index long")
    rows.where("disclosure_index > 1").write.parquet(f"{path}/landed")

    def build(due):
        done = due.join(spark.read.parquet(f"{path}/landed"), "disclosure_index")
        tried.append(sorted(r[0] for r in due.collect()))
        plans.append(done._jdf.queryExecution().executedPlan().toString())
        return done

    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        watch.append_until_done(stream, "disclosure_index", build, lambda done, *_: done.collect(), f"{path}/state", pause=0).awaitTermination(120)
    assert [0, 1, 2, 3] in tried and [0, 1] in tried and not any("Broadcast" in p for p in plans)


def test_key_table_is_not_shuffled_and_heals(spark, tmp_path):
    out = str(tmp_path / "out")
    table = keys.KeyTable(spark, out, buckets=8)
    assert table.read().count() == 0 and table.repair() == 0
    rows = spark.range(100).select(F.col("id").alias("disclosure_index"), F.lit("2026-10-08 09:15:00").cast("timestamp_ntz").alias("publish_date"))
    for number in range(3):
        records.write_batch(rows.where(F.col("disclosure_index") % 3 == number), out, "a", number)
        if number != 1:  # the job was lost between the records and the keys of its second batch
            table.add(rows.where(F.col("disclosure_index") % 3 == number), "a", number)
            table.add(rows.where(F.col("disclosure_index") % 3 == number), "a", number)
    assert table.read().count() == 67 and table.repair() == 1 and table.repair() == 0
    assert table.read().count() == table.read().select("disclosure_index").distinct().count() == 100
    assert table.read().where("day = date '2026-10-08'").count() == 67
    spark.sql(f"DROP TABLE {table.name}")
    table = keys.KeyTable(spark, out, buckets=8)  # another session finds the files
    listed = spark.range(90, 120).withColumnRenamed("id", "disclosure_index")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo = resume.not_written(listed, table.read())
        plan = todo._jdf.queryExecution().executedPlan().toString()
        missing = resume.completeness(listed, table.read())
        assert sorted(r.disclosure_index for r in todo.collect()) == [*range(100, 120)] and tuple(missing.first()) == (30, 20, False)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan  # of the listed side alone


def test_delays_are_observed(spark, tmp_path):
    path = str(tmp_path / "delays")
    rows = spark.sql("select id as disclosure_index, cast(from_utc_timestamp(current_timestamp(), 'Europe/Istanbul') as timestamp_ntz) - make_dt_interval(0, 0, 0, 60 * id) as publish_date from range(1, 4)")
    row = progress.write_delays(rows, "publish_date", path, "a", 0)
    assert row["records"] == 3 and 60 <= row["least"] < 90 and 180 <= row["most"] < 210
    progress.write_delays(rows.limit(0), "publish_date", path, "a", 1)
    assert spark.read.parquet(path).count() == 3
    batches = {r.batch: r for r in spark.read.parquet(f"{path}_batches").collect()}
    assert batches[0].records == 3 and batches[1].records == 0 and batches[1].most is None


def test_a_running_stream_flushes_and_is_stopped(spark, tmp_path):
    path = str(tmp_path)
    land = lambda a, b: spark.range(a, b).coalesce(1).write.mode("append").parquet(f"{path}/in")
    land(0, 10)
    stream = spark.readStream.schema("id long").parquet(f"{path}/in").observe("flushed", F.count("*").alias("rows"))
    start = lambda: stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(processingTime="1 second").start(f"{path}/out")
    heard = progress.run_until(spark, start, lambda rows, observed: rows >= 30, 60, lambda heard: land(10, 30))
    assert heard.rows == 30 and heard.batches >= 1 and sum(o["flushed"]["rows"] for o in heard.observed if o) == 30
    assert spark.read.parquet(f"{path}/out").count() == 30 and not [q for q in spark.streams.active if q.isActive]
