"""Attempts per key as a stream: each key is tried once, after a failure again when a pause is over, three times in all.

State and timers are those of `transformWithState`, so the session needs the RocksDB state store (`use_timers`). Time is
event time: a timer fires once the watermark has passed it, so a stream that reads what has landed ends. The state of a
key is dropped `keep` after its last event; a key that was given up is left to the backfill.

Each call on state is a message between the worker and the JVM. So keys are dealt into groups by hash, and a group's state
is one value with a row per key: read and written once per batch that has events of it, with a timer for what is due first.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MAX_FAILURES, PAUSE_SECONDS, KEEP_SECONDS = 3, 300, 86_400
GROUPS = 256  # of keys; a stream keeps the number that it was started with
NO_KEY = -1
STATE = "keys array<long>, attempts array<int>, status array<string>, next_try array<long>, ends array<long>, rows array<string>, timer long"
OUTPUT = "key long, attempts int, status string, next_try long, row string"
TRY, WAITING, DONE, GIVEN_UP = "try", "waiting", "done", "given_up"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_timers(spark: SparkSession) -> None:
    """State with timers needs this store; a stream keeps the one that it was started with."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class Attempts(StatefulProcessor):
    """Events of a group's keys, in order of time: listed (`ok` null), tried with success, tried without."""

    def __init__(self, most: int, pause: float, keep: float):
        self.most, self.pause, self.keep = most, int(pause * 1e6), int(keep * 1e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("attempts_by_group", STATE)

    def _held(self) -> tuple[dict, int | None]:
        """Every key's (attempts, status, next_try, ends, row), and the group's next timer."""
        held = self.state.get()
        return ({key: known for key, *known in zip(*held[:-1])}, held[-1]) if held else ({}, None)

    def _hold(self, keys: dict, timer: int | None) -> None:
        """Keeps the state, with a timer at the first millisecond at which something is due. A later one that was set
        before stays and finds nothing due."""
        if not keys:
            self.state.clear()
            return
        due = min((_ms(t) for _, status, next_try, ends, _ in keys.values() for t in (ends, next_try if status == WAITING else None) if t is not None), default=None)
        if due is not None and (timer is None or due < timer):
            self.handle.registerTimer(due)
            timer = due
        self.state.update((list(keys), *map(list, zip(*keys.values())), timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        keys, timer = self._held()
        events, out, stale = [], [], False
        for part in rows:
            events.extend(zip(*(part[c].tolist() for c in ("key", "micros", "ok", "row"))))
        events.sort(key=lambda e: e[:2])
        for one, of_key in itertools.groupby(events, key=lambda e: e[0]):
            attempts, status, next_try, ends, kept = keys.get(one, (0, None, None, None, None))
            before = attempts, status
            for _, time, ok, row in of_key:
                if status in (DONE, GIVEN_UP):
                    continue
                if ok is None:
                    if status is None:
                        status, kept = TRY, row  # an attempt is under way until its outcome comes
                    continue
                attempts += not ok
                status, next_try = (DONE, None) if ok else (GIVEN_UP, None) if attempts >= self.most else (WAITING, time + self.pause)
            changed = (attempts, status) != before
            if changed or ends is None or time + self.keep // 2 > ends:  # a key that is listed again and again moves its end now and then
                keys[one] = attempts, status, next_try, time + self.keep, None if status in (DONE, GIVEN_UP) else kept
                stale = True
            if changed:
                out.append((one, attempts, status, next_try, kept if status == TRY else None))
        if stale:
            self._hold(keys, timer)
        yield from self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Whatever the watermark has passed is due; what comes next is after it."""
        now, (keys, timer) = timerValues.getCurrentWatermarkInMs(), self._held()
        if timer is None or timer > now:
            return
        out = []
        for one, (attempts, status, next_try, ends, row) in list(keys.items()):
            ended = ends is not None and _ms(ends) <= now
            if status == WAITING and _ms(next_try) <= now and not (ended and _ms(ends) <= _ms(next_try)):
                keys[one] = attempts, TRY, None, ends, row
                out.append((one, attempts, TRY, None, row))
            if ended:
                del keys[one]
        self._hold(keys, None)
        yield from self._frame(key, out)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        """Keys that are done; each is kept until it is listed, and then as others are."""
        keys, timer = self._held()
        for of_group in initialState["keys"]:
            keys.update((int(one), (0, DONE, None, None, None)) for one in of_group)
        self._hold(keys, timer)

    def _frame(self, key: tuple, out: list[tuple]) -> list[pd.DataFrame]:
        frame = pd.DataFrame(out, columns=["key", "attempts", "status", "next_try", "row"], dtype=object)
        return [frame.assign(key=None) if key[0] == NO_KEY else frame] if out else []

    def close(self) -> None:
        pass


def _ms(micros: int) -> int:
    """The first millisecond that isn't before."""
    return -(-micros // 1000)


def _dealt(rows: DataFrame, groups: int, *columns) -> DataFrame:
    """Rows without a key are a group of their own, as pandas has no whole numbers beside nulls."""
    key = F.col("key").cast("long")
    group = F.when(key.isNull(), F.lit(NO_KEY).cast("long")).otherwise(F.pmod(F.xxhash64(key), F.lit(groups)))
    return rows.select(group.alias("key_group"), F.coalesce(key, F.lit(0)).alias("key"), *columns)


def attempts(events: DataFrame, most: int = MAX_FAILURES, pause: float = PAUSE_SECONDS, keep: float = KEEP_SECONDS, written: DataFrame | None = None, groups: int = GROUPS) -> DataFrame:
    """Stream of (key long, time timestamp with a watermark, ok boolean or null, row string) to the keys that changed.
    Keys in `written` (column key) are done when the stream begins.

    status: try (now; `row` is what the key was listed with), waiting (until next_try), done or given_up. An event that
    comes after success or the last failure, or lists a key again, changes nothing. A stream has to go on with the same
    number of `groups`; a task holds the keys of one at a time, so a stream of very many keys wants more of them.
    """
    known = None if written is None else _dealt(written, groups).groupBy("key_group").agg(F.collect_set("key").alias("keys")).groupBy("key_group")
    dealt = _dealt(events, groups, "time", F.unix_micros("time").alias("micros"), "ok", "row").groupBy("key_group")
    out = dealt.transformWithStateInPandas(Attempts(most, pause, keep), OUTPUT, "append", "eventTime", initialState=known)
    return out.withColumn("next_try", F.timestamp_micros("next_try"))
