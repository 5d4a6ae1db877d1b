"""Line dedup that can be taken back: exact reference counts of lines, with sharded cuckoo filters in front of them.

A line's key is the 128-bit hash of the line, stripped and in lower case. An index is a folder of tables; every insertion
or deletion of documents is a batch that appends to them and counts once its commit is written, so one that is lost half
way is written again:

- postings: which document holds which key, with sign -1 for what a deletion takes back;
- refs: of every key that a batch changed, how many documents hold it, and the largest of them (the keeper);
- filters: cuckoo filters of the keys that a batch brought in (`held`) and of those that it made frequent (`repeated`),
  sharded by the hash so that a filter has about `SHARD_KEYS` keys. A key's row in refs says which batch's filter holds
  it, so a deletion takes the right fingerprint out, and the filter is written anew.

Keys of new documents go to the filters first: what no filter holds is new, and only the others meet the exact tables.
Deduplication asks the filters of frequent keys while it reads the texts, so only lines that probably repeat are
shuffled; where these filters are too large to send out, all keys meet the exact table. A line of most documents is one
row per task before keys are shuffled.

Defined cases: a null or empty text is one empty line; null doc_ids count as one document, the smallest; rows of one
doc_id are one document; a document inserted again, or deleted without being held, changes nothing; very long texts are
read whole; an empty table gives an empty result; further columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .shared import checkpoint, free_name

LEAST_POINTS, LEAST_DOCUMENTS = 20, 3
#: Keys of a filter; bytes of filters, and rows of frequent keys, that are sent to all tasks at most.
SHARD_KEYS, MAX_FILTER_BYTES, MAX_BROADCAST_KEYS = 1 << 14, 64_000_000, 500_000
KEY = ["high", "low"]
REFS = "high long, low long, refs long, keeper long, held_in int, repeated_in int"


# --- cuckoo filters ---


class Cuckoo:
    """Buckets of four 16-bit fingerprints; a key is in one of two buckets, each of which follows from the other."""

    SLOTS, TURNS, LOAD = 4, 200, 0.85

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray) -> Cuckoo:
        """A filter of distinct keys; it is made larger until all have a place."""
        buckets = 1 << max(1, int(np.ceil(np.log2(max(len(high), 1) / cls.SLOTS / cls.LOAD))))
        while True:
            out = cls(np.zeros((buckets, cls.SLOTS), np.uint16))
            if out._insert(high, low):
                return out
            buckets *= 2

    def _places(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = (low.view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        return mark, (high.view(np.uint64) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, mark: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ (W.mix(mark.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _insert(self, high: np.ndarray, low: np.ndarray) -> bool:
        mark, at = self._places(high, low)
        for turn in range(self.TURNS):
            if not len(mark):
                return True
            order = np.argsort(at, kind="stable")
            mark, at = mark[order], at[order]
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
            free = self.table[at] == 0
            fits = rank < free.sum(axis=1)
            slot = np.argsort(~free[fits], axis=1, kind="stable")[np.arange(fits.sum()), rank[fits]]
            self.table[at[fits], slot] = mark[fits]
            mark, at, rank = mark[~fits], at[~fits], rank[~fits]
            if turn:  # both buckets are full: the first of a bucket's keys takes the place of one that is there
                one = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
                slot = (mark[one].astype(np.int64) + turn) % self.SLOTS
                self.table[at[one], slot], mark[one] = mark[one], self.table[at[one], slot]
            at = self._other(mark, at)
        return not len(mark)

    def holds(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        mark, at = self._places(high, low)
        return ((self.table[at] == mark[:, None]) | (self.table[self._other(mark, at)] == mark[:, None])).any(axis=1)

    def delete(self, high: np.ndarray, low: np.ndarray) -> None:
        """Takes one fingerprint of each key out; all of them must have been inserted."""
        mark, at = self._places(high, low)
        for m, places in zip(mark, np.stack([at, self._other(mark, at)], axis=1), strict=True):
            place = next(p for p in places if m in self.table[p])
            self.table[place, np.flatnonzero(self.table[place] == m)[0]] = 0


class Filters(NamedTuple):
    """Filters of one batch: shard s has the keys of which `high` modulo `shards` is s."""

    shards: int
    tables: dict[int, Cuckoo]

    def holds(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        out, shard = np.zeros(len(high), bool), high % self.shards
        for s in np.unique(shard):
            if s in self.tables:
                out[shard == s] = self.tables[s].holds(high[shard == s], low[shard == s])
        return out


# --- lines ---


class Lines(NamedTuple):
    """Lines of a slice of rows: line i of row[i] is text.data[starts[i]:ends[i]], stripped data[first[i]:last[i]]."""

    data: np.ndarray
    row: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray
    points: np.ndarray

    def keys(self) -> tuple[np.ndarray, list[bytes]]:
        """The lines that are long enough, and their keys."""
        long = np.flatnonzero(self.points >= LEAST_POINTS)
        data = self.data.tobytes()
        return long, [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(self.first[long].tolist(), self.last[long].tolist(), strict=True)]


def lines(t: W.Texts) -> Lines:
    data, offsets = W.LOWER[t.data], t.offsets
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(offsets, breaks, side="right") - 1
    every = np.append(np.arange(len(offsets) - 1), row)
    order = np.lexsort((np.append(offsets[:-1], breaks + 1), every))
    starts = np.append(offsets[:-1], breaks + 1)[order]
    ends = np.append(offsets[1:], breaks)[np.lexsort((np.append(offsets[1:], breaks), every))]
    words = np.flatnonzero(W.NOT_SPACE[data])
    bounded = np.append(words, len(data))
    first = np.minimum(bounded[np.searchsorted(words, starts)], ends)
    last = np.maximum(np.append(-1, words)[np.searchsorted(words, ends)] + 1, first)
    points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    return Lines(data, every[order], starts, ends, first, last, points[last] - points[first])


def pairs(docs: DataFrame, among: list[Filters] | None = None) -> DataFrame:
    """high, low, doc_id and row (hash of the text) of each document's distinct keys; `among`: those that a filter holds."""
    sent = docs.sparkSession.sparkContext.broadcast(among) if among is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            found = lines(W.texts(batch.column("text")))
            long, keys = found.keys()
            of = found.row[long]
            key = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2) if keys else np.zeros((0, 2), np.int64)
            order = np.lexsort((key[:, 1], key[:, 0], of))
            key, of = key[order], of[order]
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (key[1:] != key[:-1]).any(axis=1)
            if sent is not None:
                high, low = np.ascontiguousarray(key[:, 0]), np.ascontiguousarray(key[:, 1])
                new &= reduce(np.logical_or, [f.holds(high, low) for f in sent.value], np.zeros(len(of), bool))
            rows = pa.array(of[new])
            yield pa.RecordBatch.from_arrays([pa.array(key[new, 0]), pa.array(key[new, 1]), batch.column("doc_id").take(rows), batch.column("row").take(rows)], [*KEY, "doc_id", "row"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("row")).mapInArrow(run, f"high long, low long, doc_id {dict(docs.dtypes)['doc_id']}, row long")


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their lines whose keys are in `drop`."""
    for batch in W.slices(batches, "text"):
        texts = W.texts(batch.column("text"))
        found = lines(texts)
        drops = batch.column("drop")
        hit = np.asarray(drops.is_valid())
        number = np.bincount(found.row, minlength=batch.num_rows)
        dropped = np.zeros(batch.num_rows, np.int64)
        kept: list[str | None] = batch.column("text").to_pylist() if hit.any() else []
        if hit.any():
            long, keys = found.keys()
            gone = np.zeros(len(found.row), bool)
            at = np.searchsorted(found.row[long], np.arange(batch.num_rows + 1))
            for r in np.flatnonzero(hit):
                of = {*drops[r].as_py()}
                gone[long[at[r] : at[r + 1]]] = [k in of for k in keys[at[r] : at[r + 1]]]
            begins = np.searchsorted(found.row, np.arange(batch.num_rows + 1))
            whole = texts.data.tobytes()
            for r in np.flatnonzero(hit):
                here = np.arange(begins[r], begins[r + 1])
                dropped[r] = gone[here].sum()
                kept[r] = b"\n".join([whole[found.starts[i] : found.ends[i]] for i in here[~gone[here]]]).decode()
        text = pa.array(kept, pa.string()) if hit.any() else batch.column("text")
        rest = [c for c in batch.schema.names if c not in ("text", "drop")]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], text, pa.array(number.astype(np.int64)), pa.array(dropped)], [*rest, "text", "n_lines", "n_dropped"])


# --- the index ---


def _filter_of(keys: pa.Table) -> pa.Table:
    """One filter of a shard's keys."""
    high, low = (keys.column(c).to_numpy() for c in KEY)
    made = Cuckoo.of(high, low)
    first = lambda c: keys.column(c).slice(0, 1)
    return pa.table({"kind": first("kind"), "made_in": first("made_in"), "shards": first("shards"), "shard": first("shard"), "table": [made.table.tobytes()]})


FILTER = "kind string, made_in int, shards int, shard int, table binary"


def _thinned(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """A shard's filter without the keys."""
    table = Cuckoo(np.frombuffer(filters.column("table")[0].as_py(), np.uint16).reshape(-1, Cuckoo.SLOTS).copy())
    table.delete(*(keys.column(c).to_numpy() for c in KEY))
    return filters.set_column(filters.schema.get_field_index("table"), "table", pa.array([table.table.tobytes()]))


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that may be held: each shard's filter comes before the keys that are looked up in it."""
    shard, table = None, None
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1), len(shards)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if shards[a] != shard:
                shard, table = shards[a], None
            if part.column("table")[0].is_valid:
                table = Cuckoo(np.frombuffer(part.column("table")[0].as_py(), np.uint16).reshape(-1, Cuckoo.SLOTS))
                part = part.slice(1)
            high, low = (part.column(c).to_numpy() for c in KEY)
            known = table.holds(high, low) if table is not None else np.zeros(len(high), bool)
            yield pa.RecordBatch.from_arrays([pa.array(high[known]), pa.array(low[known])], KEY)


class LineIndex:
    """The lines of the documents that are held, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, least: int = LEAST_DOCUMENTS, shard_keys: int = SHARD_KEYS):
        self.spark, self.path, self.least, self.shard_keys = spark, path.rstrip("/"), least, shard_keys
        self.batches = self._committed()

    def _committed(self) -> list[int]:
        try:
            commits = self.spark.read.schema("id long, batch int").parquet(f"{self.path}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r.batch for r in commits.select("batch").distinct().collect())  # a row per batch

    def _write(self, rows: DataFrame, name: str, number: int) -> DataFrame:
        path = f"{self.path}/{name}/batch={number}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _commit(self, number: int) -> int:
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={number}")
        self.batches.append(number)
        return number

    def _read(self, name: str, schema: str) -> DataFrame:
        """The rows of all committed batches, with `batch`."""
        parts = [self.spark.read.schema(schema).parquet(f"{self.path}/{name}/batch={b}").withColumn("batch", F.lit(b)) for b in self.batches]
        return reduce(DataFrame.unionAll, parts, self.spark.createDataFrame([], f"{schema}, batch int"))

    def postings(self) -> DataFrame:
        """high, low and doc_id of every line key that a held document has."""
        rows = self._read("postings", "high long, low long, doc_id long, sign int")
        if len(self.batches) == 1:
            return rows.select(*KEY, "doc_id")
        return rows.groupBy(*KEY, "doc_id").agg(F.sum("sign").alias("n")).where("n > 0").drop("n")

    def refs(self) -> DataFrame:
        """The exact table: of every key how many documents hold it (0 where none does any more), and the largest."""
        rows, columns = self._read("refs", REFS), ["refs", "keeper", "held_in", "repeated_in"]
        if len(self.batches) == 1:
            return rows.select(*KEY, *columns)
        last = F.max_by(F.struct(*columns), "batch").alias("last")
        return rows.groupBy(*KEY).agg(last).select(*KEY, *[F.col("last")[c].alias(c) for c in columns])

    def filters(self, kind: str) -> DataFrame:
        """The last version of every filter of a kind."""
        rows = self._read("filters", FILTER).where(F.col("kind") == kind)
        return rows.groupBy("kind", "made_in", "shards", "shard").agg(F.max_by("table", "batch").alias("table"))

    def _build(self, keys: DataFrame, kind: str, number: int) -> DataFrame:
        """Filters of new keys; their number follows the counted keys."""
        shards = max(1, -(-keys.count() // self.shard_keys))
        placed = keys.select(*KEY, F.lit(kind).alias("kind"), F.lit(number).alias("made_in"), F.lit(shards).alias("shards"), F.pmod("high", F.lit(shards)).cast("int").alias("shard"))
        return placed.groupBy("shard").applyInArrow(_filter_of, FILTER)

    def _thin(self, keys: DataFrame, kind: str, made_in: str) -> DataFrame:
        """Filters without the keys, each of which is in the filters of batch `made_in`."""
        old = checkpoint(self.filters(kind))
        shards = self.spark.createDataFrame(old.select("made_in", "shards").distinct().collect(), "made_in int, shards int")
        placed = keys.select(*KEY, F.col(made_in).alias("made_in")).join(F.broadcast(shards), "made_in")  # a row per batch
        placed = placed.withColumn("shard", F.pmod("high", "shards").cast("int"))
        return placed.groupBy("made_in", "shard").cogroup(old.groupBy("made_in", "shard")).applyInArrow(lambda k, f: _thinned(k, f) if k.num_rows and f.num_rows else f.slice(0, 0), FILTER)

    def _maybe_held(self, keys: DataFrame) -> DataFrame:
        """The distinct keys that some filter holds."""
        out = keys.select(*KEY).limit(0)
        stored = checkpoint(self.filters("held"))
        for made_in, shards in stored.select("made_in", "shards").distinct().collect():  # a row per batch
            own = stored.where(F.col("made_in") == made_in).select("shard", "table", F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("low"))
            asked = keys.select(F.pmod("high", F.lit(shards)).cast("int").alias("shard"), F.lit(None).cast("binary").alias("table"), *KEY)
            dealt = own.unionByName(asked).repartition("shard").sortWithinPartitions("shard", F.col("table").isNull())
            out = out.unionByName(dealt.mapInArrow(_probed, "high long, low long"))
        return out.distinct()

    def _counted(self, rows: DataFrame, old: DataFrame | None, number: int) -> DataFrame:
        """REFS of the keys of `old` and of the postings `rows` that they have now; -1: not in a filter."""
        now = rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("most"))
        both = now.join(old, KEY, "full") if old is not None else now.select("*", *[F.lit(None).cast("int").alias(c) for c in ("held_in", "repeated_in")])
        refs = F.coalesce("n", F.lit(0).cast("long"))
        held = F.coalesce("held_in", F.lit(-1))
        repeated = F.coalesce("repeated_in", F.lit(-1))
        return both.select(
            *KEY, refs.alias("refs"), F.col("most").alias("keeper"), F.when(refs == 0, -1).when(held < 0, number).otherwise(held).cast("int").alias("held_in"),
            F.when(refs < self.least, -1).when(repeated < 0, number).otherwise(repeated).cast("int").alias("repeated_in"), held.alias("was_held"), repeated.alias("was_repeated"),
        )

    def _finish(self, changed: DataFrame, number: int) -> int:
        """Writes the exact rows that changed and the filters that follow from them; then the batch counts."""
        changed = self._write(changed, "refs", number)
        made = [self._build(changed.where(f"{k}_in = {number} and was_{k} < 0"), k, number) for k in ("held", "repeated")]
        if self.batches:
            made += [self._thin(changed.where(f"{k}_in < 0 and was_{k} >= 0"), k, f"was_{k}") for k in ("held", "repeated")]
        self._write(reduce(DataFrame.unionByName, made), "filters", number)
        return self._commit(number)

    def insert(self, docs: DataFrame) -> int:
        """Takes documents (doc_id, text) in; the number of the batch."""
        number = max(self.batches, default=-1) + 1
        new = pairs(docs).select(*KEY, F.col("doc_id").cast("long").alias("doc_id")).distinct()
        if not self.batches:
            held = self._write(new.withColumn("sign", F.lit(1)), "postings", number)
            return self._finish(self._counted(held, None, number), number)
        new = checkpoint(new)
        known = checkpoint(self._maybe_held(new.select(*KEY).distinct()))
        there = self.postings().join(known, KEY, "left_semi")
        at = [new[c].eqNullSafe(there[c]) for c in (*KEY, "doc_id")]
        new = self._write(new.join(there, at, "left_anti").withColumn("sign", F.lit(1)), "postings", number)
        touched = new.select(*KEY).distinct()
        old = self.refs().join(known, KEY, "left_semi").join(touched, KEY, "left_semi")
        return self._finish(self._counted(new.select(*KEY, "doc_id").unionByName(there.join(touched, KEY, "left_semi")), old, number), number)

    def remove(self, documents: DataFrame) -> int:
        """Takes the documents with these doc_ids out again; the number of the batch."""
        number = max(self.batches, default=-1) + 1
        ids, held = documents.select(F.col("doc_id").cast("long").alias("_id")).distinct(), self.postings()
        gone = self._write(held.join(ids, held["doc_id"].eqNullSafe(ids["_id"]), "left_semi").withColumn("sign", F.lit(-1)), "postings", number)
        touched = gone.select(*KEY).distinct()
        rest = self.postings().join(touched, KEY, "left_semi")
        at = [rest[c].eqNullSafe(gone[c]) for c in (*KEY, "doc_id")]
        old = self.refs().join(touched, KEY, "left_semi")
        return self._finish(self._counted(rest.join(gone, at, "left_anti"), old, number), number)

    def repeated(self) -> DataFrame:
        """high, low and keeper of the keys that `least` documents hold."""
        return self.refs().where(F.col("refs") >= self.least).select(*KEY, "keeper")

    def _sendable(self) -> list[Filters] | None:
        """The filters of frequent keys, or None where they are too large to send to all tasks."""
        stored = checkpoint(self.filters("repeated"))
        if (stored.agg(F.sum(F.octet_length("table"))).first()[0] or 0) > MAX_FILTER_BYTES:
            return None
        out: dict[int, Filters] = {}
        for r in stored.collect():
            out.setdefault(r.made_in, Filters(r.shards, {})).tables[r.shard] = Cuckoo(np.frombuffer(bytes(r.table), np.uint16).reshape(-1, Cuckoo.SLOTS))
        return [*out.values()]

    def dedup(self, docs: DataFrame) -> DataFrame:
        """The documents, their texts without the lines that `least` held documents have, except in the keeper; with
        n_lines (before) and n_dropped. Documents need not be held. A column of one of these names is replaced."""
        frequent = checkpoint(self.repeated())
        few = F.broadcast if frequent.count() <= MAX_BROADCAST_KEYS else lambda df: df
        met = pairs(docs, self._sendable()).join(few(frequent), KEY)
        key = F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in KEY]))
        drop, of, row = (free_name(docs, n) for n in ("drop", "of", "row"))
        lists = met.where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).groupBy(F.col("doc_id").alias(of), F.col("row").alias(row)).agg(F.collect_set(swapped(key)).alias(drop))
        joined = docs.join(lists, docs["doc_id"].eqNullSafe(F.col(of)) & (F.xxhash64(docs["text"]) == F.col(row)), "left")
        kept = [f for f in docs.schema.fields if f.name.lower() not in ("text", "n_lines", "n_dropped")]
        inner = joined.select(F.struct(*[docs[f.name] for f in kept]).alias("rest"), docs["text"].alias("text"), F.col(drop).alias("drop"))
        schema = f"rest {inner.schema['rest'].dataType.simpleString()}, text string, n_lines long, n_dropped long"
        out = inner.mapInArrow(_rewritten, schema)
        return out.select(*[F.col("rest")[f.name].alias(f.name) for f in kept], "text", "n_lines", "n_dropped")


def swapped(key: Column) -> Column:
    """The 16 bytes of two numbers as a hash has them: each number's bytes from the last to the first."""
    digits = F.hex(key)
    return F.unhex(F.concat(*[F.substring(digits, 1 + 2 * i, 2) for half in (0, 8) for i in range(half + 7, half - 1, -1)]))
