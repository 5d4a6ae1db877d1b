"""Conversation structure repair: the cheapest edits that make roles read ``(s?(ua)+)?``, by time-major tensors.

A piece is a run of rows of one conversation. Pieces are bucketed by length; a bucket's rows stand in arrays of shape
(time, piece), and every step of the dynamic program treats all pieces of the bucket at once: backward, the cost of each
of four states (start, after system, after user, after assistant) before each row is stored; forward, the edits are
traced for all pieces together. At each state the role that may come next is fixed, so of equally cheap edits the least
letter is taken step by step.

A conversation of up to `PIECE_ROWS` rows and `PIECE_BYTES` bytes of text is one piece. A longer one, be it a third of
all rows, is dealt by ranges of its order, so many tasks hold pieces of it: each piece gives a matrix of the costs from
every state before it to every state behind it; the matrices of a conversation (16 numbers a piece) are put together to
the costs behind each piece, with which each piece is traced from every state; what these traces end in gives the state
before each piece. Texts seen in earlier pieces meet by hash, one row per piece and text.

Defined cases: null roles and texts are one space; rows of the same turn are ordered by role and text, null turns come
first; rows of a null conv_id are a conversation of their own; repeated rows count as rows; a conversation without rows
has no edits; roles other than system, user and assistant count by their first letter; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpoint

#: A conversation beyond these is worked on in pieces; they bound what a task holds.
PIECE_ROWS, PIECE_BYTES = 4_096, 8_000_000
#: Rows of pieces that are worked on at a time.
STEP_ROWS = 1 << 16
#: Conversations that are broadcast at most, to tell the long from the others.
MAX_BROADCAST_CONVERSATIONS = 50_000

RENAME, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that has to come next in each state; a system row may come first.
NEXT = np.array([USER, USER, ASSISTANT, USER])
NEVER = 1 << 40
#: Costs behind the last row: nothing or an answer may end it, else roles are inserted.
FINAL = [0, 2 * INSERT, INSERT, 0]
SPACE = " \t\n\x0b\x0c\r"

PIECE = "conv_id long, piece long, turn array<long>, role array<string>, text array<string>, initial array<int>, fault array<int>, same array<binary>"
COUNTS = "min_turn long, max_turn long, turns long, first_initial int, last_initial int, blank long, duplicate long, truncated long, illegal long"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults by the hash of conv_id and turn, and `copies`: 0 where a row is dropped, 2 where it repeats."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def marked(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (1 where they have none) with `initial`, `fault` and `same`: `initial` is the state that the role leads to or -1,
    `fault` 1 blank, 2 truncated; `same` is equal for equal role and text."""
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    initial = F.substring(role, 1, 1)
    end = F.rtrim(text, F.lit(SPACE))
    fault = F.when(end == "", 1).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(2)
    same = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.when(copies > 0, text).otherwise("").alias("text"), copies.cast("int").alias("copies"),
        F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(-1).alias("initial"), fault.alias("fault"), same.alias("same"),
    )


# --- pieces ---


def _changes(ids: pa.Array) -> np.ndarray:
    """Whether a row has another conv_id than the row before it; nulls are alike."""
    null = np.asarray(ids.is_null())
    value = np.asarray(ids.fill_null(0))
    out = np.zeros(len(value), bool)
    out[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
    return out


def _cut(batches: Iterator[pa.RecordBatch], most_rows: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation as pieces; what may go on in the next batch is carried over."""
    names = ["turn", "role", "text", "initial", "fault", "same"]
    number = TaskContext.get().partitionId() << 32
    carry = None

    def emit(rows: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        nonlocal number
        copies = np.asarray(rows.column("copies"))
        ends = np.append(starts[1:], rows.num_rows)
        total = np.append(0, np.cumsum(copies))
        offsets = pa.array(np.append(total[starts], total[ends[-1]]), pa.int32())
        flat = rows.take(pa.array(np.repeat(np.arange(rows.num_rows), copies)))
        pieces = pa.array(np.arange(number, number + len(starts)))
        number += len(starts)
        lists = [pa.ListArray.from_arrays(offsets, flat.column(n)) for n in names]
        return pa.RecordBatch.from_arrays([rows.column("conv_id").take(pa.array(starts)), pieces, *lists], ["conv_id", "piece", *names])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if carry is None else pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
        new = _changes(rows.column("conv_id"))
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        held = lambda x: (c := np.append(0, np.cumsum(x)))[:-1] - c[first]  # noqa: E731  before each row, of its conversation
        sizes = np.asarray(pa.compute.binary_length(rows.column("text")))
        copies = np.asarray(rows.column("copies"))
        part = np.maximum(held(copies) // most_rows, held(sizes * copies) // most_bytes)
        new[1:] |= part[1:] != part[:-1]
        new[0] = True
        starts = np.flatnonzero(new)
        if len(starts) > 1:
            yield emit(rows.slice(0, starts[-1]), starts[:-1])
        carry = rows.slice(starts[-1])
    if carry is not None:
        yield emit(carry, np.array([0]))


class Bucket(NamedTuple):
    """Pieces of about the same length: arrays of shape (time, piece); `row` is the number of a row in the batch."""

    pieces: np.ndarray
    lengths: np.ndarray
    row: np.ndarray
    initial: np.ndarray
    skip: np.ndarray  # blank or duplicate
    extra: np.ndarray  # cost of keeping the row


class Pieces(NamedTuple):
    offsets: np.ndarray
    initial: np.ndarray
    fault: np.ndarray  # 0 none, 1 blank, 2 truncated, 3 duplicate

    def buckets(self) -> Iterator[Bucket]:
        lengths = np.diff(self.offsets)
        kind = np.ceil(np.log2(np.maximum(lengths, 1))).astype(int)
        for k in np.unique(kind):
            pieces = np.flatnonzero(kind == k)
            time = np.arange(lengths[pieces].max())[:, None]
            there = time < lengths[pieces]
            row = np.where(there, self.offsets[pieces] + time, 0)
            at = lambda x: x[row] if len(x) else np.zeros(row.shape, int)  # noqa: E731, B023
            fault = np.where(there, at(self.fault), 1)
            yield Bucket(pieces, lengths[pieces], row, np.where(there, at(self.initial), -1), (fault == 1) | (fault == 3), np.where(fault == 2, UNFINISHED, 0))


def pieces_of(batch: pa.RecordBatch) -> Pieces:
    """First faults of the rows: within a piece all but the first of equal rows are duplicates, and those in `seen`."""
    lists = batch.column("fault")
    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    flat = lambda name: batch.column(name).flatten()
    fault = np.array(flat("fault"), int)
    of = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
    key = np.frombuffer(b"".join(flat("same").to_pylist()), np.uint64).reshape(-1, 2) if len(fault) else np.zeros((0, 2), np.uint64)
    order = np.lexsort((np.arange(len(of)), key[:, 1], key[:, 0], of))
    again = np.zeros(len(of), bool)
    again[order[1:]] = (of[order[1:]] == of[order[:-1]]) & (key[order[1:]] == key[order[:-1]]).all(axis=1)
    if "seen" in batch.schema.names:
        for i in np.flatnonzero(~np.asarray(batch.column("seen").is_null())):
            seen = {*batch.column("seen")[i].as_py()}
            again[offsets[i] : offsets[i + 1]] |= [x in seen for x in batch.column("same")[i].as_py()]
    return Pieces(offsets, np.array(flat("initial"), int), np.where(again & (fault != 1), 3, fault))


def backward(b: Bucket, ends: np.ndarray) -> np.ndarray:
    """Least costs before each row and behind the last, of shape (time + 1, piece, state)."""
    time, n = b.row.shape
    costs = np.empty((time + 1, n, 4), np.int64)
    costs[time] = ends
    for t in range(time - 1, -1, -1):
        after = costs[t + 1]
        paid = b.extra[t][:, None] + np.where(b.skip[t], NEVER, 0)[:, None]
        best = np.minimum(DELETE + after, RENAME + paid + after[:, NEXT])
        kept = np.where(b.initial[t][:, None] == NEXT, after[:, NEXT], NEVER)
        kept[:, START] = np.where(b.initial[t] == SYSTEM, after[:, SYSTEM], kept[:, START])
        best = np.minimum(best, paid + kept)
        for _ in range(2):  # more than two inserted rows would lead to the same state again
            best = np.minimum(best, INSERT + best[:, NEXT])
        costs[t] = np.where((t < b.lengths)[:, None], best, after)
    return costs


def trace(b: Bucket, costs: np.ndarray, start: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and roles of the edits, of shape (time + 1, 3, piece): before each row up to two inserted ones, then the
    row's own; and the state behind each piece. Behind the last row, roles are inserted only where `last`."""
    time, n = b.row.shape
    letters, roles = np.zeros((time + 1, 3, n), np.uint8), np.zeros((time + 1, 3, n), np.int8)
    state, each = start.copy(), np.arange(n)
    for t in range(time + 1):
        here = (t < b.lengths) if t < time else np.zeros(n, bool)
        may_insert = here | (last & (t == b.lengths))
        waits = np.ones(n, bool)  # for its row's own edit, and may still insert
        for k in range(3):
            total, then = costs[t, each, state], NEXT[state]
            if t < time:
                after = costs[t + 1]
                delete = here & (DELETE + after[each, state] == total)
            else:
                delete = np.zeros(n, bool)
            insert = may_insert & waits & ~delete & (INSERT + costs[t, each, then] == total) if k < 2 else np.zeros(n, bool)
            own = here & waits & ~insert
            if own.any():
                to = np.where((state == START) & (b.initial[t] == SYSTEM), SYSTEM, then)
                keep = own & ~delete & ~b.skip[t] & (b.initial[t] == to) & (b.extra[t] + after[each, to] == total)
                rename = own & ~delete & ~keep
                letters[t, 2] = np.where(own, np.where(delete, ord("D"), np.where(keep, ord("K"), ord("R"))), letters[t, 2])
                roles[t, 2] = np.where(rename, then, roles[t, 2])
                state = np.where(keep, to, np.where(rename, then, state))
            letters[t, k] = np.where(insert, ord("I"), letters[t, k])
            roles[t, k] = np.where(insert, then, roles[t, k])
            state = np.where(insert, then, state)
            waits &= insert
    return letters, roles, state


# --- what tasks do with pieces ---


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same pieces in batches of about STEP_ROWS rows."""
    for batch in batches:
        lengths = np.asarray(pa.compute.list_value_length(batch.column("fault")))
        part = (np.cumsum(lengths) - lengths) // STEP_ROWS + np.arange(len(lengths)) // STEP_ROWS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def counts(batch: pa.RecordBatch, p: Pieces) -> list[pa.Array]:
    """COUNTS of each piece."""
    n, lengths = batch.num_rows, np.diff(p.offsets)
    of = np.repeat(np.arange(n), lengths)
    turn = batch.column("turn").flatten()
    there, value = np.asarray(turn.is_valid()), np.asarray(turn.fill_null(0))
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(low, of[there], value[there])
    np.maximum.at(high, of[there], value[there])
    rest = np.flatnonzero(there)  # in order of turn
    new = np.ones(len(rest), bool)
    new[1:] = (value[rest[1:]] != value[rest[:-1]]) | (of[rest[1:]] != of[rest[:-1]])
    turns = np.bincount(of[rest[new]], minlength=n)
    pair = of[1:] == of[:-1]
    a, b = p.initial[:-1], p.initial[1:]
    wrong = pair & ~(((a == SYSTEM) | (a == ASSISTANT)) & (b == USER) | (a == USER) & (b == ASSISTANT))
    at = lambda i: pa.array(np.where(lengths > 0, p.initial[np.clip(i, 0, max(len(p.initial) - 1, 0))] if len(p.initial) else -1, -1), pa.int32())
    number = lambda x: pa.array(np.bincount(x, minlength=n).astype(np.int64))
    return [
        pa.array(low, mask=turns == 0), pa.array(high, mask=turns == 0), pa.array(turns.astype(np.int64)), at(p.offsets[:-1]), at(p.offsets[1:] - 1),
        number(of[p.fault == 1]), number(of[p.fault == 3]), number(of[p.fault == 2]), number(of[1:][wrong]),
    ]


_COUNTS = [x.split()[0] for x in COUNTS.split(", ")]


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of pieces with `ends` (costs behind them), `start` (the state before) and `last`."""
    for batch in _steps(batches):
        p = pieces_of(batch)
        ends = np.asarray(batch.column("ends").flatten()).reshape(-1, 4)
        start, last = np.asarray(batch.column("start")), np.asarray(batch.column("last"))
        cost, pieces, letters, roles, rows = np.zeros(batch.num_rows, np.int64), [], [], [], []
        for b in p.buckets():
            costs = backward(b, ends[b.pieces])
            letter, role, _ = trace(b, costs, start[b.pieces], last[b.pieces])
            cost[b.pieces] = costs[0][np.arange(len(b.pieces)), start[b.pieces]]
            row = np.full(letter.shape, -1)
            row[:-1, 2] = b.row
            made = letter.transpose(2, 0, 1) > 0
            pieces.append(np.broadcast_to(b.pieces[:, None, None], made.shape)[made])
            letters.append(letter.transpose(2, 0, 1)[made])
            roles.append(role.transpose(2, 0, 1)[made])
            rows.append(row.transpose(2, 0, 1)[made])
        piece, letter, role, row = (np.concatenate(x) for x in (pieces, letters, roles, rows))
        order = np.argsort(piece, kind="stable")
        piece, letter, role, row = piece[order], letter[order], role[order], row[order]
        offsets = lambda x: np.append(0, np.cumsum(np.bincount(x, minlength=batch.num_rows))).astype(np.int32)  # noqa: E731, B023
        audit = pa.StringArray.from_buffers(batch.num_rows, pa.py_buffer(offsets(piece)), pa.py_buffer(letter.tobytes()))
        stays = letter != ord("D")
        own_roles, own_texts = batch.column("role").flatten(), batch.column("text").flatten()
        n = len(own_roles)
        given = pa.concat_arrays([own_roles, pa.array(["user", "assistant"])])
        texts = pa.concat_arrays([own_texts, pa.array([""])])
        role_at = np.where(role == USER, n, np.where(role == ASSISTANT, n + 1, row))[stays]
        turns = pa.StructArray.from_arrays([given.take(pa.array(role_at)), texts.take(pa.array(np.where(row < 0, n, row)[stays]))], ["role", "text"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("piece"), *counts(batch, p), pa.array(cost), audit, pa.ListArray.from_arrays(pa.array(offsets(piece[stays])), turns)],
            ["conv_id", "piece", *_COUNTS, "cost", "audit", "repaired"],
        )


SOLVED = f"conv_id long, piece long, {COUNTS}, cost long, audit string, repaired array<struct<role: string, text: string>>"


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece, `matrix`: the cost from each state before it to each state behind it."""
    for batch in _steps(batches):
        p = pieces_of(batch)
        matrix = np.zeros((batch.num_rows, 4, 4), np.int64)
        for b in p.buckets():
            for to in range(4):
                ends = np.full((len(b.pieces), 4), NEVER)
                ends[:, to] = 0
                matrix[b.pieces, :, to] = np.minimum(backward(b, ends)[0], NEVER)
        cells = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * 16), pa.array(matrix.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("piece"), *counts(batch, p), cells], ["conv_id", "piece", *_COUNTS, "matrix"])


def _leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece with `ends`, the state behind it for each state before it."""
    for batch in _steps(batches):
        p = pieces_of(batch)
        ends, last = np.asarray(batch.column("ends").flatten()).reshape(-1, 4), np.asarray(batch.column("last"))
        out = np.zeros((batch.num_rows, 4), np.int32)
        for b in p.buckets():
            costs = backward(b, ends[b.pieces])
            for state in range(4):
                out[b.pieces, state] = trace(b, costs, np.full(len(b.pieces), state), last[b.pieces])[2]
        cells = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * 4), pa.array(out.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("piece"), cells], ["conv_id", "piece", "leads"])


def _behind(group: pd.DataFrame) -> pd.DataFrame:
    """Costs behind each piece of one conversation, from its matrices; counts across pieces."""
    group = group.sort_values("piece", ignore_index=True)
    ends, costs = np.zeros((len(group), 4), np.int64), np.array(FINAL)
    for i in range(len(group) - 1, -1, -1):
        ends[i] = costs
        costs = (np.stack(group["matrix"][i]).reshape(4, 4) + costs).min(axis=1)
    turns, last_turn, seam = 0, None, 0
    initials = group["last_initial"].to_numpy()[:-1], group["first_initial"].to_numpy()[1:]
    for a, b in zip(*initials, strict=True):
        seam += not (a in (SYSTEM, ASSISTANT) and b == USER or a == USER and b == ASSISTANT)
    for low, high, n in zip(group["min_turn"], group["max_turn"], group["turns"], strict=True):
        if n:
            turns += n - (low == last_turn)
            last_turn = high
    named = group.assign(ends=[*ends], last=np.arange(len(group)) == len(group) - 1, all_turns=int(turns), seams=int(seam), total=int(costs[START]))
    return named[["conv_id", "piece", "ends", "last", "all_turns", "seams", "total"]]


def _before(group: pd.DataFrame) -> pd.DataFrame:
    """The state before each piece of one conversation."""
    group = group.sort_values("piece", ignore_index=True)
    start, state = [], START
    for leads in group["leads"]:
        start.append(state)
        state = int(leads[state])
    return group.assign(start=start)[["conv_id", "piece", "start"]]


def _joined(pieces: DataFrame, more: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Joins on keys of which conv_id may be null."""
    named = more.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in more.columns if c not in keys])
    at = F.col("conv_id").eqNullSafe(F.col("_conv_id"))
    for k in keys[1:]:
        at = at & (F.col(k) == F.col(f"_{k}"))
    return pieces.join(named, at, how).drop(*[f"_{k}" for k in keys])


def _long(rows: DataFrame, most_rows: int, most_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Of conversations in pieces: SOLVED of each piece, and all_turns, seams and total of each."""
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.substring("text", 1, 64)]
    ranged = rows.where("copies > 0").repartitionByRange(*order).sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    pieces = checkpoint(ranged.mapInArrow(lambda x: _cut(x, most_rows, most_bytes), PIECE))
    held = pieces.select("conv_id", "piece", F.explode(F.array_distinct("same")).alias("same"))
    first = held.groupBy(F.col("conv_id").alias("_conv"), F.col("same").alias("_same")).agg(F.min("piece").alias("first"))
    again = held.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same"))).where("piece > first")
    pieces = checkpoint(_joined(pieces, again.groupBy("conv_id", "piece").agg(F.collect_list("same").alias("seen")), "conv_id", "piece", how="left"))
    behind = checkpoint(pieces.mapInArrow(_matrices, f"conv_id long, piece long, {COUNTS}, matrix array<long>").groupBy("conv_id").applyInPandas(_behind, "conv_id long, piece long, ends array<long>, last boolean, all_turns long, seams long, total long"))
    ended = _joined(pieces, behind.select("conv_id", "piece", "ends", "last"), "conv_id", "piece")
    before = ended.mapInArrow(_leads, "conv_id long, piece long, leads array<int>").groupBy("conv_id").applyInPandas(_before, "conv_id long, piece long, start int")
    return _joined(ended, before, "conv_id", "piece").mapInArrow(_solved, SOLVED), behind.where("last").select("conv_id", "all_turns", "seams", "total")


def _parts(rows: DataFrame, most_rows: int, most_bytes: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """SOLVED of conversations that are one piece; of longer ones, if any, see `_long`."""
    rows = marked(rows)
    size = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.col("copies") * F.octet_length("text")).alias("bytes"))
    long = checkpoint(size.where((F.col("n") >= most_rows) | (F.col("bytes") >= most_bytes)).select(F.col("conv_id").alias("_long")))
    number = long.count()
    short, solved, known = rows, None, None
    if number:
        few = F.broadcast(long) if number <= MAX_BROADCAST_CONVERSATIONS else long
        at = F.col("conv_id").eqNullSafe(F.col("_long"))
        short = rows.join(few, at, "left_anti")
        solved, known = _long(rows.join(few, at, "left_semi"), most_rows, most_bytes)
    ordered = short.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    whole = ordered.mapInArrow(lambda x: _cut(x, most_rows, most_bytes), PIECE).select("*", F.array(*[F.lit(x).cast("long") for x in FINAL]).alias("ends"), F.lit(START).alias("start"), F.lit(True).alias("last"))
    return whole.mapInArrow(_solved, SOLVED), solved, known


def turns(rows: DataFrame, most_rows: int = PIECE_ROWS, most_bytes: int = PIECE_BYTES) -> DataFrame:
    """The repaired conversations: conv_id, piece, position in the piece, role, text, in this order of a conversation."""
    short, solved, _ = _parts(rows, most_rows, most_bytes)
    every = short if solved is None else short.unionByName(solved)
    return every.select("conv_id", "piece", F.posexplode("repaired").alias("position", "row")).select("conv_id", "piece", "position", "row.role", "row.text")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the rows of each conversation, joined by newlines; its pieces come in order."""
    now, digest, any_row = (), hashlib.sha256(), False
    done = lambda: pa.RecordBatch.from_pydict({"_id": pa.array([now[0]], pa.int64()), "sha": [digest.hexdigest()]})
    for batch in batches:
        for conv, repaired in zip(batch.column("conv_id").to_pylist(), batch.column("repaired"), strict=True):
            if now != (conv,):
                if now:
                    yield done()
                now, digest, any_row = (conv,), hashlib.sha256(), False
            for x in repaired.as_py():
                digest.update(("\n" * any_row + f"{x['role']}:{x['text']}").encode())
                any_row = True
    if now:
        yield done()


def report(rows: DataFrame, most_rows: int = PIECE_ROWS, most_bytes: int = PIECE_BYTES) -> DataFrame:
    """Per conversation of `rows` (conv_id, turn, role, text; copies, if there): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256 (of the repaired ``role:text`` joined by newlines)."""
    gaps = lambda number: F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col(number), F.lit(0).cast("long")).alias("gaps")
    own = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    short, solved, known = _parts(rows, most_rows, most_bytes)
    lines = F.array_join(F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    out = short.select("conv_id", gaps("turns"), *own, F.sha2(lines, 256).alias("repaired_sha256"))
    if solved is None:
        return out
    solved = checkpoint(solved)
    hashes = solved.select("conv_id", "piece", "repaired").repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(_hashed, "_id long, sha string")
    sums = solved.groupBy("conv_id").agg(
        F.min("min_turn").alias("min_turn"), F.max("max_turn").alias("max_turn"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    both = _joined(sums, known, "conv_id").join(hashes, F.col("conv_id").eqNullSafe(F.col("_id")))
    both = both.withColumns({"illegal": F.col("illegal") + F.col("seams"), "cost": F.col("total")})
    return out.unionByName(both.select("conv_id", gaps("all_turns"), *own, F.col("sha").alias("repaired_sha256")))
