"""Substring dedup: a count-min prefilter, then exact grouping of the windows that it estimates as repeated.

Documents are dealt by doc_id into chunks. Every chunk sends its partition sketch, the cells of its windows in
each row of a count-min sketch, as bit-packed gaps cut by cell range; the owner of a range merges (adds up) the
sketches of all chunks and answers each with one bit per cell: counted once or more often. Merged counts are
never too low, so a window that another chunk also holds is never lost. In the second pass a chunk sends only
windows whose every cell is repeated, with 96 bits of hash and the smallest doc_id that holds them; owners group
them exactly and answer, again by one bit each, whether another chunk has a smaller doc_id.

Nothing is broadcast and nothing is kept per corpus: a chunk sends each owner one message per round, about ten bits
per window and sketch row, then fifteen bytes per repeated window, and the width of the sketch follows the number of
chunks. A passage that a third
of all documents share is one entry per chunk. The plan has one exchange of the documents, used by all rounds.

Defined cases: a null or empty text has no words; a document of fewer words than a window loses none; rows with
equal doc_id don't cover each other; a null doc_id comes after all others; very long texts are read whole, each by one
task; other columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

#: Rows of the count-min sketch, and cells of a row per window if a chunk holds CHUNK_WINDOWS windows.
DEPTH, SPARE_BITS, CHUNK_WINDOWS = 2, 3, 1 << 22
#: Bytes of text of a chunk: at least, and at most.
CHUNK_BYTES, MAX_CHUNK_BYTES = 4 << 20, 256 << 20
NO_ID = np.iinfo(np.int64).max

#: The two rounds of messages, and what stands before the cells of a sketch row.
SKETCH, EXACT, HEAD = 0, 1, struct.Struct("<ii")
_MESSAGE = "chunk int, kind int, block int, n int, body binary"
_REPLY = "chunk int, kind int, block int, bits binary"


class Plan(NamedTuple):
    window: int
    bits: int  # a sketch row has 2 ** bits cells
    blocks: int  # ranges of cells, and of hashes


class Windows(NamedTuple):
    """All windows of a chunk, in order of rows: two hashes, the doc_id, and where rows and words are."""

    h1: np.ndarray
    h2: np.ndarray
    doc: np.ndarray
    words: list[W.Words]
    rows: pa.Table


def chunk_windows(rows: pa.Table, window: int) -> Windows:
    h1, h2, doc, words, parts = [], [], [], [], []
    for batch in W.slices(iter(rows.combine_chunks().to_batches()), "text"):
        w = W.texts(batch.column("text")).words(W.NOT_SPACE)
        ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
        first = window_starts(w, window)
        a, b = w.hashes(0), w.hashes(1)
        h1.append(W.span_hash(a, first, first + window, 1))
        h2.append(W.span_hash(b, first, first + window, 2))
        doc.append(np.repeat(ids, np.maximum(w.counts() - window + 1, 0)))
        words.append(w)
        parts.append(batch)
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return Windows(cat(h1, np.uint64), cat(h2, np.uint64), cat(doc, np.int64), words, pa.Table.from_batches(parts, rows.schema))


def window_starts(w: W.Words, window: int) -> np.ndarray:
    """Word positions at which a window of one row begins."""
    n = np.maximum(w.counts() - window + 1, 0)
    return np.repeat(w.rows[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())


def pack(sorted_cells: np.ndarray) -> bytes:
    """Sorted distinct numbers as Rice-coded gaps: fixed low bits, then the rest in unary."""
    gaps = np.diff(sorted_cells, prepend=np.uint64(0))
    low = max(0, int(gaps.mean()).bit_length() - 1)
    head = gaps >> np.uint64(low)
    ones = np.zeros(int(head.sum()) + len(gaps), np.uint8)
    ones[(np.cumsum(head + np.uint64(1)) - np.uint64(1)).astype(np.int64)] = 1
    width = _width(low)
    fixed = (gaps & np.uint64((1 << low) - 1)).astype(f">u{width}").view(np.uint8).reshape(-1, width)
    bits = np.unpackbits(fixed, axis=1)[:, 8 * width - low :]
    return bytes([low]) + np.packbits(bits).tobytes() + np.packbits(ones).tobytes()


def _width(bits: int) -> int:
    """Bytes of the smallest integer type of so many bits."""
    return next(b for b in (1, 2, 4, 8) if 8 * b >= bits)


def unpack(n: int, body: bytes) -> np.ndarray:
    low, raw = body[0], np.frombuffer(body, np.uint8, offset=1)
    cut = (n * low + 7) // 8
    width = _width(low)
    bits = np.zeros((n, 8 * width), np.uint8)
    bits[:, 8 * width - low :] = np.unpackbits(raw[:cut], count=n * low).reshape(n, low)
    fixed = np.packbits(bits, axis=1).view(f">u{width}").ravel().astype(np.uint64)
    ones = np.flatnonzero(np.unpackbits(raw[cut:]))[:n]
    gaps = np.diff(ones, prepend=-1).astype(np.uint64) - np.uint64(1)
    return np.cumsum((gaps << np.uint64(low)) + fixed)


def cuts(values: np.ndarray, bits: int, blocks: int) -> np.ndarray:
    """Where sorted values below 2 ** bits pass from one of `blocks` equal ranges to the next."""
    edges = np.array([(b << bits) // blocks for b in range(1, blocks)], np.uint64)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])


def cells(w: Windows, part: int, plan: Plan) -> np.ndarray:
    return (w.h1 if part == 0 else W.mix(w.h1 + np.uint64(part) * w.h2)) >> np.uint64(64 - plan.bits)


def send_sketch(rows: pa.Table, plan: Plan) -> Iterator[tuple]:
    """One message per range of cells, with the cells of all sketch rows: how many, how many bytes, the packed cells."""
    w = chunk_windows(rows, plan.window)
    own = [W.distinct(cells(w, part, plan)) for part in range(DEPTH)]
    at = [cuts(x, plan.bits, plan.blocks) for x in own]
    for b in range(plan.blocks):
        bodies = [(c[b + 1] - c[b], pack(x[c[b] : c[b + 1]]) if c[b + 1] > c[b] else b"") for x, c in zip(own, at, strict=True)]
        if any(n for n, _ in bodies):
            yield SKETCH, b, sum(n for n, _ in bodies), b"".join(HEAD.pack(n, len(x)) + x for n, x in bodies)


def read_sketch(body: bytes) -> list[np.ndarray]:
    out, at = [], 0
    for _ in range(DEPTH):
        n, size = HEAD.unpack_from(body, at)
        at += HEAD.size + size
        out.append(unpack(n, body[at - size : at]) if n else np.zeros(0, np.uint64))
    return out


def merge_sketches(messages: pa.Table) -> Iterator[bytes]:
    """For each message, in order, one bit per cell: do two chunks or more count it?"""
    sent = [read_sketch(body) for body in messages["body"].to_pylist()]
    repeated = []
    for part in range(DEPTH):
        every = np.concatenate([x[part] for x in sent])
        every.sort()
        repeated.append(W.distinct(every[1:][every[1:] == every[:-1]]))
    for own in sent:
        yield b"".join(np.packbits(_isin(x, r)).tobytes() for x, r in zip(own, repeated, strict=True))


def _isin(values: np.ndarray, in_order: np.ndarray) -> np.ndarray:
    if not len(in_order):
        return np.zeros(len(values), bool)
    return in_order[np.minimum(np.searchsorted(in_order, values), len(in_order) - 1)] == values


def _bits(replies: pa.Table, kind: int, sizes: list[np.ndarray]) -> list[np.ndarray]:
    """The replies of a kind, in order of blocks; sizes: how many were asked in each block, for each sketch row."""
    out, ends = [np.zeros(int(n.sum()), bool) for n in sizes], [np.cumsum(n) for n in sizes]
    for k, b, bits in zip(replies["kind"].to_pylist(), replies["block"].to_pylist(), replies["bits"].to_pylist(), strict=True):
        if k == kind:
            at = 0
            for x, n, end in zip(out, sizes, ends, strict=True):
                own = np.frombuffer(bits, np.uint8, (int(n[b]) + 7) // 8, at)
                at += len(own)
                x[end[b] - n[b] : end[b]] = np.unpackbits(own, count=int(n[b])).astype(bool)
    return out


class Repeated(NamedTuple):
    """Windows of a chunk that the sketch estimates as repeated: where, and each distinct one with its smallest doc_id."""

    where: np.ndarray
    which: np.ndarray
    h1: np.ndarray
    h2: np.ndarray
    smallest: np.ndarray
    asked: np.ndarray


def repeated(w: Windows, replies: pa.Table, plan: Plan) -> Repeated:
    elsewhere = np.ones(len(w.h1), bool)
    asked = [np.unique(cells(w, part, plan), return_inverse=True) for part in range(DEPTH)]
    for bits, (_, at) in zip(_bits(replies, SKETCH, [np.diff(cuts(own, plan.bits, plan.blocks)) for own, _ in asked]), asked, strict=True):
        elsewhere &= bits[at]
    order = np.argsort(w.h1, kind="stable")
    h1 = w.h1[order]
    twice = np.zeros(len(h1), bool)
    twice[1:] = h1[1:] == h1[:-1]
    twice[:-1] |= twice[1:]
    keep = twice | elsewhere[order]
    order = order[keep]
    order = order[np.lexsort((w.doc[order], w.h2[order], w.h1[order]))]
    h1, h2 = w.h1[order], w.h2[order] & np.uint64(0xFFFFFFFF)
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    first = np.flatnonzero(new)
    return Repeated(order, np.cumsum(new) - 1, h1[first], h2[first].astype(np.uint32), w.doc[order][first], elsewhere[order][first])


def send_repeated(rows: pa.Table, replies: pa.Table, plan: Plan) -> Iterator[tuple]:
    r = repeated(chunk_windows(rows, plan.window), replies, plan)
    h1, h2, doc = r.h1[r.asked], r.h2[r.asked], r.smallest[r.asked]
    at = cuts(h1, 64, plan.blocks)
    for b, (i, j) in enumerate(zip(at, at[1:], strict=False)):
        if j > i:  # doc_ids by byte planes: the high ones are alike and compress to nothing
            yield EXACT, b, j - i, h1[i:j].tobytes() + h2[i:j].tobytes() + doc[i:j].view(np.uint8).reshape(-1, 8).T.tobytes()


def group_repeated(messages: pa.Table) -> Iterator[bytes]:
    """For each message, in order, one bit per window: does another chunk hold it under a smaller doc_id?"""
    sizes, bodies = messages["n"].to_pylist(), messages["body"].to_pylist()
    h1 = np.concatenate([np.frombuffer(x, np.uint64, n) for n, x in zip(sizes, bodies, strict=True)])
    h2 = np.concatenate([np.frombuffer(x, np.uint32, n, 8 * n) for n, x in zip(sizes, bodies, strict=True)])
    doc = np.concatenate([np.frombuffer(x, np.uint8, 8 * n, 12 * n).reshape(8, n).T.copy().view(np.int64).ravel() for n, x in zip(sizes, bodies, strict=True)])
    order = np.lexsort((doc, h2, h1))
    new = np.ones(len(order), bool)
    new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    smallest = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    smaller = np.empty(len(order), bool)
    smaller[order] = smallest < doc[order]
    for bits in np.split(smaller, np.cumsum(sizes)[:-1]):
        yield np.packbits(bits).tobytes()


def remove(rows: pa.Table, replies: pa.Table, plan: Plan) -> Iterator[tuple[pa.RecordBatch, W.Words, np.ndarray]]:
    """The rows of a chunk, by slices, with their words and which of these are covered by a shadowed window."""
    w = chunk_windows(rows, plan.window)
    r = repeated(w, replies, plan)
    h1 = r.h1[r.asked]
    smaller = np.zeros(len(r.h1), bool)
    (smaller[r.asked],) = _bits(replies, EXACT, [np.diff(cuts(h1, 64, plan.blocks))])
    shadowed = np.zeros(len(w.h1), bool)
    shadowed[r.where] = smaller[r.which] | (w.doc[r.where] > r.smallest[r.which])
    used = 0
    for batch, words in zip(w.rows.to_batches(), w.words, strict=True):
        first = window_starts(words, plan.window)
        gone = first[shadowed[used : used + len(first)]]
        used += len(first)
        cover = np.zeros(len(words.starts) + 1, np.int32)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + plan.window, -1)
        yield batch, words, np.cumsum(cover[:-1]) > 0


def kept_texts(words: W.Words, covered: np.ndarray) -> list[bytes]:
    """Of each row the words that stay, joined by one space."""
    stay = ~covered
    left = W.per_row(stay, words.rows)
    data, starts, ends = W.Words(words.data, words.starts[stay], words.ends[stay], words.rows).joined()
    last = np.cumsum(left)
    return [data[starts[b - n] : ends[b - 1]] if n else b"" for n, b in zip(left.tolist(), last.tolist(), strict=True)]


def chunk_count(size: int) -> int:
    """A chunk's bytes grow with the root of all bytes, within bounds, so that chunks fit tasks and messages stay large."""
    return max(1, -(-size // int(min(max((size << 16) ** 0.5, CHUNK_BYTES), MAX_CHUNK_BYTES))))


def dedup(docs: DataFrame, window: int = 13, chunks: int | None = None, text: bool = True) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and, if `text`, the kept text.

    Removed is each word in a window of `window` words that also starts in a document with a smaller doc_id.
    `chunks`: by default from the bytes of all texts, see `chunk_count`.
    """
    chunks = chunks or chunk_count(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    plan = Plan(window, min(62, (chunks * CHUNK_WINDOWS - 1).bit_length() + SPARE_BITS), -(-chunks // 3))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(key, F.lit(chunks)).cast("int").alias("chunk"))

    def table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
        return pa.Table.from_pydict(dict(zip(schema.names, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in schema.names}, schema)

    message = pa.schema([("chunk", pa.int32()), ("kind", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("body", pa.binary())])
    reply = pa.schema([("chunk", pa.int32()), ("kind", pa.int32()), ("block", pa.int32()), ("bits", pa.binary())])
    result = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), *[("kept", pa.string())] * text])

    def ask_sketch(key, rows):
        return table([(key[0].as_py(), *m) for m in send_sketch(rows, plan)], message)

    def ask_exact(key, rows, replies):
        return table([(key[0].as_py(), *m) for m in send_repeated(rows, replies, plan)], message) if len(rows) else table([], message)

    def answer(decide):
        def to_all(key, messages):
            return pa.Table.from_arrays([messages["chunk"], messages["kind"], messages["block"], pa.array(list(decide(messages)), pa.binary())], schema=reply)

        return to_all

    def finish(key, rows, replies):
        out = []
        for batch, words, covered in remove(rows, replies, plan):
            kept = kept_texts(words, covered)
            columns = [batch.column("doc_id"), words.counts(), W.per_row(covered, words.rows), [hashlib.sha256(k).hexdigest() for k in kept], *[[k.decode() for k in kept]] * text]
            out.append(pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, result, strict=True)], schema=result))
        return pa.Table.from_batches(out, result)

    by_chunk = dealt.groupBy("chunk")
    sketch = by_chunk.applyInArrow(ask_sketch, _MESSAGE).groupBy("block").applyInArrow(answer(merge_sketches), _REPLY)
    exact = by_chunk.cogroup(sketch.groupBy("chunk")).applyInArrow(ask_exact, _MESSAGE).groupBy("block").applyInArrow(answer(group_repeated), _REPLY)
    return by_chunk.cogroup(sketch.unionByName(exact).groupBy("chunk")).applyInArrow(finish, f"doc_id long, n_words long, n_removed long, kept_sha256 string{', kept string' * text}")
