"""Benchmark decontamination with suffix arrays of the training text.

Each task sorts the suffixes of its shard of documents (slices of `words.SLICE_BYTES`) and binary-searches every suffix
of the benchmark items in it. Suffixes that share their first `window` words with items' suffixes are the matches'
places. A place is kept once for all items that begin alike, not once for each: what is hit, and by which set of items,
follows from places and beginnings alone, and the longest match from following places and items' suffixes word by word
together. Documents are neither shuffled nor joined for that. `matched` lists every maximal match of every item, which
is the product of both where many texts and many items share a passage; no query or stage needs it.

The benchmark goes out in blocks of about `BLOCK_BYTES` of text, dealt by the items' hash: the driver and the tasks
hold one block at a time (24 bytes per word of it), and each further block is a pass over the documents that returns
hits only.

Defined cases: a null or empty text has no words and no match; a null item_id counts as an empty string; rows that
repeat a doc_id are judged by their own text; an empty benchmark matches nothing; of very long texts each is a shard of
its own; other columns are kept. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .shared import checkpoint

#: Bytes of benchmark text in one broadcast, about.
BLOCK_BYTES = 8 << 20
#: Keys of documents with a match are broadcast up to so many (counted first), else joined by shuffle.
MAX_BROADCAST_ROWS = 500_000

MATCHES = "array<struct<start:int,length:int,item_id:string,item_start:int>>"
_MATCHES = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("item_id", pa.string()), ("item_start", pa.int32())]))


class Suffixes(NamedTuple):
    """The items' words, and their suffixes that are searched.

    groups: for each length (the window; for shorter items that of the whole item) the place of one suffix of each
    distinct beginning, and all places with that beginning, those of beginning k at owners[cuts[k]:cuts[k + 1]].
    """

    ids: list[str]
    hashes: np.ndarray
    item: np.ndarray  # of each word
    begin: np.ndarray  # of each word, where its item begins and ends
    end: np.ndarray
    groups: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]


def suffixes(items: list[tuple[str, str]], window: int) -> Suffixes:
    w = W.texts(pa.array([t for _, t in items], pa.string())).words(W.ALNUM, lower=True)
    hashes, n = w.hashes(), w.counts()
    groups = []
    for length in sorted({int(x) for x in np.minimum(n, window)} - {0}):
        of = np.flatnonzero(np.minimum(n, window) == length)
        at = np.concatenate([np.arange(w.rows[i], w.rows[i] + n[i] - length + 1) for i in of])
        # equal beginnings by their hash, which covers the same words as the search does
        kind = W.span_hash(hashes, at, at + length, 1)
        order = np.argsort(kind, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(kind[order], prepend=~kind[order][:1])), len(at))
        groups.append((length, at[order][cuts[:-1]], at[order], cuts))
    item = np.repeat(np.arange(len(n)), n)
    return Suffixes([i for i, _ in items], hashes, item, w.rows[:-1][item], w.rows[1:][item], groups)


def block_count(benchmark: DataFrame, most: int) -> int:
    return -(-(benchmark.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0) // most)


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """Items (id, text) in blocks of about `most` bytes, dealt by hash; one block at a time is on the driver."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n = block_count(benchmark, most)
    for k in range(n):
        chosen = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield [(r["id"], r["text"]) for r in chosen.toLocalIterator()]


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Positions of `tokens` (small ids; 0 ends a document) in the order of their suffixes, compared to `depth` tokens at least."""
    n = len(tokens)
    bits = max(1, int(tokens.max(initial=0)).bit_length())
    packed = max(1, min(62 // bits, depth))
    padded = np.concatenate([tokens, np.zeros(packed, tokens.dtype)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for k in range(packed):
        key = (key << bits) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.diff(key[order], prepend=-1))
    sizes = np.diff(np.append(new, n))
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.repeat(new, sizes)
    rank[n] = -1
    known = packed
    while known < depth:
        tied = np.repeat(sizes > 1, sizes)  # only suffixes that still share a rank are sorted again
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        at = order[slots]
        key = (rank[at] << 32) | (rank[np.minimum(at + known, n)] + 1)
        again = np.argsort(key, kind="stable")
        order[slots], key = at[again], key[again]
        fresh = np.zeros(n, bool)
        fresh[new] = True
        fresh[slots[np.flatnonzero(np.diff(key, prepend=-1))]] = True
        new = np.flatnonzero(fresh)
        sizes = np.diff(np.append(new, n))
        rank[order] = np.repeat(new, sizes)
        known *= 2
    return order


def find(tokens: np.ndarray, order: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search: for each row of `sought` the range of suffixes in `order` that begin with it."""
    length = sought.shape[1]
    padded = np.concatenate([tokens, np.zeros(length, tokens.dtype)])
    ends = []
    for side in (False, True):
        low, high = np.zeros(len(sought), np.int64), np.full(len(sought), len(order))
        while len(busy := np.flatnonzero(low < high)):
            mid = (low[busy] + high[busy]) // 2
            differ = padded[order[mid][:, None] + np.arange(length)] - sought[busy]
            first = differ[np.arange(len(busy)), (differ != 0).argmax(axis=1)]
            right = first <= 0 if side else first < 0
            low[busy[right]] = mid[right] + 1
            high[busy[~right]] = mid[~right]
        ends.append(low)
    return ends[0], ends[1]


def shard_matches(text: pa.Array, sought: Suffixes, window: int) -> tuple[np.ndarray, list[list[tuple[int, int, str, int]]]]:
    """Of each row: number of words, and its maximal verbatim matches (start, length, item id, start in the item), sorted."""
    w = W.texts(text).words(W.ALNUM, lower=True)
    rows, counts = len(text), w.counts()
    matches: list[list[tuple[int, int, str, int]]] = [[] for _ in range(rows)]
    if not len(w.starts) or not len(sought.hashes):
        return counts, matches
    known, ids = np.unique(w.hashes(), return_inverse=True)
    tokens = np.zeros(len(ids) + rows, np.int64)  # a 0 after each document: no match runs over its end
    tokens[np.arange(len(ids)) + w.row_of()] = ids + 1
    at = np.minimum(np.searchsorted(known, sought.hashes), len(known) - 1)
    item_tokens = np.where(known[at] == sought.hashes, at + 1, -1)  # a word that the shard lacks can't be matched
    lacks = np.concatenate([[0], np.cumsum(item_tokens < 0)])
    order, found = None, []
    for length, first, owners, cuts in sought.groups:
        there = np.flatnonzero(lacks[first + length] == lacks[first])
        if not len(there):
            continue
        if order is None:
            order = suffix_array(tokens, window)
        low, high = find(tokens, order, item_tokens[first[there][:, None] + np.arange(length)])
        for k in np.flatnonzero(high > low):
            where = order[low[k] : high[k]]
            for o in owners[cuts[there[k]] : cuts[there[k] + 1]].tolist():
                # a match that could begin a word earlier is part of a longer one
                own = where if o == sought.begin[o] else where[tokens[where - 1] != item_tokens[o - 1]]
                if len(own):
                    found.append((own, np.full(len(own), o), np.full(len(own), length)))
    if not found:
        return counts, matches
    p, o, n = (np.concatenate(x) for x in zip(*found, strict=True))
    open_ = np.arange(len(p))
    while len(open_ := open_[o[open_] + n[open_] < sought.end[o[open_]]]):
        open_ = open_[tokens[p[open_] + n[open_]] == item_tokens[o[open_] + n[open_]]]
        n[open_] += 1
    row = np.searchsorted(np.flatnonzero(tokens == 0), p)
    begin = p - row - w.rows[row]
    for r, a, size, i, b in zip(row.tolist(), begin.tolist(), n.tolist(), sought.item[o].tolist(), (o - sought.begin[o]).tolist(), strict=True):
        matches[r].append((a, size, sought.ids[i], b))
    return counts, [sorted(set(m)) for m in matches]


def scan(docs: DataFrame, sent, window: int, every: bool) -> DataFrame:
    """doc_id, row (hash of the text), n_words, matches of the documents (all of them, or those with a match) in one block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            counts, found = shard_matches(batch.column("text"), sent.value, window)
            keep = np.arange(len(found)) if every else np.array([i for i, m in enumerate(found) if m], np.int64)
            spans = pa.array([[dict(zip(("start", "length", "item_id", "item_start"), m, strict=True)) for m in found[i]] for i in keep.tolist()], _MATCHES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(keep)), batch.column("row").take(pa.array(keep)), pa.array(counts[keep], pa.int64()), spans], ["doc_id", "row", "n_words", "matches"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    return rows.mapInArrow(search, f"doc_id {dict(docs.dtypes)['doc_id']}, row long, n_words long, matches {MATCHES}")


def matched(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES, every: bool = True) -> DataFrame:
    """doc_id, row, n_words and `matches`, the longest verbatim matches, of all documents, or of those with a match.

    An item matches where `window` consecutive words of it (all words, if it has fewer) stand in the text.
    """
    context = docs.sparkSession.sparkContext
    first, more = None, None
    for block in blocks(benchmark, block_bytes):
        sent = context.broadcast(suffixes(block, window))
        if first is None:
            first = scan(docs, sent, window, every)
        else:  # cut, so that a block is let go before the next one goes out
            found = checkpoint(scan(docs, sent, window, False))
            sent.destroy()
            more = found if more is None else more.unionByName(found)
    if first is None:
        return scan(docs, context.broadcast(suffixes([], window)), window, every)
    if more is None:
        return first
    name = {"doc_id": "_doc", "row": "_row"}
    more = checkpoint(more.groupBy("doc_id", "row").agg(F.max("n_words").alias("_n"), F.flatten(F.collect_set("matches")).alias("_more")).withColumnsRenamed(name))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_row"))
    joined = first.join(few(more, more.count()), same, "left" if every else "full")
    both = F.array_sort(F.array_distinct(F.concat(F.coalesce("matches", F.array().cast(MATCHES)), F.coalesce("_more", F.array().cast(MATCHES)))))
    return joined.select(*[F.coalesce(a, b).alias(a) for a, b in (("doc_id", "_doc"), ("row", "_row"), ("n_words", "_n"))], both.alias("matches"))


def few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def hit_words(spans: str) -> Column:
    """Number of words in any of the spans, which are sorted by their start."""
    begin = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    last = lambda m: m["start"] + m["length"]
    step = lambda s, m: F.struct(F.greatest(s["upto"], last(m)).alias("upto"), (s["n"] + F.greatest(F.lit(0), last(m) - F.greatest(s["upto"], m["start"]))).alias("n"))
    return F.aggregate(spans, begin, step)["n"]


class Findings(NamedTuple):
    """What a shard's rows have in common with the items, in arrays that grow with places and with beginnings, not with
    their product. `rows`: those with a hit; for each of them the rest but `spans`, which are (row, start, length)."""

    counts: np.ndarray
    rows: np.ndarray
    spans: np.ndarray
    sets: list[list[str]]  # distinct sets of items, each in order
    kind: np.ndarray  # of a row: the number of its set
    longest: np.ndarray  # of a row: length and start of its longest match, and its item as a number of `names`
    names: list[str]


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, … (counts[i] numbers) for every i."""
    return np.repeat(starts - np.append(0, np.cumsum(counts)[:-1]), counts) + np.arange(counts.sum())


def shard_findings(text: pa.Array, sought: Suffixes, window: int, detail: bool = True) -> Findings:
    """Without `detail`: only which rows have a hit, and their spans."""
    w = W.texts(text).words(W.ALNUM, lower=True)
    rows, counts = len(text), w.counts()
    nothing = Findings(counts, np.zeros(0, np.int64), np.zeros((0, 3), np.int64), [], np.zeros(0, np.int64), np.zeros((0, 3), np.int64), [])
    if not len(w.starts) or not len(sought.hashes):
        return nothing
    known, ids = np.unique(w.hashes(), return_inverse=True)
    tokens = np.zeros(len(ids) + rows, np.int64)  # a 0 after each document: no match runs over its end
    tokens[np.arange(len(ids)) + w.row_of()] = ids + 1
    at = np.minimum(np.searchsorted(known, sought.hashes), len(known) - 1)
    item_tokens = np.where(known[at] == sought.hashes, at + 1, -1)  # a word that the shard lacks can't be matched
    lacks = np.concatenate([[0], np.cumsum(item_tokens < 0)])
    order, parts, beginnings = None, [], 0
    covered = np.zeros(len(tokens) + 1, np.int64)
    for length, first, owners, cuts in sought.groups:
        there = np.flatnonzero(lacks[first + length] == lacks[first])
        if not len(there):
            continue
        if order is None:
            order = suffix_array(tokens, window)
        low, high = find(tokens, order, item_tokens[first[there][:, None] + np.arange(length)])
        hit = np.flatnonzero(high > low)
        places = order[_spread(low[hit], (high - low)[hit])]
        np.add.at(covered, places, 1)
        np.add.at(covered, places + length, -1)
        own = cuts[there[hit]], cuts[there[hit] + 1] - cuts[there[hit]]
        number = beginnings + np.arange(len(hit))
        parts.append((places, np.repeat(number, (high - low)[hit]), np.full(len(places), length), owners[_spread(*own)], np.repeat(number, own[1])))
        beginnings += len(hit)
    inside = np.append(False, np.cumsum(covered[:-1]) > 0)
    ends_at = np.flatnonzero(tokens == 0)
    start, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~np.append(inside[1:], False)[: len(inside) - 1])
    if not len(start):
        return nothing
    of = np.searchsorted(ends_at, start)
    spans = np.stack([of, start - of - w.rows[of], end - start], axis=1)
    hits = np.unique(of)
    if not detail:
        return Findings(counts, hits, spans, [], np.zeros(0, np.int64), np.zeros((0, 3), np.int64), [])
    place, kind, depth, owner, owner_kind = (np.concatenate(x) for x in zip(*parts, strict=True))
    names, rank = np.unique(np.array(sought.ids, object).astype(str), return_inverse=True)
    row = np.searchsorted(ends_at, place)
    sets, set_of = _item_sets(row, kind, owner_kind, rank[sought.item[owner]], names, beginnings)
    best = _longest(tokens, item_tokens, sought, place, kind, depth, owner, owner_kind, rank[sought.item[owner]], beginnings, len(known) + 3)
    row, length, p, item = np.searchsorted(ends_at, best[0]), best[1], best[0], best[2]
    chosen = np.lexsort((item, p, -length, row))
    chosen = chosen[np.append(True, row[chosen][1:] != row[chosen][:-1])]
    return Findings(counts, hits, spans, sets, set_of, np.stack([length, p - row - w.rows[row], item], axis=1)[chosen], names.tolist())


def _item_sets(row: np.ndarray, kind: np.ndarray, owner_kind: np.ndarray, item: np.ndarray, names: np.ndarray, beginnings: int) -> tuple[list[list[str]], np.ndarray]:
    """Distinct sets of items, and for every row with a hit, in order, the number of its own. Rows with the same
    beginnings share their set."""
    pair = np.unique(row * beginnings + kind)
    cuts = np.flatnonzero(np.append(True, np.diff(pair // beginnings) > 0))
    by_kind = np.argsort(owner_kind, kind="stable")
    begins = np.searchsorted(owner_kind[by_kind], np.arange(beginnings + 1))
    sets: list[list[str]] = []
    known: dict[bytes, int] = {}
    out = []
    for part in np.split(pair % beginnings, cuts[1:]):
        if (name := part.tobytes()) not in known:
            known[name] = len(sets)
            sets.append(names[np.unique(np.concatenate([item[by_kind[begins[k] : begins[k + 1]]] for k in part]))].tolist())
        out.append(known[name])
    return sets, np.array(out)


def _longest(tokens, item_tokens, sought: Suffixes, place, kind, depth, owner, owner_kind, item, kinds: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For places that may begin a longest match: place, length of the longest, and the least item that has it.

    Places and suffixes of items that go on with the same word go on together, word by word.
    """
    # a place whose word before is also before every suffix of its beginning is part of a longer match
    at_begin = owner == sought.begin[owner]
    before = np.where(at_begin, 0, item_tokens[owner - 1])
    low, high = np.full(kinds, base), np.full(kinds, -2)
    np.minimum.at(low, owner_kind, before)
    np.maximum.at(high, owner_kind, before)
    free = np.bincount(owner_kind[at_begin], minlength=kinds) > 0
    keep = free[kind] | (low[kind] != high[kind]) | (tokens[place - 1] != low[kind])
    place, kind, depth = place[keep], kind[keep], depth[keep]
    by_kind = np.zeros(kinds, np.int64)
    by_kind[kind] = depth
    owner_depth = by_kind[owner_kind]
    found = []
    while len(place):
        least = np.full(kinds, np.iinfo(np.int64).max)
        np.minimum.at(least, owner_kind, item)
        goes_on = owner + owner_depth < sought.end[owner]
        word = np.where(goes_on, item_tokens[np.where(goes_on, owner + owner_depth, 0)], -1)
        of_owner, of_place = owner_kind * base + word, kind * base + tokens[place + depth]
        both = np.intersect1d(of_owner[word > 0], of_place)
        on = np.isin(of_place, both)
        found.append((place[~on], depth[~on], least[kind[~on]]))
        stay = (word > 0) & np.isin(of_owner, both)
        owner, owner_depth, item, owner_kind = owner[stay], owner_depth[stay] + 1, item[stay], np.searchsorted(both, of_owner[stay])
        place, depth, kind, kinds = place[on], depth[on] + 1, np.searchsorted(both, of_place[on]), len(both)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


FOUND = "spans array<struct<start:int,length:int>>, n_items long, items_sha256 string, items array<string>, longest struct<length:int,start:int,item:string>"


def findings(docs: DataFrame, sent, window: int, every: bool, lists: bool) -> DataFrame:
    """doc_id, row, n_words and FOUND of all documents, or of those with a hit; items themselves only with `lists`."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            f = shard_findings(batch.column("text"), sent.value, window)
            keep = np.arange(batch.num_rows) if every else f.rows
            here = np.isin(keep, f.rows)
            slot = np.where(here, np.searchsorted(f.rows, keep), 0)
            take = lambda values, kind: pa.array([values[k] if h else None for k, h in zip(slot.tolist(), here.tolist(), strict=True)], kind)  # noqa: E731, B023
            shas = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in f.sets]
            cuts = np.searchsorted(f.spans[:, 0], np.append(keep, batch.num_rows if not len(keep) else keep[-1] + 1))
            cuts[-1] = len(f.spans)
            spans = pa.StructArray.from_arrays([pa.array(f.spans[:, i].astype(np.int32)) for i in (1, 2)], ["start", "length"])
            best = [{"length": n, "start": a, "item": f.names[i]} for n, a, i in f.longest.tolist()]
            columns = [
                batch.column("doc_id").take(pa.array(keep)), batch.column("row").take(pa.array(keep)), pa.array(f.counts[keep].astype(np.int64)), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), spans),
                take([len(f.sets[k]) for k in f.kind], pa.int64()), take([shas[k] for k in f.kind], pa.string()), take([f.sets[k] for k in f.kind] if lists else [None] * len(f.kind), pa.list_(pa.string())),
                take(best, pa.struct([("length", pa.int32()), ("start", pa.int32()), ("item", pa.string())])),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_words", *[x.split()[0] for x in ("spans", "n_items", "items_sha256", "items", "longest")]])

    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    return rows.mapInArrow(search, f"doc_id {dict(docs.dtypes)['doc_id']}, row long, n_words long, {FOUND}")


def found_in(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`findings` of all documents in the whole benchmark, block by block if it is large."""
    context = docs.sparkSession.sparkContext
    number = block_count(benchmark, block_bytes)
    if number <= 1:
        return findings(docs, context.broadcast(suffixes(next(blocks(benchmark, block_bytes), []), window)), window, True, False)
    parts = []
    for block in blocks(benchmark, block_bytes):  # one block at a time is sent out, and let go before the next one is
        sent = context.broadcast(suffixes(block, window))
        parts.append(checkpoint(findings(docs, sent, window, False, True)))
        sent.destroy()
    longest = lambda x: F.struct((-x["length"]).alias("n"), x["start"].alias("start"), x["item"].alias("item"))
    merged = reduce(DataFrame.unionAll, parts).groupBy(F.col("doc_id").alias("_doc"), F.col("row").alias("_row")).agg(
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.min(longest(F.col("longest"))).alias("best"),
    )
    merged = checkpoint(merged.select(
        "_doc", "_row", "spans", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "items",
        F.struct((-F.col("best.n")).alias("length"), F.col("best.start").alias("start"), F.col("best.item").alias("item")).alias("longest"),
    ))
    every = findings(docs, context.broadcast(suffixes([], window)), window, True, False).select("doc_id", "row", "n_words")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_row"))
    return every.join(few(merged, merged.count()), same, "left").drop("_doc", "_row").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and of its longest match (the first
    in the document, then in item order) longest_match (words), longest_start (its first word, from 0), longest_item."""
    found = found_in(docs.select("doc_id", "text"), benchmark, window)
    return found.select(
        "doc_id",
        "n_words",
        hit_words("spans").alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.coalesce("longest.length", F.lit(0)).cast("long").alias("longest_match"),
        F.col("longest.start").cast("long").alias("longest_start"),
        F.col("longest.item").alias("longest_item"),
    )


def with_hits(docs: DataFrame, sent, window: int) -> DataFrame:
    """doc_id and row of the documents that have a hit in one block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            rows = pa.array(shard_findings(batch.column("text"), sent.value, window, detail=False).rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("row").take(rows)], ["doc_id", "row"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    return rows.mapInArrow(search, f"doc_id {dict(docs.dtypes)['doc_id']}, row long")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents, all columns as they are, without those that hold a benchmark window.

    Only doc_id and text pass through the search; the keys of the documents with a hit come back.
    """
    context, parts = docs.sparkSession.sparkContext, []
    for block in blocks(benchmark, BLOCK_BYTES):
        sent = context.broadcast(suffixes(block, window))
        parts.append(checkpoint(with_hits(docs, sent, window).distinct()))
        sent.destroy()
    if not parts:
        return docs
    hits = reduce(DataFrame.unionAll, parts).select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"))
    same = docs["doc_id"].eqNullSafe(F.col("_doc")) & (F.xxhash64(docs["text"]) == F.col("_row"))
    return docs.join(few(hits, hits.count()), same, "left_anti")
