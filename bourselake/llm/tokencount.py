"""Token counts under a unigram model, by dynamic programming shared along a trie of pre-tokens.

Each task takes the distinct pre-tokens of its batch of documents, sorts them, so that neighbours share prefixes,
and reads the trie off the sorted order: a new node wherever a pre-token leaves the one before it. The forward
score of a node (the best log-probability of its prefix, and how many pieces that takes) is computed once, depth by
depth for all nodes together; the score at a pre-token's end is its count, and documents add these up. There is no
shuffle, and a pre-token that a third of the corpus repeats costs one lookup.

Pieces come from a vocabulary file of ranked byte strings (base64 and rank per line). It has no probabilities, and
none are trained: a piece's probability falls with its rank by Zipf's law, single bytes rank last.

Pre-tokens: maximal runs of one kind (ASCII white space, digits, letters with all bytes above 127, the rest), with
one space before them if there is one. Together they are the whole text. A run of more than `LONG_BYTES` (text without
spaces, base64) is hardly ever a prefix of another, but it has places that no piece reaches across, as the bytes around
them stand together in no piece. Every segmentation breaks there, so the run is cut there and its distinct parts go into a
trie of their own; a run's score is the sum of its parts'. A part without such a place for more than `LONG_BYTES` (one
letter repeated) is a trie with a single branch: its forward scores are computed along it, a stretch at a time, with the
last scores carried over, to the same result. Both look pieces up alike (`endings`): long pieces only where the last few
bytes are those of a long piece.

Defined cases: a null or empty text has no pre-tokens and no tokens; runs of any length are segmented whole; repeated
rows are counted each; other columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

#: Longer pre-tokens are cut; what can't be is scored alone, so many bytes at a time. Parts of so many bytes share a trie.
LONG_BYTES, STRETCH, CUT_BYTES = 192, 1 << 18, 4 << 20
#: Pieces longer than so many bytes are looked for only where that many last bytes are right.
TAILS = (3, 4, 6, 8, 12, 16, 32, 64)
#: Distinct pre-tokens of about so many bytes of text are put in one trie.
TRIE_BYTES = 32 << 20

_b = np.arange(256)
KIND = np.select([~W.NOT_SPACE, (_b >= 48) & (_b <= 57), ((_b | 32) >= 97) & ((_b | 32) <= 122) | (_b >= 128)], [0, 1, 2], 3).astype(np.int8)


class Model(NamedTuple):
    """Hashes of all pieces in order, their scores, the piece lengths there are, a filter on the hashes' high bits,
    filters on the last bytes of longer pieces, the pieces of two bytes, and (as bits) any three bytes within a piece."""

    hashes: np.ndarray
    scores: np.ndarray
    lengths: tuple[int, ...]
    maybe: np.ndarray
    tails: dict[int, np.ndarray]
    pairs: np.ndarray
    triples: np.ndarray


def read_vocabulary(path: str) -> dict[bytes, float]:
    """Log-probability by piece."""
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path).read_bytes().splitlines() if line)}
    last = max(ranks.values()) + 1
    weight = {p: 1 / (3 + (last if len(p) == 1 else r)) for p, r in ranks.items()}
    total = math.log(sum(weight.values()))
    return {p: math.log(w) - total for p, w in weight.items()}


def compile_model(vocabulary: dict[bytes, float]) -> Model:
    if missing := [b for b in range(256) if bytes([b]) not in vocabulary]:
        raise ValueError(f"the vocabulary lacks the bytes {missing[:5]}...")
    pieces = list(vocabulary)
    ends = np.cumsum([len(p) for p in pieces])
    hashes = W.span_hash(np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], ends[:-1]]), ends)
    order = np.argsort(hashes)
    maybe = np.zeros(1 << 22, bool)
    maybe[hashes >> np.uint64(42)] = True
    sizes, tails, joined = np.array([len(p) for p in pieces]), {}, np.frombuffer(b"".join(pieces), np.uint8)
    for n in TAILS:
        tails[n] = np.zeros(1 << 20, bool)
        tails[n][W.span_hash(joined, ends[sizes > n] - n, ends[sizes > n]) >> np.uint64(44)] = True
    pairs, triples = np.zeros(1 << 16, bool), np.zeros(1 << 24, bool)
    wide = joined.astype(np.int32)
    pairs[wide[ends[sizes == 2] - 2] << 8 | wide[ends[sizes == 2] - 1]] = True
    within = np.ones(len(wide), bool)  # where three bytes of one piece begin
    within[np.concatenate([ends - 1, (ends - 2)[sizes > 1]])] = False
    at = np.flatnonzero(within)
    triples[wide[at] << 16 | wide[at + 1] << 8 | wide[at + 2]] = True
    return Model(hashes[order], np.array([vocabulary[p] for p in pieces])[order], tuple(sorted(set(sizes.tolist()))), maybe, tails, pairs, np.packbits(triples, bitorder="little"))


class Spans(NamedTuple):
    """Prefix sums of some bytes, from which the hash of any span of them follows."""

    total: np.ndarray
    down: np.ndarray

    def hash(self, stop: np.ndarray, size: int) -> np.ndarray:
        begin = stop - size
        return W.mix((self.total[stop] - self.total[begin]) * self.down[begin] + np.uint64(size * W._BASES[1] & (1 << 64) - 1))


def spans(data: np.ndarray) -> Spans:
    up, down = W._powers(W._BASES[0], len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return Spans(total, down)


def endings(s: Spans, stop: np.ndarray, room: int | np.ndarray, model: Model) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: which of the places `stop` a piece of that length ends at, and its score. A piece has `room` bytes at most."""
    live, checked = np.arange(len(stop)), 0
    for k in model.lengths:
        for n in TAILS:
            if checked < n < k and len(live):
                live = live[(room if np.isscalar(room) else room[live]) > n]
                live = live[model.tails[n][s.hash(stop[live], n) >> np.uint64(44)]]
                checked = n
        own = live if np.isscalar(room) and room >= k else live[(room if np.isscalar(room) else room[live]) >= k]
        if not len(own):
            return
        h = s.hash(stop[own], k)
        may = np.flatnonzero(model.maybe[h >> np.uint64(42)])
        at = np.minimum(np.searchsorted(model.hashes, h[may]), len(model.hashes) - 1)
        hit = model.hashes[at] == h[may]
        yield k, own[may[hit]], model.scores[at[hit]]


def pre_tokens(t: W.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all pre-tokens of a slice, and how many each row has."""
    data, n = t.data, len(t.data)
    first = np.zeros(n + 1, bool)
    first[t.offsets] = True
    kind = KIND[data]
    cut = first[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    joins = np.flatnonzero((kind[starts] != 0) & ~first[starts] & (data[starts - 1] == 32)) if n else starts
    starts[joins] -= 1
    ends[joins - 1] -= 1
    there = ends > starts
    starts, ends = starts[there], ends[there]
    rows = np.searchsorted(starts, t.offsets)
    return starts, ends, np.diff(rows)


def trie_scores(tokens: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct token: the number of pieces and the log-probability of its best segmentation."""
    order = sorted(range(len(tokens)), key=tokens.__getitem__)
    lengths = np.array([len(tokens[i]) for i in order])
    data = np.frombuffer(b"".join(tokens[i] for i in order), np.uint8)
    starts = np.cumsum(lengths) - lengths
    shared = np.zeros(len(order), np.int64)  # bytes that a token has in common with the one before it
    alike = np.arange(1, len(order))
    for d in range(int(lengths.max())):
        alike = alike[(lengths[alike] > d) & (lengths[alike - 1] > d)]
        alike = alike[data[starts[alike] + d] == data[starts[alike - 1] + d]]
        shared[alike] += 1
    hashed = spans(data)
    deepest = max(model.lengths)
    ring = deepest + 1
    score, pieces = np.zeros((ring, len(order))), np.zeros((ring, len(order)), np.int32)
    out_pieces, out_score = np.zeros(len(order), np.int32), np.zeros(len(order))
    active = np.arange(len(order))
    for d in range(1, int(lengths.max()) + 1):
        active = active[lengths[active] >= d]
        new = shared[active] < d  # the first token of each node; those after it share what is computed for it
        node = active[new]
        best, count = np.full(len(node), -np.inf), np.zeros(len(node), np.int32)
        for k, at, gain in endings(hashed, starts[node] + d, d, model):
            own = score[(d - k) % ring, node[at]] + gain
            c = pieces[(d - k) % ring, node[at]] + 1
            better = (own > best[at]) | (own == best[at]) & (c < count[at])
            best[at[better]], count[at[better]] = own[better], c[better]
        which = np.cumsum(new) - 1
        score[d % ring, active], pieces[d % ring, active] = best[which], count[which]
        done = lengths[active] == d
        out_score[active[done]], out_pieces[active[done]] = best[which[done]], count[which[done]]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return out_pieces[back], out_score[back]


def run_score(run: bytes, model: Model) -> tuple[int, float]:
    """The number of pieces and the log-probability of the best segmentation of one run of any length."""
    reach = max(model.lengths)
    score, pieces = [0.0], [0]  # of the prefixes that end in the last `reach` bytes before a stretch
    for at in range(0, len(run), STRETCH):
        begin = at + 1 - len(score)
        data = np.frombuffer(run, np.uint8, min(len(run), at + STRETCH) - begin, begin)
        stop = np.arange(at - begin + 1, len(data) + 1)
        froms, ends, gains = [], [], []
        for k, where, gain in endings(spans(data), stop, stop, model):
            froms.append(stop[where] - k)
            ends.append(where)
            gains.append(gain)
        order = np.argsort(np.concatenate(ends), kind="stable")
        last = np.searchsorted(np.concatenate(ends)[order], np.arange(1, len(stop) + 1)).tolist()
        froms, gains = np.concatenate(froms)[order].tolist(), np.concatenate(gains)[order].tolist()
        j = 0
        for b in last:
            i = froms[j]  # single bytes are pieces, so there is one
            best = score[i] + gains[j]
            for j in range(j + 1, b):
                s = score[froms[j]] + gains[j]
                if s > best or s == best and pieces[froms[j]] < pieces[i]:
                    best, i = s, froms[j]
            j = b
            score.append(best)
            pieces.append(pieces[i] + 1)
        score, pieces = score[-reach:], pieces[-reach:]
    return pieces[-1], score[-1]


def breaks(data: np.ndarray, model: Model) -> np.ndarray:
    """Of each place between two bytes (the first is before the second byte): reaches no piece across it?"""
    out = np.zeros(max(len(data) - 1, 0), bool)
    for at in range(0, len(out), CUT_BYTES):
        from_, to = max(at - 1, 0), min(at + CUT_BYTES, len(out))
        wide = data[from_ : to + 2].astype(np.int32)
        code = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
        joined = (model.triples[code >> 3] >> (code & 7) & 1).astype(bool)
        across = model.pairs[wide[:-1] << 8 | wide[1:]]
        across[:-1] |= joined
        across[1:] |= joined
        out[at:to] = ~across[at - from_ : to - from_]
    return out


def cut_scores(runs: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Of each run the number of pieces and the log-probability, summed over the parts between its breaks."""
    data = np.frombuffer(b"".join(runs), np.uint8)
    lasts = np.cumsum([len(r) for r in runs])
    stops = np.zeros(len(data), bool)  # the last byte of each part
    stops[:-1] = breaks(data, model)
    stops[lasts - 1] = True
    out_pieces, out_score, begin = np.zeros(len(runs), np.int64), np.zeros(len(runs)), 0
    while begin < len(data):
        at = min(begin + CUT_BYTES, len(data)) - 1
        to = at + int(np.argmax(stops[at:])) + 1
        ends = begin + np.flatnonzero(stops[begin:to]) + 1
        starts = np.concatenate([[begin], ends[:-1]])
        _, first, which = np.unique(W.span_hash(data[begin:to], starts - begin, ends - begin), return_index=True, return_inverse=True)
        parts = [data[a:b].tobytes() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        pieces, score = np.zeros(len(parts), np.int64), np.zeros(len(parts))
        if short := [i for i, t in enumerate(parts) if len(t) <= LONG_BYTES]:
            pieces[short], score[short] = trie_scores([parts[i] for i in short], model)
        for i, t in enumerate(parts):
            if len(t) > LONG_BYTES:
                pieces[i], score[i] = run_score(t, model)
        run = np.searchsorted(lasts, ends)
        np.add.at(out_pieces, run, pieces[which])
        np.add.at(out_score, run, score[which])
        begin = to
    return out_pieces, out_score


def count_batch(batch: pa.RecordBatch, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: pre-tokens, tokens, log-probability."""
    hashes, each, distinct = [], [], {}
    for part in W.slices(iter([batch]), "text"):
        t = W.texts(part.column("text"))
        starts, ends, n = pre_tokens(t)
        h = W.span_hash(t.data, starts, ends)
        own, first = np.unique(h, return_index=True)
        raw = t.data.tobytes()
        distinct |= dict(zip(own.tolist(), [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], strict=True))
        hashes.append(h)
        each.append(n)
    n = np.concatenate(each)
    if not distinct:
        return n, np.zeros(len(n), np.int64), np.zeros(len(n))
    known = np.fromiter(distinct, np.uint64, len(distinct))
    tokens = list(distinct.values())
    pieces, score = np.zeros(len(tokens), np.int64), np.zeros(len(tokens))
    if short := [i for i, t in enumerate(tokens) if len(t) <= LONG_BYTES]:
        pieces[short], score[short] = trie_scores([tokens[i] for i in short], model)
    if long := [i for i, t in enumerate(tokens) if len(t) > LONG_BYTES]:
        pieces[long], score[long] = cut_scores([tokens[i] for i in long], model)
    order = np.argsort(known)
    at = order[np.searchsorted(known[order], np.concatenate(hashes))]
    rows = np.concatenate([[0], np.cumsum(n)])
    return n, W.per_row(pieces[at], rows), np.bincount(np.repeat(np.arange(len(n)), n), score[at], len(n))


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row: doc_id, n_pretokens, n_tokens, log_probability (of the whole text, rounded to 6 digits).

    `vocabulary` is read on the driver; the compiled model, of a size fixed by the file, is broadcast.
    """
    model = docs.sparkSession.sparkContext.broadcast(compile_model(read_vocabulary(vocabulary)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text", TRIE_BYTES):
            n, tokens, score = count_batch(batch, model.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(tokens, pa.int64()), pa.array(score.round(6))], ["doc_id", "n_pretokens", "n_tokens", "log_probability"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "doc_id long, n_pretokens long, n_tokens long, log_probability double")
