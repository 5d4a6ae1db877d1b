"""Quality scores: ridge regression on random Fourier features of document statistics, then isotonic calibration.

Statistics of every whole text are computed once. Random cosine features of the standardised statistics stand for a
Gaussian kernel; each task adds up the normal equations of its labelled rows, partial sums of fixed size meet `FAN_IN`
at a time in the order of their partitions, and a system of fixed size (FEATURES squared) is solved on the driver.
Labels never leave that sum. The training rows are
dealt by crc32 of doc_id: remainder 0 of 5 is held out, remainders 1 to 3 fit the ridge, remainder 4 calibrates it:
sums per score bin (`BINS`, fixed) give a monotone fit by pooling adjacent violators.

Inputs of a score are the statistics of the text alone.

Defined cases: null and empty texts have statistics (all zero) and a score; a null doc_id is scored and not held
out; labels that are null, or differ for one doc_id, are left out of the fit; without any usable label every score
is 0.5; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .shared import checkpoint

FEATURES, BINS = 192, 400
#: Partial sums that one task adds up, and that reach the driver at most.
FAN_IN = 16
#: Score at which a document is predicted to be good.
GOOD = 0.3

_b = np.arange(256)
_UPPER = (_b >= 65) & (_b <= 90)
_LETTER = ((_b | 32) >= 97) & ((_b | 32) <= 122) | (_b >= 128)
_DIGIT = (_b >= 48) & (_b <= 57)
_STOP = np.isin(_b, list(b".,;:?"))
_BANG = _b == ord("!")
_SYMBOL = (_b > 32) & (_b < 127) & ~_LETTER & ~_DIGIT & ~_STOP & ~_BANG
STATISTICS = ("log_words", "log_word_length", "word_length_deviation", "upper", "letters", "digits", "stops", "bangs", "symbols", "not_ascii", "lines_per_word", "distinct", "commonest", "repeats", "repeated_pairs", "capitals", "symbol_ends", "spaces")


def statistics(t: W.Texts) -> np.ndarray:
    """A row of STATISTICS for each text."""
    w = t.words(W.NOT_SPACE)
    rows, n = len(t.offsets) - 1, w.counts()
    size, some = np.maximum(np.diff(t.offsets), 1), np.maximum(n, 1)
    share = lambda table: W.per_row(table[t.data], t.offsets) / size
    lengths = (w.ends - w.starts).astype(np.float64)
    add = lambda values: np.bincount(row, values, rows)
    row = w.row_of()
    mean = add(lengths) / some
    spread = np.sqrt(np.maximum(add(lengths**2) / some - mean**2, 0))
    ids = w.hashes() if len(w.starts) else np.zeros(0, np.uint64)
    new_row = np.diff(row, prepend=-1) != 0
    again = np.zeros(len(ids), bool)
    again[1:] = (ids[1:] == ids[:-1]) & ~new_row[1:]
    distinct, most = _kinds(ids, row, rows)
    pairs, pair_row = W.mix(ids[:-1] ^ (ids[1:] * np.uint64(3)))[~new_row[1:]], row[1:][~new_row[1:]]
    pair_kinds, _ = _kinds(pairs, pair_row, rows)
    pair_count = np.maximum(np.bincount(pair_row, minlength=rows), 1)
    first, last = t.data[w.starts], t.data[w.ends - 1]
    lines = np.bincount(np.searchsorted(t.offsets, np.flatnonzero(t.data == 10), "right") - 1, minlength=rows) if len(t.data) else np.zeros(rows)
    columns = [
        np.log1p(n), np.log1p(mean), spread / (1 + mean), share(_UPPER), share(_LETTER), share(_DIGIT), share(_STOP), share(_BANG), share(_SYMBOL), share(_b >= 128),
        lines / some, distinct / some, most / some, add(again) / some, np.where(n > 1, 1 - pair_kinds / pair_count, 0), add(_UPPER[first]) / some, add(_SYMBOL[last] | _BANG[last]) / some, share(~W.NOT_SPACE),
    ]
    return np.column_stack(columns)


def _kinds(ids: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many different ids, and how often the commonest."""
    order = np.lexsort((ids, row))
    ids, row = ids[order], row[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(new)
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, row[start], np.diff(np.append(start, len(ids))))
    return np.bincount(row[start], minlength=rows), most


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # statistics x FEATURES
    phases: np.ndarray
    ridge: np.ndarray
    knots: np.ndarray  # raw score and calibrated score of each isotonic block
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.weights + self.phases) * np.sqrt(2 / FEATURES)
        return np.column_stack([np.ones(len(x)), z, waves])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.ridge

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.values) if len(self.knots) else np.full(len(x), 0.5)


def summed(rows: DataFrame, compute, length: int) -> np.ndarray:
    """Sum over all partitions of vectors of a fixed length that `compute` makes of batches; zeros for no rows.

    Added up in the order of partitions, `FAN_IN` at a time, so that equal partitions give equal sums.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = compute(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["part", "total"])

    def add(key, table):
        total = in_order(table.to_pylist(), length)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "total": pa.array([total.tobytes()], pa.binary())})

    some = checkpoint(rows.mapInArrow(partial, "part long, total binary"))
    while some.count() > FAN_IN:
        some = checkpoint(some.groupBy(F.floor(F.col("part") / FAN_IN).alias("of")).applyInArrow(add, "part long, total binary"))
    return in_order([r.asDict() for r in some.collect()], length)


def in_order(parts: list[dict], length: int) -> np.ndarray:
    total = np.zeros(length)
    for r in sorted(parts, key=lambda r: r["part"]):
        total += np.frombuffer(r["total"])
    return total


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("statistics").flatten().to_numpy().reshape(batch.num_rows, len(STATISTICS))


def pool(score: np.ndarray, total: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order of score: mean score and mean label of each block."""
    blocks: list[list[float]] = []
    for s, t, c in zip(score, total, count, strict=True):
        blocks.append([s * c, t, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    sums = np.array(blocks).reshape(-1, 3)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


def fit(labelled: DataFrame, gamma: float = 0.04, penalty: float = 1e-2, seed: int = 5) -> Model:
    """`labelled`: statistics, label (0 or 1) and fold (1 to 4)."""
    k, rng = len(STATISTICS), np.random.default_rng(seed)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch)
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    sums = summed(labelled, moments, 1 + 2 * k)
    n = max(sums[0], 1)
    mean = sums[1 : 1 + k] / n
    scale = np.sqrt(np.maximum(sums[1 + k :] / n - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1), rng.normal(scale=np.sqrt(2 * gamma), size=(k, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(1 + k + FEATURES), np.zeros(0), np.zeros(0))
    width = len(model.ridge)

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z, y = model.features(matrix(batch)), batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = summed(labelled.where("fold < 4"), equations, width * (width + 1))
    a, b = sums[: width * width].reshape(width, width), sums[width * width :]
    if not a[0, 0]:
        return model
    model = model._replace(ridge=np.linalg.solve(a + penalty * a[0, 0] * np.eye(width) / width + 1e-9 * np.eye(width), b))

    def bins(batch: pa.RecordBatch) -> np.ndarray:
        raw, y = model.raw(matrix(batch)), batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        at = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, v, BINS) for v in (raw, y, np.ones(len(y)))])

    raw, total, count = summed(labelled.where("fold = 4"), bins, 3 * BINS).reshape(3, BINS)
    there = count > 0
    if not there.any():
        return model._replace(knots=np.array([0.0, 1.0]), values=np.array([0.0, 1.0]))
    knots, values = pool(raw[there] / count[there], total[there], count[there])
    # straight lines between the blocks keep the order of scores; beyond the last block they run on to 0 and 1
    return model._replace(knots=np.concatenate([[min(knots[0], 0) - 1], knots, [max(knots[-1], 1) + 1]]), values=np.concatenate([[0], values, [1]]))


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, held_out, score (0 to 1), predicted."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            x = statistics(W.texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["doc_id", "statistics"])

    measured = checkpoint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(measure, "doc_id long, statistics array<double>"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"), remainder(F.col("doc_id")).alias("fold"))
    known = known.where("label in (0, 1) and fold <> 0").groupBy("doc_id", "fold").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    labelled = measured.join(known, "doc_id").sortWithinPartitions("doc_id", "statistics")
    labelled = checkpoint(labelled.select("statistics", "label", "fold"))
    model = docs.sparkSession.sparkContext.broadcast(fit(labelled))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(model.value.score(matrix(batch)), 0, 1))], ["doc_id", "score"])

    rated = measured.mapInArrow(rate, "doc_id long, score double")
    return rated.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
