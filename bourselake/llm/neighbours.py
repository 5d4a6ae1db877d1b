"""Nearest neighbours by an inverted file of coarse centroids with product-quantised residuals.

The number of lists follows the table: about the square root of its rows, `MAX_LISTS` at most. Training uses a bounded
sample (`SAMPLE` vectors for each list, those of smallest hashed id, so 64 x 1,024 at most): k-means centroids of unit
vectors, then k-means codebooks of the residuals' sub-vectors. The sample also tells how many lists a query must look
into: as few as hold `recall` of the true neighbours that sampled queries have in the sample. In clustered data these
are a few; in vectors without any structure, such as the given table's, near ones lie in most lists.

Every vector is put into the list of its nearest centroid. Lists are cut by hashed id into parts of about `PART_ROWS`
rows, so that a list with a third of all vectors is many groups, and the queries of a list into blocks of about
`QUERY_ROWS`. A query goes to the parts of its nearest lists; a part ranks its decoded codes for its queries and reranks
the best `shortlist` exactly, on the original vectors in double precision, and then all others that may still be nearer:
a cosine differs from that of the code by no more than the code's distance from its vector. What is broadcast is the
model and a radius for each list: their size is bounded by the parameters. `k` rows per query and part come back.

The sample only says where to look first. The k-th score found there is a query's bound, and the query then goes to
every other list with a vector within it by the triangle inequality. So the result is exact for any rows: in clustered
vectors the second search meets few lists, without structure all.

Defined cases: vectors that are null, of zero length or norm, of another dimension than most, or hold null or
non-finite components take no part, neither do rows without vec_id; scores that are equal to twelve digits are ties and
go to the smaller vec_id; rows that repeat a vec_id are candidates each, but never for a query of that vec_id; other
columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .shared import checkpoint

MAX_LISTS, SAMPLE = 1_024, 64
PART_ROWS, QUERY_ROWS = 2_000, 20_000
#: Queries of a part whose scores are held at once.
AT_ONCE = 128
#: More than the rounding of a score or a bound.
SLACK = 1e-9

#: Rows whose distances to all centres are held at a time while training.
ROWS_AT_ONCE = 4_096


class Model(NamedTuple):
    centroids: np.ndarray  # lists x dimensions
    codebooks: np.ndarray  # sub-spaces x codes x dimensions of a sub-space

    def decode(self, codes: np.ndarray, at: int) -> np.ndarray:
        return self.centroids[at] + np.concatenate([book[codes[:, j]] for j, book in enumerate(self.codebooks)], axis=1)

    def codes(self, unit: np.ndarray, lists: np.ndarray) -> np.ndarray:
        residual = unit - self.centroids[lists]
        m, codes, width = self.codebooks.shape
        out = np.empty((len(unit), m), np.uint8)
        for j in range(m):
            out[:, j] = nearest(residual[:, j * width : (j + 1) * width], self.codebooks[j])
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row; distances are held for some rows at a time."""
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.zeros(0, np.int64), *[(half - x[i : i + ROWS_AT_ONCE] @ centres.T).argmin(axis=1) for i in range(0, len(x), ROWS_AT_ONCE)]])


def k_means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm; a centre that loses all its points takes a random one."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        at = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        n = np.bincount(at, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], distinct[rng.integers(len(distinct), size=len(centres))])
    return centres


def train(sample: np.ndarray, lists: int, parts: int, codes: int = 256, rounds: int = 8, seed: int = 1) -> Model:
    """Centroids and codebooks from different unit vectors, a row each."""
    centroids = k_means(sample, lists, rounds, seed)
    residual = sample - centroids[nearest(sample, centroids)]
    parts = max(p for p in range(1, parts + 1) if sample.shape[1] % p == 0)
    books = [k_means(x, codes, rounds, seed + 1 + j) for j, x in enumerate(np.split(residual, parts, axis=1))]
    most = max(len(b) for b in books)  # a codebook with fewer distinct sub-vectors repeats its first
    return Model(centroids, np.stack([np.concatenate([b, np.repeat(b[:1], most - len(b), axis=0)]) for b in books]))


def enough_probes(sample: np.ndarray, centroids: np.ndarray, k: int, recall: float, most: int = 512) -> int:
    """How many nearest lists hold `recall` of the k nearest in the sample, by up to `most` of its vectors as queries."""
    k = min(k, len(sample) - 1)
    if not k:
        return len(centroids)
    own = np.arange(0, len(sample), -(-len(sample) // most))
    score = sample[own] @ sample.T
    score[np.arange(len(own)), own] = -np.inf
    near = np.argpartition(-score, k - 1, axis=1)[:, :k]
    turn = by_distance(sample[own], centroids).argsort(axis=1)  # of each list its place in the query's order
    there = np.take_along_axis(turn, nearest(sample, centroids)[near], axis=1)
    return int(np.quantile(there, recall, method="higher")) + 1


def by_distance(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Lists in the order of their distance, for each vector."""
    return ((centroids**2).sum(axis=1) / 2 - x @ centroids.T).argsort(axis=1, kind="stable")


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (floats if they are, else doubles) of the rows that take part."""
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0))


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rank(queries: tuple[np.ndarray, np.ndarray, np.ndarray], members: tuple[np.ndarray, np.ndarray], m: Model, at: int, k: int, shortlist: int) -> tuple[np.ndarray, ...]:
    """query_id, vec_id and score of the k best of one list's members (ids in order, unit vectors) for each query (ids,
    unit vectors, scores below which nothing counts)."""
    (q_ids, q, enough), (ids, x) = queries, members
    decoded = m.decode(m.codes(x, np.full(len(x), at)), at)
    error, out = np.sqrt(((x - decoded) ** 2).sum(axis=1)), []
    for i in range(0, len(q), AT_ONCE):
        own, now = q_ids[i : i + AT_ONCE], q[i : i + AT_ONCE]
        near, other = now @ decoded.T, own[:, None] != ids[None]
        near[~other] = -np.inf
        first = np.argpartition(-near, min(shortlist, len(ids)) - 1, axis=1)[:, :shortlist]
        found = np.where(np.take_along_axis(other, first, axis=1), (x[first] * now[:, None, :]).sum(axis=2), -np.inf)
        least = np.maximum(enough[i : i + AT_ONCE], kth(found, k)) - SLACK
        left = near + error >= least[:, None]  # what the bounds don't exclude
        column = left.any(axis=0).nonzero()[0]
        score = np.where(left[:, column], now @ x[column].T, -np.inf)
        row, col = (score >= np.maximum(least, kth(score, k) - SLACK)[:, None]).nonzero()
        col = column[col]
        score = (x[col] * now[row]).sum(axis=1)
        best = np.lexsort((ids[col], -score.round(12), row))
        row, col, score = row[best], col[best], score[best]
        top = np.arange(len(row)) - np.searchsorted(row, row) < k
        out.append((own[row[top]], ids[col[top]], score[top]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def kth(score: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, -inf if there are fewer."""
    return -np.partition(-score, k - 1, axis=1)[:, k - 1] if score.shape[1] >= k else np.full(len(score), -np.inf)


def search(vectors: DataFrame, is_query: Column, k: int = 5, lists: int | None = None, recall: float = 0.97, parts: int = 16, shortlist: int = 32, part_rows: int = PART_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine) of the k nearest that are found for each row of `is_query`."""
    result = "query_id long, rank int, vec_id long, score double"
    spark, own = vectors.sparkSession, usable(vectors)
    size = own.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return spark.createDataFrame([], result)
    own = own.where(F.size("embedding") == size["n"])
    lists = lists or int(np.clip(round(size["count"] ** 0.5), 16, MAX_LISTS))
    rows = own.select("embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE * lists).toArrow()["embedding"].combine_chunks()
    sample = np.unique(unit(matrix(rows)), axis=0)
    trained = train(sample, lists, parts)
    probes = enough_probes(sample, trained.centroids, k, recall)
    model = spark.sparkContext.broadcast(trained)
    asking = own.where(is_query)

    def places(batch: pa.RecordBatch, most: int, beyond: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the batch and their nearest lists; with radii those beyond these that may hold what isn't found yet."""
        x, centroids = unit(matrix(batch.column("embedding"))), model.value.centroids
        order = by_distance(x, centroids)
        if beyond is None:
            at = order[:, :most]
            return np.repeat(np.arange(len(at)), at.shape[1]), at.ravel()
        apart = np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (centroids**2).sum(axis=1) - 2 * x @ centroids.T, 0))
        may = 1 - np.maximum(apart - beyond[: len(centroids)] - SLACK, 0) ** 2 / 2 >= batch.column("least").to_numpy()[:, None] - SLACK
        np.put_along_axis(may, order[:, :most], False, axis=1)
        return may.nonzero()

    def counted(rows: DataFrame, most: int, beyond: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """How many of the rows go to each list, and the largest distance of one from its centroid."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, radius = np.zeros(lists, np.int64), np.zeros(lists)
            for batch in batches:
                if batch.num_rows:
                    row, at = places(batch, most, beyond)
                    sums += np.bincount(at, minlength=lists)
                    if beyond is None and most == 1:
                        np.maximum.at(radius, at, np.sqrt(((unit(matrix(batch.column("embedding"))) - model.value.centroids[at]) ** 2).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(lists)), pa.array(sums), pa.array(radius)], ["list", "n", "radius"])

        out = np.zeros(lists, np.int64), np.zeros(lists)
        for r in rows.mapInArrow(count, "list long, n long, radius double").groupBy("list").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect():  # a row per list
            out[0][r["list"]], out[1][r["list"]] = r["n"], r["radius"]
        return out

    n_members, radii = counted(own, 1)
    cuts = np.maximum(-(-n_members // part_rows), 1)  # the cuts of each list follow its size

    def to_cells(most: int, blocks: np.ndarray, of_members: bool, beyond: np.ndarray | None = None):
        """A cell is a part of a list's members with a block of its queries."""
        first = np.concatenate([[0], np.cumsum(cuts * blocks)])

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                row, at = places(batch, most, beyond)
                drawn = W.mix(batch.column("vec_id").to_numpy().view(np.uint64).copy())[row]
                part, block = (drawn % cuts[at].astype(np.uint64)).astype(np.int64), (drawn % np.maximum(blocks[at], 1).astype(np.uint64)).astype(np.int64)
                times = (blocks if of_members else cuts)[at]
                step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, at, part, block = (np.repeat(v, times) for v in (row, at, part, block))
                cell = first[at] + (part * blocks[at] + step if of_members else step * blocks[at] + block)
                for i in range(0, len(row), 10_000):
                    yield batch.take(pa.array(row[i : i + 10_000])).append_column("list", pa.array(at[i : i + 10_000].astype(np.int32))).append_column("cell", pa.array(cell[i : i + 10_000]))

        return deal

    kind = f"vec_id long, embedding {dict(own.dtypes)['embedding']}"
    best = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def in_order(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
        return rows["vec_id"].to_numpy()[order], unit(matrix(rows["embedding"].combine_chunks())[order])

    def scan(key, queries, members):
        if not len(queries) or not len(members):
            return best.empty_table()
        asked = queries["vec_id"].to_numpy(), unit(matrix(queries["embedding"].combine_chunks())), queries["least"].to_numpy()
        found = rank(asked, in_order(members), model.value, members["list"][0].as_py(), k, shortlist)
        return pa.Table.from_arrays([pa.array(c) for c in found], schema=best)

    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "vec_id")

    def nearest_of(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def looked_up(asking: DataFrame, beyond: np.ndarray | None = None) -> DataFrame:
        """The k best in the parts of each query's nearest lists, or (with radii) of the others that may hold nearer ones."""
        blocks = -(-counted(asking, probes, beyond)[0] // query_rows)  # none where no query goes: such lists stay out
        indexed = own.mapInArrow(to_cells(1, blocks, True), f"{kind}, list int, cell long")
        asked = asking.mapInArrow(to_cells(probes, blocks, False, beyond), f"{kind}, least double, list int, cell long")
        return asked.groupBy("cell").cogroup(indexed.groupBy("cell")).applyInArrow(scan, "query_id long, vec_id long, score double")

    first = checkpoint(nearest_of(looked_up(asking.withColumn("least", F.lit(-2.0)))).select("query_id", "vec_id", "score", "rank"))
    bounds = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    again = checkpoint(asking.join(bounds, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(-2.0))))
    found = first.drop("rank").unionByName(looked_up(again, radii))
    return nearest_of(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
