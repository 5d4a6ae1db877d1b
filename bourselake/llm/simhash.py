"""SimHash fingerprints, Burkhard-Keller trees over shards of them, and groups of near duplicates.

Two fingerprints of 64 bits that differ in at most 3 agree in one of four 16-bit blocks at least, so each distinct
fingerprint goes to four shards, one per block value. A shard with more than `SHARD_ROWS` fingerprints is split by
the same rule on the bits its members may still differ in, and again: exact at every size. In each shard a BK-tree
(children keyed by their Hamming distance to the parent) is searched for a fingerprint's neighbours, following only
edges within the radius, before the fingerprint is inserted; of the links found, those that join two groups of the
shard are kept. A spanning forest has the same components as all links, so no pair list is made for large groups.

The trees hold the fingerprints of the whole corpus, so they are not broadcast: fingerprints and trees meet by a
shuffle on the shard.

`near_duplicates` is the pipeline's stage: five-word shingles and a Jaccard similarity of 0.8, where fingerprints
differ in about ten bits. There the shards are min-hash bands, the trees are searched with a wider radius, and links
are checked on the shingle sets. Links that passed join texts to checked groups; then, in every band shard whose
candidates the trees did not all link, each two candidates of different checked groups are tested.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas import types as T

from . import words as W
from .shared import checkpoint

SEED = 42
RADIUS = 3
#: A shard with more fingerprints than this is split, up to LEVELS times.
SHARD_ROWS, LEVELS = 512, 3


def shingle_spans(w: W.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word of each shingle, and how many each row has: all runs of k words, or the whole of a shorter row."""
    n = w.counts()
    each = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    first = np.repeat(w.rows[:-1] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    return first, first + np.repeat(np.minimum(n, k), each) - 1, each


def shingle_hashes(w: W.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, its words joined by one space, and the number of shingles per row."""
    data, starts, ends = w.joined()
    first, last, each = shingle_spans(w, k)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[first].tolist(), ends[last].tolist(), strict=True)
    return np.fromiter((digest(data[a:b], SEED) for a, b in spans), np.uint64, len(first)), each


def majority(hashes: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Per row the 64 bits that are set in over half of its hashes; eight counters of a byte are added up at once."""
    if not len(hashes):
        return np.zeros(len(each), np.uint64)
    rows = np.flatnonzero(each)
    parts = (each[rows] + 254) // 255  # a byte counts to 255
    ends = np.cumsum(each[rows])
    within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    cuts = np.repeat(ends - each[rows], parts) + 255 * within
    row_cuts = np.cumsum(parts) - parts
    bits = np.zeros(len(rows), np.uint64)
    lanes = np.uint64(0x0101010101010101)
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & lanes, cuts)
        counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), row_cuts, axis=0)
        over = (2 * counts > each[rows][:, None]).astype(np.uint64)
        bits |= (over << (8 * np.arange(8) + k).astype(np.uint64)).sum(axis=1, dtype=np.uint64)
    out = np.zeros(len(each), np.uint64)
    out[rows] = bits
    return out


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fingerprint (its 64 bits as a long) of every row; a text without words has 0."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            w = W.texts(batch.column("text")).words(W.NOT_SPACE, lower=True)
            prints = majority(*shingle_hashes(w, shingle))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(compute, "doc_id long, fingerprint long")


def block_masks(bits: list[int], blocks: int, levels: int) -> list[tuple[int, list]]:
    """Masks over `blocks` equal parts of the bits, and for each of them the masks that split it further."""
    out = []
    for part in np.array_split(np.array(bits), blocks):
        rest = [b for b in bits if b not in part]
        below = block_masks(rest, blocks, levels - 1) if levels > 1 else []
        own = sum(1 << int(b) for b in part)
        out.append((own, [(own | m, s) for m, s in below]))
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shards(prints: DataFrame, radius: int = RADIUS, most: int = SHARD_ROWS) -> DataFrame:
    """Columns of `prints` (fingerprint and others) once for every shard: mask, value."""
    level = block_masks(list(range(64)), radius + 1, LEVELS)
    todo = prints.select("*", F.explode(F.array(*[F.lit(_signed(m)) for m, _ in level])).alias("mask"))
    todo = todo.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
    out = None
    for depth in range(LEVELS):
        if depth == LEVELS - 1:
            done = todo
        else:
            large = todo.groupBy("mask", "value").count().where(F.col("count") > most).drop("count")
            done = todo.join(large, ["mask", "value"], "left_anti").select(todo.columns)
            rest = todo.join(large, ["mask", "value"], "left_semi").select(todo.columns)
            below = F.create_map(*[x for m, s in level for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c, _ in s]))])
            todo = rest.withColumn("mask", F.explode(below[F.col("mask")]))
            todo = todo.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
            level = [c for _, s in level for c in s]
        out = done if out is None else out.unionByName(done)
    return out


class Tree:
    """A BK-tree of 64-bit numbers; each node is [number, place, children by distance]."""

    def __init__(self, radius: int):
        self.radius, self.root = radius, None

    def near(self, number: int, radius: int | None = None, enough: int | None = None) -> list[int]:
        """Places of the numbers within the radius, or of the first `enough` of them."""
        found, stack, r = [], [self.root] if self.root else [], self.radius if radius is None else radius
        while stack and len(found) != enough:
            own, place, children = stack.pop()
            d = (own ^ number).bit_count()
            if d <= r:
                found.append(place)
            if len(children) > 2 * r:
                stack += [children[x] for x in range(d - r, d + r + 1) if x in children]
            else:
                stack += [c for x, c in children.items() if -r <= x - d <= r]
        return found

    def insert(self, number: int, place: int) -> None:
        node = self.root
        if node is None:
            self.root = [number, place, {}]
            return
        while True:
            d = (node[0] ^ number).bit_count()
            if d not in node[2]:
                node[2][d] = [number, place, {}]
                return
            node = node[2][d]


def forest(numbers: list[int], radius: int, spare: int = 0) -> list[tuple[int, int]]:
    """Places of linked numbers: one link for each two groups that a number joins, and its `spare` nearest.

    With `spare`, a number that has so many neighbours within a sixth of the radius looks no further, so a shard full
    of near copies costs about as many steps as it has members. These links are then no forest of all candidates.
    """
    links: list[tuple[int, int]] = []
    if len(numbers) < 2:
        return links
    group = list(range(len(numbers)))

    def top(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    tree = Tree(radius)
    for i, number in enumerate(numbers):
        near = tree.near(number, radius // 6, spare) if spare else []
        if len(near) < max(spare, 1):
            near = tree.near(number)
        if spare:
            near.sort(key=lambda j: (numbers[j] ^ number).bit_count())
        for k, j in enumerate(near):
            a, b = top(i), top(j)
            if a != b:
                group[a] = b
            if a != b or k < spare:
                links.append((i, j))
        tree.insert(number, i)
    return links


def by_shard(batches: Iterator[pa.RecordBatch], key: list[str], node: str) -> Iterator[tuple[list, list, list[int]]]:
    """Key, nodes and fingerprints of each shard of two or more, of batches sorted by the key."""
    shard, nodes, numbers = None, [], []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*key, node)]
        bits = batch.column("fingerprint").to_numpy().view(np.uint64).tolist()
        for *at, n, number in zip(*columns, bits, strict=True):
            if at != shard:
                if len(nodes) > 1:
                    yield shard, nodes, numbers
                shard, nodes, numbers = at, [], []
            nodes.append(n)
            numbers.append(number)
    if len(nodes) > 1:
        yield shard, nodes, numbers


def links(sharded: DataFrame, key: list[str], node: str, radius: int) -> DataFrame:
    """Links (a, b) of nodes of one shard whose fingerprints are within the radius: a spanning forest of each shard."""
    kind = dict(sharded.dtypes)[node]
    own = T.to_arrow_type(sharded.schema[node].dataType)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, nodes, numbers in by_shard(batches, key, node):
            if found := forest(numbers, radius):
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in a], own), pa.array([nodes[i] for i in b], own)], ["a", "b"])

    in_shards = sharded.select(*key, node, "fingerprint").repartition(*key).sortWithinPartitions(*key, "fingerprint", node)
    return in_shards.mapInArrow(search, f"a {kind}, b {kind}")


def first_links(sharded: DataFrame) -> DataFrame:
    """Links (a, b) of each band shard that are tested first: a spanning forest and SPARE_LINKS more per node.

    In a shard of up to SPARE_LINKS + 1 nodes these are all candidates. Of a larger one the members (node,
    fingerprint) are returned too, with band and value and without b; `last_links` tests what is left there.
    """
    names = ["a", "b", "band", "value", "fingerprint"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (band, value), nodes, numbers in by_shard(batches, ["band", "value"], "node"):
            found = forest(numbers, WIDE_RADIUS, SPARE_LINKS)
            if found:
                a, b = zip(*found, strict=True)
                none = [pa.nulls(len(a), t) for t in (pa.int32(), pa.int64(), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in a]), pa.array([nodes[i] for i in b]), *none], names)
            if found and len(nodes) > SPARE_LINKS + 1:
                n = len(nodes)
                at = [pa.array(np.full(n, band, np.int32)), pa.array(np.full(n, value, np.int64)), pa.array(np.array(numbers, np.uint64).view(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.nulls(n, pa.string()), *at], names)

    in_shards = sharded.select("band", "value", "node", "fingerprint").repartition("band", "value").sortWithinPartitions("band", "value", "fingerprint", "node")
    return in_shards.mapInArrow(search, "a string, b string, band int, value long, fingerprint long")


def _runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, of batches sorted by it."""
    kept, last = [], None
    for batch in batches:
        at = list(zip(*[batch.column(c).to_pylist() for c in key], strict=True))
        start = 0
        for i in range(len(at) + 1):
            if i < len(at) and at[i] == last:
                continue
            if i > start:
                kept.append(batch.slice(start, i - start))
            if i == len(at):
                break
            if kept:
                yield pa.Table.from_batches(kept)
            kept, last, start = [], at[i], i
    if kept:
        yield pa.Table.from_batches(kept)


def _numbered(values: list) -> np.ndarray:
    seen: dict = {}
    return np.array([seen.setdefault(x, len(seen)) for x in values])


def _apart(i: int, numbers: np.ndarray, label: np.ndarray, side: np.ndarray, across: bool) -> np.ndarray:
    """Earlier members within the radius of member i and of another group, the nearest first."""
    d = np.bitwise_count(numbers[:i] ^ numbers[i])
    found = np.flatnonzero((d <= WIDE_RADIUS) & (label[:i] != label[i]) & (~across | (side[:i] != side[i])))
    return found[np.argsort(d[found], kind="stable")]


def tested(numbers: np.ndarray, label: np.ndarray, side: np.ndarray, across: bool, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links of similar members that join different groups, every candidate of another group being tested."""
    label, out = label.copy(), []
    size = np.array([len(x) for x in sets])
    vocabulary, words = np.unique(np.concatenate(sets), return_inverse=True)
    words = np.split(words, np.cumsum(size)[:-1])
    marked = np.zeros(len(vocabulary), bool)
    for i in range(1, len(sets)):
        todo, step = _apart(i, numbers, label, side, across), 8
        marked[words[i]] = True
        while len(todo):
            now, todo = todo[:step], todo[step:]
            ends = np.cumsum(size[now])
            sums = np.concatenate([[0], np.cumsum(marked[np.concatenate([words[j] for j in now])])])
            common = sums[ends] - sums[ends - size[now]]
            for j in now[common >= similarity * (size[now] + size[i] - common)].tolist():
                if label[j] != label[i]:
                    out.append((i, j))
                    label[label == label[j]] = label[i]
            todo, step = todo[label[todo] != label[i]], min(4 * step, 512)
        marked[words[i]] = False
    return out


def last_links(members: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) by which `members` (node, band, value, fingerprint) of different checked groups join.

    A shard of more than PART_NODES members is dealt out by pairs of parts, so that each two members meet in a task.
    The members that have a candidate of another group are found first; the shingle sets go only to these, and once
    to those that are the same in several shards.
    """
    key = ["band", "value"]
    grouped = members.join(roots, "node", "left").select(*key, "node", "fingerprint", F.coalesce("root", "node").alias("root"))
    mixed = grouped.groupBy(*key).agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    parts = F.ceil(F.col("n") / PART_NODES).cast("int")
    dealt = grouped.join(mixed.select(*key, parts.alias("parts")), key).withColumn("side", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(*key, F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "side", "node", "fingerprint", "root")
    task, plain = [*key, "x", "y"], ["side", "node", "fingerprint", "root"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, task):
            side, across = rows["side"].to_numpy(), rows["x"][0].as_py() != rows["y"][0].as_py()
            numbers, label = rows["fingerprint"].to_numpy().view(np.uint64), _numbered(rows["root"].to_pylist())
            open_ = np.zeros(len(side), bool)
            for i in range(1, len(side)):
                found = _apart(i, numbers, label, side, across)
                open_[found] = True
                open_[i] |= len(found) > 0
            if open_.any():
                rows = rows.select(plain).filter(pa.array(open_))
                unit = xxhash.xxh128_hexdigest(repr((across, rows["node"].to_pylist(), rows["side"].to_pylist() if across else 0)).encode())
                for batch in rows.combine_chunks().to_batches():
                    yield pa.RecordBatch.from_arrays([pa.array([unit] * batch.num_rows), pa.array([across] * batch.num_rows), *batch.columns], ["unit", "across", *plain])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["unit"]):
            nodes, each = rows["node"].to_pylist(), rows["shingles"].combine_chunks()
            each = each.combine_chunks() if isinstance(each, pa.ChunkedArray) else each
            cuts = each.offsets.to_numpy()
            sets = np.split(each.values.to_numpy()[cuts[0] : cuts[-1]], cuts[1:-1] - cuts[0])
            found = tested(rows["fingerprint"].to_numpy().view(np.uint64), _numbered(rows["root"].to_pylist()), rows["side"].to_numpy(), rows["across"][0].as_py(), sets, similarity)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in found]), pa.array([nodes[j] for _, j in found])], ["a", "b"])

    seen = dealt.repartition(*task).sortWithinPartitions(*task, "node").mapInArrow(look, "unit string, across boolean, side int, node string, fingerprint long, root string")
    units = checkpoint(seen.dropDuplicates(["unit", "node"]))
    return units.join(sets, "node").repartition("unit").sortWithinPartitions("unit", "node").mapInArrow(test, "a string, b string")


def contracted(edges: DataFrame) -> DataFrame:
    """Links with the same components: each partition links its nodes to the smallest they reach within it."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict = {}

        def top(x):
            while group.setdefault(x, x) != x:
                group[x] = group[group[x]]
                x = group[x]
            return x

        kind = None
        for batch in batches:
            kind = batch.schema.field("a").type
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = top(a), top(b)
                group[max(a, b)] = min(a, b)
        pairs = [(x, top(x)) for x in group]
        for at in range(0, len(pairs), 50_000):
            a, b = zip(*pairs[at : at + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])

    return edges.select("a", "b").mapInArrow(contract, f"a {dict(edges.dtypes)['a']}, b {dict(edges.dtypes)['a']}")


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root) of every node with a link, root being the smallest node reachable: large-star and small-star rounds.

    Partitions are contracted first, which saves rounds. Each round is cut by a checkpoint, so that a lost executor
    costs a round at most.
    """

    def to_smallest(pairs: DataFrame) -> DataFrame:
        """For each node a, its smallest neighbour or itself."""
        return pairs.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))

    tidy = lambda pairs: checkpoint(pairs.where("a <> b").distinct())
    state = lambda pairs: tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = tidy(contracted(edges))
    seen = state(now)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: each larger neighbour of a node is linked to the node's smallest
        large = both.join(to_smallest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        large = checkpoint(large.where("a <> b"))
        # small star: a node and its smaller neighbours are linked to the smallest of them
        low = to_smallest(large)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(low.select("a", F.col("root").alias("b")))
        now = tidy(small)
        if (after := state(now)) == seen:
            break
        seen = after
    else:
        raise RuntimeError(f"components have not settled after {most_rounds} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def groups(docs: DataFrame, shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id, the smallest doc_id reachable over links.

    Defined cases: null and empty texts have fingerprint zero and are linked like any others; rows that repeat a
    doc_id are separate rows; component_id is null where no reachable row has a doc_id.
    """
    prints = checkpoint(fingerprints(docs, shingle))
    distinct = checkpoint(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest")))
    found = components(links(shards(distinct.select("fingerprint", F.col("fingerprint").alias("node")), radius), ["mask", "value"], "node", radius))
    named = distinct.join(found, distinct["fingerprint"] == found["node"], "left").select("fingerprint", "smallest", F.coalesce("root", "fingerprint").alias("root"))
    label = named.groupBy("root").agg(F.min("smallest").alias("component_id"))
    classes = named.join(label, "root").select("fingerprint", "component_id")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return prints.join(classes, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")


#: Of `near_duplicates`: min-hash bands and rows, radius of the tree search, links per node that are checked first,
#: and the members of a shard that one task takes of either part.
BANDS, BAND_ROWS, WIDE_RADIUS, SPARE_LINKS, PART_NODES = 16, 4, 24, 3, 1_024
MAX_BROADCAST_ROWS = 500_000
_rng = np.random.default_rng(11)
_MULTIPLIERS = _rng.integers(1 << 63, size=BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XORS = _rng.integers(1 << 63, size=BANDS * BAND_ROWS, dtype=np.uint64)


def band_keys(hashes: np.ndarray, each: np.ndarray) -> np.ndarray:
    """A row of BANDS keys for each text, each of the smallest hashes under BAND_ROWS orders; zeros without shingles."""
    out = np.zeros((len(each), BANDS), np.uint64)
    rows = np.flatnonzero(each)
    if not len(rows):
        return out
    cuts = np.cumsum(each[rows]) - each[rows]
    for b in range(BANDS):
        key = np.full(len(rows), b, np.uint64)
        for k in range(b * BAND_ROWS, (b + 1) * BAND_ROWS):
            key = W.mix(key ^ np.minimum.reduceat((hashes ^ _XORS[k]) * _MULTIPLIERS[k], cuts))
        out[rows, b] = key
    return out


def distinct_hashes(hashes: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each row, and how many each row has."""
    sets = [np.unique(x) for x in np.split(hashes, np.cumsum(each)[:-1])]
    return np.concatenate([hashes[:0], *sets]), np.array([len(x) for x in sets], np.int64)


def traits(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, row (hash of the text), node (hash of the lower-cased word sequence), fingerprint and band keys.

    The fingerprint is that of the distinct shingles, as the Jaccard similarity is: a line that is repeated in one
    text only moves no bit.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            w = W.texts(batch.column("text")).words(W.NOT_SPACE, lower=True)
            hashes, each = distinct_hashes(*shingle_hashes(w, shingle))
            a, b = (W.span_hash(w.hashes(i), w.rows[:-1], w.rows[1:], i) for i in (0, 1))
            nodes = pa.array([f"{x:016x}{y:016x}" for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.string())
            bands = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(hashes, each).ravel().view(np.int64)), BANDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), nodes, pa.array(majority(hashes, each).view(np.int64)), bands], ["doc_id", "row", "node", "fingerprint", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    return rows.mapInArrow(compute, "doc_id long, row long, node string, fingerprint long, bands array<long>")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """row and the sorted distinct shingles of each text, by the upper 32 bits of their hashes."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            hashes, each = shingle_hashes(W.texts(batch.column("text")).words(W.NOT_SPACE, lower=True), shingle)
            short = (hashes >> np.uint64(32)).astype(np.uint32)
            sets = [np.unique(x).view(np.int32) for x in np.split(short, np.cumsum(each)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sets, pa.list_(pa.int32()))], ["row", "shingles"])

    return docs.mapInArrow(compute, "row long, shingles array<int>")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, row, node and the doc_id and row that stay (keep_doc, keep_row) of every row: the smallest of its group.

    Grouped are texts whose shingle sets have a Jaccard similarity of `similarity` or more, directly or over others.
    """
    every = checkpoint(traits(docs, shingle))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    nodes = checkpoint(every.groupBy("node").agg(F.min(order).alias("first"), F.min("fingerprint").alias("fingerprint"), F.min("bands").alias("bands")))
    sharded = nodes.select("node", "fingerprint", F.posexplode("bands").alias("band", "value"))
    seen = checkpoint(first_links(sharded))
    found = checkpoint(seen.where("b is not null").select("a", "b").distinct())
    members = seen.where("b is null").select(F.col("a").alias("node"), "band", "value", "fingerprint")
    ends = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).unionByName(members.select("node")).distinct()
    sought = checkpoint(nodes.join(ends, "node", "left_semi").select("node", F.col("first.row").alias("row")))
    texts = docs.select(F.xxhash64("text").alias("row"), "text").join(small(sought.select("row").distinct(), sought.count()), "row", "left_semi")
    sets = checkpoint(shingle_sets(texts.dropDuplicates(["row"]), shingle).join(sought, "row").select("node", "shingles"))
    a, b = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    alike = checkpoint(found.join(a, "a").join(b, "b").where(common >= similarity * (F.size("set_a") + F.size("set_b") - common)).select("a", "b"))
    roots = components(alike)
    if not members.isEmpty():
        more = checkpoint(last_links(members, roots, sets, similarity))
        if not more.isEmpty():
            roots = components(more.unionByName(alike))
    named = nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    keep = named.groupBy("root").agg(F.min("first").alias("keep"))
    kept = named.join(keep, "root").select("node", "keep.doc_id", "keep.row").toDF("node", "keep_doc", "keep_row")
    return every.select("doc_id", "row", "node").join(kept, "node")


def small(df: DataFrame, rows: int) -> DataFrame:
    """A side of at most so many counted rows is broadcast, a larger one joined by shuffle."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group, all columns as they are: that of the smallest doc_id.

    Defined cases: null and empty texts are one group; of rows that repeat doc_id and text one stays; a null doc_id
    comes after all others.
    """
    groups = checkpoint(near_duplicates(docs, shingle, similarity))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_doc")) & (F.col("row") == F.col("keep_row"))
    gone = checkpoint(groups.where(~stays).select("doc_id", "row").distinct().toDF("_doc", "_row"))
    same = F.col("_doc").eqNullSafe(docs["doc_id"].cast("long")) & (F.col("_row") == F.xxhash64(docs["text"]))
    out = docs.join(small(gone, gone.count()), same, "left_anti")
    twins = checkpoint(groups.where(stays).groupBy("doc_id", "row").count().where("count > 1").select("doc_id", "row").toDF("_doc", "_row"))
    if n := twins.count():
        once = out.join(small(twins, n), same, "left_semi").dropDuplicates(["doc_id", "text"])
        out = out.join(small(twins, n), same, "left_anti").unionByName(once)
    return out
