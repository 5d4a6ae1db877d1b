"""Spelling variants: words of a corpus that are one edit apart, found by merging the subtrees of an errata trie.

Two words one edit apart part at one node of the trie of all words: below it, one of them has a letter replaced or left
out, and then both go on alike. At every node the child with most words is heavy. The words of the other, light children
(each word is in few: a light subtree has at most half of the words) are merged into the heavy one, small into large,
with the letter at the node replaced by the heavy child's, left out, or put before it; light subtrees are merged with
each other with the letter left out. Words that coincide are one edit apart, and each pair is found at one node.

Subtrees of up to `most` words are tries of their own: a sorted run of words, whose nodes are the common prefixes of
neighbours and whose merged words are looked up by a rolling hash (and compared letter by letter). Nodes over more words
are merged by a shuffle: every word below goes out whole and without its letter at the node, and equal ones meet; in
such a group there is one word per letter, so it is small however many words share a prefix. Only counts of prefixes
decide where a trie is cut.

Defined cases: a null text has no words, a null doc_id is written as nothing before the colon; repeated rows count as
rows; very long runs are read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpoint

LEAST_POINTS, LEAST_TIMES, TYPO_EVERY, MORE_OFTEN = 6, 5, 199, 5
LETTERS = "A-Za-zÀ-ÿ"
#: Words of a trie at most; it is smaller where the words are few, so that there are about PARTS of them.
TRIE_WORDS, LEAST_TRIE_WORDS, PARTS = 1 << 16, 128, 100
#: Words that a task merges at a time, of many small tries; prefixes that are broadcast at most.
STEP_WORDS, MAX_BROADCAST_PREFIXES = 1 << 16, 100_000
PAIR = "word string, near string, near_n long"


def damaged(docs: DataFrame) -> DataFrame:
    """`word` of every run of letters, in lower case (A-Z alone), some with a letter left out by the hash of doc_id and run."""
    at_least = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{LEAST_POINTS},}}"), F.lit(0))  # shorter ones stay too short
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(at_least).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("run"))
    runs = runs.select("doc_id", low.alias("run")).withColumn("h", F.crc32(F.concat_ws(":", "doc_id", "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % TYPO_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, points: int = LEAST_POINTS, times: int = LEAST_TIMES) -> DataFrame:
    """word and n of the words (column word) that are long and frequent enough."""
    return words.where(F.length("word") >= points).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


# --- nodes over many words ---


def large_prefixes(vocabulary: DataFrame, most: int) -> list[DataFrame]:
    """Tables of `prefix` and `length` of the nodes over more than `most` words, from the root down.

    Each round looks twice as many letters further below the last large nodes, so rounds follow the logarithm of depth.
    """
    if vocabulary.count() <= most:
        return []
    found = [vocabulary.sparkSession.createDataFrame([("", 0)], "prefix string, length int")]
    last, step = found[0], 2
    depth = 0
    while True:
        below = vocabulary if not depth else vocabulary.join(few(last), F.substring("word", 1, depth) == F.col("prefix"), "left_semi")
        lengths = F.sequence(F.lit(depth + 1), F.least(F.lit(depth + step), F.length("word")))
        each = below.where(F.length("word") > depth).select(F.explode(lengths).alias("length"), "word").select(F.substring("word", F.lit(1), F.col("length")).alias("prefix"), "length")
        large = checkpoint(each.groupBy("prefix", "length").agg(F.count("*").alias("n")).where(F.col("n") > most).select("prefix", "length"))
        found.append(large)
        depth, step = depth + step, 2 * step
        last = large.where(F.col("length") == depth)
        if last.isEmpty():
            return found


def few(prefixes: DataFrame) -> DataFrame:
    """Large prefixes are few (words divided by `most`, and by depth): broadcast up to a bound, counted first."""
    return F.broadcast(prefixes) if prefixes.count() <= MAX_BROADCAST_PREFIXES else prefixes


def met_in_shuffle(placed: DataFrame) -> DataFrame:
    """PAIR of words that part at a large node. placed: word, n and `length` of a large prefix of it, for each of them."""
    letter = F.when(F.length("word") > F.col("length"), F.substring("word", F.col("length") + 1, F.lit(1)))
    without = F.concat(F.substring("word", F.lit(1), F.col("length")), F.substring("word", F.col("length") + 2, F.length("word")))
    member = F.struct("letter", "word", "n")
    sides = F.array(F.struct(F.col("word").alias("key"), F.lit(True).alias("whole")), F.struct(without.alias("key"), F.lit(False).alias("whole")))
    both = placed.withColumn("letter", letter).withColumn("x", F.explode(F.when(F.col("letter").isNull(), F.slice(sides, 1, 1)).otherwise(sides)))
    met = both.groupBy("length", "x.key").agg(F.collect_list(F.when(~F.col("x.whole"), member)).alias("cut"), F.max(F.when(F.col("x.whole"), member)).alias("whole"))
    met = met.where((F.size("cut") > 1) | (F.size("cut") == 1) & F.col("whole").isNotNull())
    pair = lambda a, b: F.struct(a["word"].alias("word"), b["word"].alias("near"), b["n"].alias("near_n"))
    replaced = F.flatten(F.transform("cut", lambda a: F.transform(F.filter("cut", lambda b: b["letter"] != a["letter"]), lambda b: pair(a, b))))
    # a word that goes on with the letter which is left out parts further down
    left_out = F.filter("cut", lambda a: F.col("whole").isNotNull() & ~a["letter"].eqNullSafe(F.col("whole")["letter"]))
    both_ways = F.flatten(F.transform(left_out, lambda a: F.array(pair(a, F.col("whole")), pair(F.col("whole"), a))))
    return met.select(F.explode(F.concat(replaced, both_ways)).alias("p")).select("p.*")


# --- tries of bounded size ---


class Trie:
    """Words in order; `lcp` letters are common to a word and the one before it, -1 where another trie begins."""

    def __init__(self, words: list[str], begins: np.ndarray):
        self.words, n = words, len(words)
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.lengths = np.fromiter(map(len, words), np.int64, n)
        self.offsets = np.append(0, np.cumsum(self.lengths))
        base = 0x9E3779B97F4A7C15
        while True:
            self.up = np.multiply.accumulate(np.append(np.uint64(1), np.full(int(self.lengths.max(initial=0)) + 1, base, np.uint64)))
            self.base, self.down = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
            within = np.arange(len(self.codes)) - np.repeat(self.offsets[:-1], self.lengths)
            self.total = np.append(np.uint64(0), np.cumsum((self.codes + np.uint64(1)) * self.up[within]))
            self.hash = self.prefix(np.arange(n), self.lengths)
            self.order = np.argsort(self.hash)
            self.sorted = self.hash[self.order]
            if (self.sorted[1:] != self.sorted[:-1]).all():
                break
            base += 2  # words with equal hashes: take another
        self.lcp = np.full(n, -1)
        low, high = np.zeros(max(n - 1, 0), np.int64), np.minimum(self.lengths[1:], self.lengths[:-1])
        rest = np.arange(1, n)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.prefix(rest, middle) == self.prefix(rest - 1, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        self.lcp[1:] = low
        self.lcp[begins] = -1

    def prefix(self, word: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hashes of the first letters of words."""
        return self.total[self.offsets[word] + length] - self.total[self.offsets[word]]

    def letter(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The letters there, 0 behind the end."""
        inside = at < self.lengths[word]
        return np.where(inside, self.codes[np.where(inside, self.offsets[word] + at, 0)], 0)

    def light(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every node at which words part: the words that don't go on to its heavy child, its depth, the heavy letter."""
        words, depths, heavy = [], [], []
        for d in np.unique(self.lcp[self.lcp >= 0]):
            child = np.flatnonzero(self.lcp <= d)  # where a child of a node of this depth begins
            node = np.cumsum(self.lcp[child] < d) - 1
            size = np.diff(np.append(child, len(self.words)))
            ends_here = self.lengths[child] == d  # a word that ends at the node is no child
            rank = np.lexsort((-np.where(ends_here, 0, size), node))
            first = rank[np.append(True, node[rank][1:] != node[rank][:-1])]  # the heavy child of each node
            parted = (np.bincount(node) > 1)[node]
            is_light = parted.copy()
            is_light[first] = False
            at = np.flatnonzero(is_light)
            each = np.repeat(child[at] - np.append(0, np.cumsum(size[at])[:-1]), size[at]) + np.arange(size[at].sum())
            words.append(each)
            depths.append(np.full(len(each), d))
            heavy.append(np.repeat(self.letter(child[first[node[at]]], np.full(len(at), d)), size[at]))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        return join(words, np.int64), join(depths, np.int64), join(heavy, np.uint64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The word of each hash, or -1."""
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Each pair of words that part at a node here and are one edit apart, once."""
        word, depth, heavy = self.light()
        if not len(word):
            return word, word
        own, one = self.letter(word, depth), np.uint64(1)
        before, goes_on = self.prefix(word, depth), depth < self.lengths[word]
        whole = self.hash[word]
        behind = whole - self.prefix(word, np.minimum(depth + 1, self.lengths[word]))
        replaced = np.where(goes_on, self.find(before + (heavy + one) * self.up[depth] + behind), -1)
        skipped = before + behind * self.down
        left_out = np.where(goes_on & (self.letter(word, depth + 1) != own), self.find(skipped), -1)
        put_in = self.find(before + (heavy + one) * self.up[depth] + (whole - before) * self.base)
        found = [(word[x >= 0], x[x >= 0]) for x in (replaced, left_out, put_in)]
        at = np.flatnonzero(goes_on)
        at = at[np.lexsort((word[at], skipped[at], depth[at]))]  # light subtrees with each other
        for step in range(1, len(at)):
            a, b = at[:-step], at[step:]
            same = (skipped[a] == skipped[b]) & (depth[a] == depth[b])
            if not same.any():
                break
            found.append((word[a[same]], word[b[same]]))
        a, b = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
        true = np.fromiter((near(self.words[i], self.words[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)), bool, len(a))
        return a[true], b[true]


def near(a: str, b: str) -> bool:
    """Whether words differ by exactly one inserted, deleted or replaced letter."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    start = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[start + (len(a) >= len(b)) :] == b[start + (len(b) >= len(a)) :]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """PAIR, both ways, of tries (word, n, trie, in order), many small ones at a time."""

    def emit(rows: pa.Table) -> pa.RecordBatch:
        name = rows.column("trie").combine_chunks()
        begins = np.append(True, np.asarray(pa.compute.not_equal(name.slice(1), name.slice(0, len(name) - 1))))
        words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        a, b = Trie(words, begins).pairs()
        a, b = np.append(a, b), np.append(b, a)
        text = rows.column("word").combine_chunks()
        return pa.RecordBatch.from_arrays([text.take(pa.array(a)), text.take(pa.array(b)), pa.array(n[b])], ["word", "near", "near_n"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < STEP_WORDS:
            continue
        rows = pa.Table.from_batches(held)
        name = rows.column("trie").combine_chunks()
        last = np.flatnonzero(np.asarray(pa.compute.not_equal(name.slice(1), name.slice(0, len(name) - 1))))
        if len(last):
            yield emit(rows.slice(0, last[-1] + 1))
            held = rows.slice(last[-1] + 1).to_batches()
            size = sum(x.num_rows for x in held)
    if size:
        yield emit(pa.Table.from_batches(held))


def one_edit_pairs(vocabulary: DataFrame, most: int | None = None) -> DataFrame:
    """PAIR (both ways) of the words of a vocabulary (word, n) that are one edit apart."""
    most = most or min(TRIE_WORDS, max(LEAST_TRIE_WORDS, vocabulary.count() // PARTS))
    large = large_prefixes(vocabulary, most)
    if not large:
        return vocabulary.withColumn("trie", F.lit("")).repartition("trie").sortWithinPartitions("trie", "word").mapInArrow(_merged, PAIR)
    prefixes = large[0]
    for x in large[1:]:
        prefixes = prefixes.unionByName(x)
    prefixes = checkpoint(prefixes)
    deepest = prefixes.agg(F.max("length")).first()[0]
    each = vocabulary.select("word", "n", F.explode(F.sequence(F.lit(0), F.least(F.lit(deepest), F.length("word")))).alias("at")).withColumn("_prefix", F.substring("word", F.lit(1), F.col("at")))
    placed = checkpoint(each.join(few(prefixes), F.col("_prefix") == F.col("prefix")).select("word", "n", "length"))
    depth = placed.groupBy("word", "n").agg((F.max("length") + 1).alias("depth"))
    tries = depth.where(F.length("word") >= F.col("depth")).select("word", "n", F.substring("word", F.lit(1), F.col("depth")).alias("trie"))
    small = tries.repartition("trie").sortWithinPartitions("trie", "word").mapInArrow(_merged, PAIR)
    return met_in_shuffle(placed).unionByName(small)


# --- forms ---


def variants(vocabulary: DataFrame, most: int | None = None, more_often: int = MORE_OFTEN) -> DataFrame:
    """Per word of a vocabulary (word, n): word, form, root, n, n_near, form_n.

    form: its most frequent near word (ties: the first in order), if that is `more_often` times as frequent; root: where
    forms of forms end.
    """
    # a word's own row and its pairs meet in one grouping
    rows = one_edit_pairs(vocabulary, most).withColumn("n", F.lit(None).cast("long")).unionByName(vocabulary.select("word", "n"), allowMissingColumns=True)
    nearest = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near")))
    joined = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), nearest.alias("best"))
    has = -F.col("best.less") >= more_often * F.col("n")
    named = checkpoint(joined.select("word", "n", "n_near", F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")))
    links = named.where("form is not null").select("word", F.col("form").alias("root"))
    least, most_often = named.agg(F.min("n"), F.max("n")).first()
    hops = max(1, math.ceil(math.log((most_often or 1) / (least or 1), more_often)))  # each is that many times as frequent
    for _ in range(math.ceil(math.log2(hops))):
        links = checkpoint(links)
        further = links.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        links = links.join(further, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"))
    out = named.join(links, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
