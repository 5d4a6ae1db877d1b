import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bourselake.llm import lines as O
from bourselake.llm import words as W
from bourselake.llm.queries import op13_lines
from bourselake.llm.shared import scratch
from tests.llm.plain import DOCS, lower, odd_documents

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return lower(line).strip(SPACE)


def plain(docs, held):
    """doc_id, n_lines, n_dropped and text of docs (doc_id, text), against the documents that are held."""
    holders = {}
    for doc, text in held:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    gone = {k: max((x for x in v if x is not None), default=None) for k, v in holders.items() if len(v) >= 3}
    out = []
    for doc, text in docs:
        every = (text or "").split("\n")
        kept = [x for x in every if key(x) not in gone or doc == gone[key(x)]]
        out.append((doc, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def drawn(seed, n, first=0):
    draw = random.Random(seed)
    pool = [f"  A Line of words, number {i}, quite long" + " \t" * (i % 2) for i in range(12)] + ["short", "", "   ", "é" * 19, "É" * 20, "x" * 20, "\r"]
    return [(first + i, "\n".join(draw.choices(pool, k=draw.randrange(9))) if i % 11 else None) for i in range(n)]


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_insertions_and_deletions(spark):
    a, b = drawn(1, 40), drawn(2, 25, 30)  # ten doc_ids are in both, with other texts
    index = O.LineIndex(spark, scratch(spark, "index"), shard_keys=5)
    index.insert(frame(spark, a))
    assert got(index.dedup(frame(spark, a + b))) == plain(a + b, a)
    index.insert(frame(spark, b + a[:7]))
    assert got(index.dedup(frame(spark, a))) == plain(a, a + b)
    again = O.LineIndex(spark, index.path, shard_keys=5)  # another session's
    again.remove(frame(spark, b).select("doc_id"))
    left = [x for x in a if x[0] < 30]
    assert got(again.dedup(frame(spark, a + b))) == plain(a + b, left)
    once = O.LineIndex(spark, scratch(spark, "index"))
    once.insert(frame(spark, left))
    exact = lambda i: sorted(tuple(r) for r in i.refs().where("refs > 0").select("high", "low", "refs", "keeper").collect())
    assert exact(again) == exact(once)
    for kind, least in (("held", 1), ("repeated", 3)):  # no key is missing from the filters
        keys = again.refs().where(f"refs >= {least}").toPandas()
        tables = [(r.made_in, r.shards, r.shard, O.Cuckoo(np.frombuffer(bytes(r.table), np.uint16).reshape(-1, 4))) for r in again.filters(kind).collect()]
        assert all(any(t.holds(np.array([h]), np.array([low]))[0] for made, n, s, t in tables if made == at and h % n == s) for h, low, at in zip(keys.high, keys.low, keys[f"{kind}_in"]))
        assert sum(np.count_nonzero(t.table) for *_, t in tables) == len(keys)


def test_a_batch_counts_once_it_is_committed(spark, monkeypatch):
    a, b = drawn(3, 12), drawn(4, 12, 50)
    index = O.LineIndex(spark, scratch(spark, "index"))
    index.insert(frame(spark, a))
    with monkeypatch.context() as m:
        m.setattr(O.LineIndex, "_commit", lambda *x: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            index.insert(frame(spark, b))
    index = O.LineIndex(spark, index.path)
    assert got(index.dedup(frame(spark, a))) == plain(a, a)
    index.insert(frame(spark, b))
    assert got(index.dedup(frame(spark, a + b))) == plain(a + b, a + b)


def test_filters_too_large_to_send(spark, monkeypatch):
    a = drawn(5, 30)
    index = O.LineIndex(spark, scratch(spark, "index"))
    index.insert(frame(spark, a))
    monkeypatch.setattr(O, "MAX_FILTER_BYTES", 0)
    monkeypatch.setattr(O, "MAX_BROADCAST_KEYS", 0)
    assert got(index.dedup(frame(spark, a))) == plain(a, a)


def test_odd_documents_and_clashing_columns(spark):
    rows = odd_documents()
    long = "a line that is in many of the documents"
    more = [(i, f"{long}\n{i}", "en", "a", 1) for i in (20, 21, None, None)]
    docs = spark.createDataFrame(rows + more, DOCS).withColumns({c: F.lit(1) for c in ("n_lines", "drop", "of", "row", "rest", "high", "keeper")})
    index = O.LineIndex(spark, scratch(spark, "index"))
    index.insert(docs)
    out = index.dedup(docs)
    assert out.columns == [c for c in docs.columns if c not in ("text", "n_lines")] + ["text", "n_lines", "n_dropped"]
    both = [(r[0], r[1]) for r in rows + more]
    assert got(out) == plain(both, both)
    empty = O.LineIndex(spark, scratch(spark, "index"))
    empty.insert(docs.limit(0))
    assert empty.dedup(docs.limit(0)).collect() == [] and got(empty.dedup(docs)) == plain(both, [])


@pytest.mark.parametrize("n", [0, 1, 7, 3_000, 40_000])
def test_cuckoo_filter(n):
    draw = np.random.default_rng(n)
    high, low = (draw.integers(-(2**63), 2**63 - 1, n) for _ in range(2))
    table = O.Cuckoo.of(high, low)
    assert table.holds(high, low).all() and np.count_nonzero(table.table) == n
    other = table.holds(*(draw.integers(-(2**63), 2**63 - 1, 20_000) for _ in range(2)))
    assert other.mean() < 0.001
    some = slice(0, min(n // 2, 2_000))
    table.delete(high[some], low[some])
    assert table.holds(high[some.stop :], low[some.stop :]).all() and np.count_nonzero(table.table) == n - some.stop


def test_lines_against_plain():
    texts = [t for _, t in drawn(7, 50)] + ["", None, "\n", "\n\n  x  \n", "É" * 25 + "\r\n" + "b" * 30]
    found = O.lines(W.texts(pa.array(texts)))
    long, keys = found.keys()
    want = [(r, i, x) for r, t in enumerate(texts) for i, x in enumerate((t or "").split("\n"))]
    assert found.row.tolist() == [r for r, _, _ in want]
    assert [hashlib.blake2b(key(x).encode(), digest_size=16).digest() for _, _, x in want if len(key(x)) >= 20] == keys


def test_whole_table(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    want = {(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain(docs, docs)}
    assert {tuple(r) for r in op13_lines(spark, small).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()} == want
