import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bourselake.llm import windows as O
from bourselake.llm.queries import op2_substring_dedup
from tests.llm.plain import DOCS, odd_documents, space_words


def plain(docs, window=13):
    first = {}
    key = lambda d: O.NO_ID if d is None else d
    for doc_id, text in docs:
        w = space_words(text)
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            first[g] = min(first.get(g, key(doc_id)), key(doc_id))
    out = []
    for doc_id, text in docs:
        w, gone = space_words(text), set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < key(doc_id):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = plain(docs)
    assert any(r[2] for r in want)
    assert rows(op2_substring_dedup(spark, small)) == want


def test_odd_rows_in_one_and_many_chunks(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = odd_documents() + [(30 + i, f"{'x ' * (i % 5)}{passage}  {i}\n{passage[: 20 * i]}", "en", "a", 1) for i in range(12)]
    df = spark.createDataFrame(docs, DOCS).withColumnRenamed("lang", "Chunk").repartition(3)
    want = plain([(d[0], d[1]) for d in docs])
    for chunks in (1, 7):
        assert rows(O.dedup(df, chunks=chunks)) == want
    assert rows(O.dedup(df, window=3, text=False)) == plain([(d[0], d[1]) for d in docs], 3)
    for r in O.dedup(df).collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


def test_narrow_sketch_loses_nothing(spark, small, monkeypatch):
    monkeypatch.setattr(O, "CHUNK_WINDOWS", 4)  # nearly every cell is hit by several windows
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").limit(60)
    some = docs.collect()
    df = spark.createDataFrame(some, "doc_id long, text string")
    assert rows(O.dedup(df, chunks=3)) == plain(some)


def test_empty(spark):
    assert O.dedup(spark.createDataFrame([], DOCS)).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 2**40), min_size=1, max_size=200))
def test_packed_cells_come_back(cells):
    own = np.array(sorted(cells), np.uint64)
    assert (O.unpack(len(own), O.pack(own)) == own).all()
