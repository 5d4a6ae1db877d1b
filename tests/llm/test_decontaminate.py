import hashlib
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
import pyarrow as pa

from bourselake.llm import decontaminate as D
from bourselake.llm.queries import op10_decontaminate
from tests.llm.plain import DOCS, alnum_words, odd_documents


def plain(docs, items, window=10):
    gram = {}
    for item, text in items:
        w = alnum_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            gram.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = alnum_words(text), set(), set()
        for n in {len(g) for g in gram}:
            for i in range(len(w) - n + 1):
                if own := gram.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    want = plain(docs, items)
    assert any(r[5] for r in want)
    assert rows(op10_decontaminate(spark, small)) == want


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_odd_rows_and_several_blocks(spark, monkeypatch, block):
    passage = "the quick brown fox jumps over the lazy dog while seven more foxes sleep"
    items = [(1, passage), (2, "two Three"), (None, passage.upper()), (3, None), (4, ""), (10, "w1x1 w2x2 w3x3 w4x4 w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11")]
    docs = odd_documents() + [(20, f"a {passage} b {passage}", "en", "a", 1), (21, passage[:30], "en", "a", 1), (22, "zwei two-three", "en", "a", 1)]
    df = spark.createDataFrame(docs, DOCS).withColumnRenamed("lang", "Found").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "blocks", lambda benchmark, most, own=D.blocks: own(benchmark, block))
    monkeypatch.setattr(D, "block_count", lambda benchmark, most, own=D.block_count: own(benchmark, block))
    want = plain([(d[0], d[1]) for d in docs], items)
    assert rows(D.contamination(df, bench)) == want
    longest = {r.doc_id: (r.longest_match, r.longest_start, r.longest_item) for r in D.contamination(df, bench).where("contaminated").collect()}
    assert longest == {3: (2, 1, "2"), 4: (11, 1, "10"), 5: (11, 1, "10"), 20: (14, 1, ""), 22: (2, 1, "2")}
    assert D.clean(df, bench).count() == sum(not r[5] for r in want)
    assert D.clean(df, bench).columns == df.columns


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contamination(docs, bench).collect() == []
    some = spark.createDataFrame(odd_documents(), DOCS)
    assert not any(r.contaminated for r in D.contamination(some, bench.limit(0)).collect())


def longest(doc, item, window):
    """Maximal verbatim matches (start, length, start in the item) of two word lists, by comparing all places."""
    least = min(window, len(item))
    out = set()
    for p in range(len(doc)):
        for o in range(len(item)):
            n = 0
            while p + n < len(doc) and o + n < len(item) and doc[p + n] == item[o + n]:
                n += 1
            if n >= least and (p == 0 or o == 0 or doc[p - 1] != item[o - 1]):
                out.add((p, n, o))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=4), st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=15), min_size=1, max_size=3), st.integers(1, 6))
def test_longest_matches_and_places(docs, items, window):
    sought = D.suffixes([(str(i), " ".join(x)) for i, x in enumerate(items)], window)
    counts, found = D.shard_matches(pa.array([" ".join(d) for d in docs]), sought, window)
    assert counts.tolist() == [len(d) for d in docs]
    for doc, got in zip(docs, found, strict=True):
        assert set(got) == {(p, n, str(i), o) for i, item in enumerate(items) for p, n, o in longest(doc, item, window)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.integers(1, 12))
def test_suffix_array_order(tokens, depth):
    got = D.suffix_array(np.array(tokens), depth)
    assert sorted(got) == list(range(len(tokens)))
    cut = [(tokens + [0] * depth)[i : i + depth] for i in got]
    assert cut == sorted(cut)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=4), st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=15), min_size=1, max_size=4), st.integers(1, 6))
def test_findings_follow_from_all_matches(docs, items, window):
    texts = [" ".join(d) for d in docs]
    got = D.shard_findings(pa.array(texts), D.suffixes([(str(i // 2), " ".join(x)) for i, x in enumerate(items)], window), window)
    for r, doc in enumerate(docs):
        every = {(p, n, str(i // 2)) for i, item in enumerate(items) for p, n, _ in longest(doc, item, window)}
        hit = {p + k for p, n, _ in every for k in range(n)}
        spans = got.spans[got.spans[:, 0] == r]
        assert {p + k for _, p, n in spans.tolist() for k in range(n)} == hit and (r in got.rows) == bool(every)
        if every:
            at = got.rows.tolist().index(r)
            assert got.sets[got.kind[at]] == sorted({i for *_, i in every})
            n, p, i = min((-n, p, i) for p, n, i in every)
            assert got.longest[at].tolist()[:2] == [-n, p] and got.names[got.longest[at][2]] == i
    assert D.shard_findings(pa.array(texts), D.suffixes([(str(i // 2), " ".join(x)) for i, x in enumerate(items)], window), window, detail=False).rows.tolist() == got.rows.tolist()


def test_a_prompt_that_many_texts_and_items_share():
    """10,000 texts and 1,000 items: places and suffixes, not ten million pairs of them."""
    prompt = " ".join(f"w{i}" for i in range(30))
    sought = D.suffixes([(f"{i:04d}", f"{prompt} answer{i} more{i}") for i in range(1_000)], 10)
    tracemalloc.start()
    got = D.shard_findings(pa.array([f"x{i} {prompt} answer{i} y" for i in range(10_000)]), sought, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got.rows) == 10_000 and len(got.sets) <= 1_001 and peak < 400e6
    assert got.longest[7].tolist()[:2] == [31, 1] and got.names[got.longest[7][2]] == "0007"
    assert got.longest[5_000].tolist()[:2] == [30, 1] and got.names[got.longest[5_000][2]] == "0000"
