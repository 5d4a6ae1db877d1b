import base64
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bourselake.llm import tokencount as O
from bourselake.llm.queries import VOCABULARY, op8_token_counts
from tests.llm.plain import DOCS, odd_documents

RUN = re.compile(rb"[\x09-\x0D\x20]+|[0-9]+|[A-Za-z\x80-\xff]+|[^\x09-\x0D\x20-\x20 0-9A-Za-z\x80-\xff]+")


@pytest.fixture(scope="module")
def vocabulary():
    return O.read_vocabulary(VOCABULARY)


def plain_pre_tokens(text):
    runs = [m[0] for m in RUN.finditer((text or "").encode())]
    for i in range(1, len(runs)):
        if runs[i - 1][-1:] == b" " and runs[i][:1].strip(b" \t\n\x0b\x0c\r"):
            runs[i - 1], runs[i] = runs[i - 1][:-1], b" " + runs[i]
    return [r for r in runs if r]


LONGEST = max(map(len, O.read_vocabulary(VOCABULARY)))


def plain_best(token, vocabulary):
    best = [(0.0, 0)]
    for d in range(1, len(token) + 1):
        ways = [(best[d - k][0] + vocabulary[token[d - k : d]], -best[d - k][1] - 1) for k in range(1, min(d, LONGEST) + 1) if token[d - k : d] in vocabulary]
        s, n = max(ways)
        best.append((s, -n))
    return best[-1]


def plain(docs, vocabulary):
    out = []
    for doc_id, text in docs:
        tokens = plain_pre_tokens(text)
        assert b"".join(tokens) == (text or "").encode()
        best = [plain_best(t, vocabulary) for t in tokens]
        out.append((doc_id, len(tokens), sum(n for _, n in best), pytest.approx(sum(s for s, _ in best), abs=1e-5)))
    return sorted(out, key=lambda r: str(r[:3]))


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: str(r[:3]))


def test_whole_table(spark, small, vocabulary):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(op8_token_counts(spark, small)) == plain(docs, vocabulary)


def test_odd_rows(spark, vocabulary):
    docs = odd_documents() + [(40, "a" * 500 + " b  c\n\n d--e", "en", "a", 1), (41, "\x00\x01  x", "en", "a", 1)]
    df = spark.createDataFrame(docs, DOCS).withColumnRenamed("lang", "N_Tokens")
    assert rows(O.token_counts(df, VOCABULARY)) == plain([d[:2] for d in docs], vocabulary)
    assert O.token_counts(df.limit(0), VOCABULARY).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=96), min_size=1, max_size=20))
def test_trie_gives_each_token_its_best_segmentation(tokens):
    vocabulary = test_trie_gives_each_token_its_best_segmentation.__dict__.setdefault("v", O.read_vocabulary(VOCABULARY))
    tokens = [*tokens, *(t[: len(t) // 2] for t in tokens if len(t) > 1 and t[: len(t) // 2] not in tokens)]
    tokens = list(dict.fromkeys(tokens))
    pieces, score = O.trie_scores(tokens, O.compile_model(vocabulary))
    for t, n, s in zip(tokens, pieces, score, strict=True):
        want = plain_best(t, vocabulary)
        assert (n, s) == (want[1], pytest.approx(want[0]))


def test_long_runs_are_segmented_whole(spark, vocabulary, monkeypatch):
    rng = random.Random(2)
    runs = ["東京都は日本の首都" * 700, "a" * 5000, "".join(rng.choice("abcdetion") for _ in range(10_000)), "=" * 300 + "x"]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(runs)], DOCS)
    assert rows(O.token_counts(df, VOCABULARY)) == plain(list(enumerate(runs)), vocabulary)
    monkeypatch.setattr(O, "STRETCH", 37)
    model = O.compile_model(vocabulary)
    for t in (x.encode() for x in runs):
        n, s = O.run_score(t[:2000], model)
        assert plain_best(t[:2000], vocabulary) == (pytest.approx(s), n)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("abcdehilnorstu京都=é", min_size=1, max_size=400) | st.binary(min_size=1, max_size=200), min_size=1, max_size=6), st.integers(1, 64))
def test_runs_are_cut_only_where_no_piece_reaches_across(runs, cut_bytes):
    vocabulary = test_trie_gives_each_token_its_best_segmentation.__dict__.setdefault("v", O.read_vocabulary(VOCABULARY))
    model = test_trie_gives_each_token_its_best_segmentation.__dict__.setdefault("m", O.compile_model(vocabulary))
    runs = [r.encode() if isinstance(r, str) else r for r in runs]
    before, O.CUT_BYTES = O.CUT_BYTES, cut_bytes
    try:
        pieces, score = O.cut_scores(runs, model)
        free = O.breaks(np.frombuffer(runs[0], np.uint8), model)
    finally:
        O.CUT_BYTES = before
    for r, n, s in zip(runs, pieces, score, strict=True):
        want = plain_best(r, vocabulary)
        assert (n, s) == (want[1], pytest.approx(want[0]))
    for i in np.flatnonzero(free).tolist():
        assert not any(runs[0][a:b] in vocabulary for a in range(max(0, i - LONGEST), i + 1) for b in range(i + 2, min(len(runs[0]), a + LONGEST) + 1))


def test_a_text_without_spaces_is_cut_into_short_parts(vocabulary):
    model, rng = O.compile_model(vocabulary), random.Random(5)
    run = base64.b64encode(rng.randbytes(30_000))
    free = O.breaks(np.frombuffer(run, np.uint8), model)
    assert np.diff(np.flatnonzero(free)).max() <= O.LONG_BYTES
    pieces, score = O.cut_scores([run, b"a" * 700], model)
    assert (int(pieces[0]), score[0]) == (O.run_score(run, model)[0], pytest.approx(O.run_score(run, model)[1]))
    assert (int(pieces[1]), score[1]) == O.run_score(b"a" * 700, model)
