import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bourselake.llm import spelling as O
from bourselake.llm.queries import op11_spelling
from tests.llm.plain import DOCS, lower, odd_documents


def plain_near(a, b):
    cuts = lambda x: {x[:i] + x[i + 1 :] for i in range(len(x))}
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return b in cuts(a) or a in cuts(b)


def plain_words(docs):
    count = collections.Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def plain(count):
    near = {w: [x for x in count if plain_near(w, x)] for w in count}
    form = {w: min(near[w], key=lambda x: (-count[x], x), default=None) for w in count}
    form = {w: f if f and count[f] >= 5 * count[w] else None for w, f in form.items()}
    out = set()
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None))
    return out


def drawn(seed, n, letters="abc", least=1, most=7):
    draw = random.Random(seed)
    return sorted({"".join(draw.choices(letters, k=draw.randrange(least, most))) for _ in range(n)})


@pytest.mark.parametrize("seed", range(6))
def test_a_trie_against_plain(seed):
    words = drawn(seed, 300, "abcé"[: 2 + seed % 3])
    a, b = O.Trie(words, np.array([0])).pairs()
    got = [frozenset((words[i], words[j])) for i, j in zip(a, b, strict=True)]
    assert len(got) == len(set(got))
    assert set(got) == {frozenset(p) for p in itertools.combinations(words, 2) if plain_near(*p)}


def test_tries_do_not_mix():
    words = ["abcx", "abcy", "abdx", "abdy"]  # tries of abc and abd: what parts at ab is another's work
    a, b = O.Trie(words, np.array([0, 2])).pairs()
    assert {(words[min(i, j)], words[max(i, j)]) for i, j in zip(a, b, strict=True)} == {("abcx", "abcy"), ("abdx", "abdy")}


@pytest.mark.parametrize("most", [1, 40, 10_000])
def test_pairs_wherever_the_trie_is_cut(spark, most):
    words = drawn(9, 260, "abé", 1, 8) + ["a" * 60, "a" * 61, "a" * 30 + "b" + "a" * 29]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long").repartition(3)
    got = [tuple(r) for r in O.one_edit_pairs(df, most).collect()]
    assert sorted(got) == sorted((a, b, words.index(b)) for a, b in itertools.permutations(words, 2) if plain_near(a, b))


def test_forms_and_roots(spark):
    count = {"letter": 5_000, "lettr": 900, "lettrx": 100, "lxttrx": 11, "lxttry": 2, "leter": 1_001, "better": 5_000, "bettor": 1_000, "alone": 7, "fetter": 5_000}
    df = spark.createDataFrame([*count.items()], "word string, n long")
    for most in (None, 2):
        assert {tuple(r) for r in O.variants(df, most).collect()} == plain(count)
    roots = {r.word: r.root for r in O.variants(df).collect()}
    assert roots["lxttry"] == "letter" and roots["bettor"] == "better" and roots["leter"] == "leter"


def test_odd_documents_and_empty_tables(spark):
    long = "ab" * 1_000
    rows = odd_documents() + [(None, "Wörter wörter WöRTER WÖRTER wörter wörterx x" * 3, "de", "a", 1)] * 3 + [(i, f"{long} {long}c straßen×÷ {long}", "x", "y", 1) for i in range(4)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"word": F.lit("w"), "n": F.lit(0), "run": F.lit(0)})
    got = {tuple(r) for r in O.variants(O.vocabulary(O.damaged(docs))).collect()}
    assert got == plain(plain_words([(r[0], r[1]) for r in rows]))
    assert any(w[0].startswith("abab") for w in got)
    assert O.variants(O.vocabulary(O.damaged(docs.limit(0)))).collect() == []


def test_whole_table(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    out = op11_spelling(spark, small)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in out.collect()} == plain(plain_words(docs))
