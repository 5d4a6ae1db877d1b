import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from bourselake.llm import words as W
from tests.llm.plain import ALNUM_WORD, SPACE_WORD, lower


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBz9 \t\n-!é東😀\u0085", max_size=20)), max_size=6), st.integers(0, 2))
def test_words_of_rows(rows, skip):
    texts = W.texts(pa.array(rows, pa.string()).slice(min(skip, len(rows))))
    rows = rows[skip:]
    for allowed, fold, pattern in ((W.NOT_SPACE, False, SPACE_WORD), (W.ALNUM, True, ALNUM_WORD)):
        w = texts.words(allowed, fold)
        got = [[bytes(w.data[a:b]).decode() for a, b in zip(w.starts[i:j], w.ends[i:j])] for i, j in zip(w.rows, w.rows[1:])]
        want = [pattern.findall(lower(t) if fold else t or "") for t in rows]
        assert got == want
        assert w.joined()[0].decode() == "".join(x + " " for r in want for x in r)
        hashes = dict(zip((x for r in want for x in r), w.hashes().tolist()))
        assert len(set(hashes.values())) == len(hashes)


def test_long_text_hashes_as_short_ones():
    text = " ".join(f"w{i % 5003}" for i in range(600_000))
    assert len(text) > 3 * W.SLICE_BYTES
    w = W.texts(pa.array([text])).words(W.NOT_SPACE)
    few = W.texts(pa.array([" ".join(f"w{i}" for i in range(5003))])).words(W.NOT_SPACE)
    assert (w.hashes() == few.hashes()[np.arange(600_000) % 5003]).all()


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (10, 3000, 0, 50)] + [None], "i": range(5)})
    parts = list(W.slices(iter([batch, batch.slice(0, 0)]), "text", 100))
    assert [r for p in parts for r in p["i"].to_pylist()] == [0, 1, 2, 3, 4] and len(parts) > 1
    assert re.fullmatch("x+", parts[0]["text"][0].as_py())
