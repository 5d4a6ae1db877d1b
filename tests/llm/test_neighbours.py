import math

import numpy as np
import pytest

from bourselake.llm import neighbours as O
from bourselake.llm.queries import op9_neighbours

SCHEMA = "vec_id long, embedding array<double>, label long"


def plain(rows, queries, k=5):
    ok = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ids, x = np.array([i for i, _ in ok]), np.stack([v / np.linalg.norm(v) for _, v in ok])
    out = []
    for i, q in zip(ids, x, strict=True):
        if queries(i):
            s = x @ q
            top = [j for j in np.lexsort((ids, -s.round(12))) if ids[j] != i][:k]
            out += [(i, r + 1, ids[j], s[j]) for r, j in enumerate(top)]
    return out


def recall(got, want):
    got = {(r[0], r[2]) for r in got}
    return sum((q, v) in got for q, _, v, _ in want) / len(want)


@pytest.mark.parametrize("sf", ["small", "large"])
def test_recall_on_tables(spark, small, sf):
    path = small if sf == "small" else small.replace("sf0.001", "sf0.1")
    rows = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    got, want = op9_neighbours(spark, path).collect(), plain(rows, lambda i: i % 50 == 0)
    assert len(got) == len(want) and recall(got, want) >= 0.93
    exact = {(q, v): s for q, _, v, s in plain(rows, lambda i: i % 50 == 0, len(rows))}
    assert all(abs(r.score - exact[r.query_id, r.vec_id]) < 1e-12 for r in got)
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert all(x == sorted(x) for x in by.values())


def test_odd_rows_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (50, [0.0, 1.0]), (3, [1e300, 1e300]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [None, 1.0])]
    rows += [(i, [3.0, 0.0]) for i in range(101, 110)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).withColumnRenamed("label", "List").repartition(3)
    got = [tuple(r) for r in O.search(df, O.F.col("vec_id") % 50 == 0, part_rows=4).collect()]
    zero = sorted(r for r in got if r[0] == 0)
    assert [r[2] for r in zero] == [50, 101, 102, 103, 104] and [r[1] for r in zero] == [1, 2, 3, 4, 5]
    assert all(r[2] != 50 for r in got if r[0] == 50)
    assert not {4, 5, 6, 7, 8, 9, None} & {r[2] for r in got}


def test_empty_and_few(spark):
    assert O.search(spark.createDataFrame([], SCHEMA), O.F.col("vec_id") % 50 == 0).collect() == []
    two = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [2.0, 1.0], 1)], SCHEMA)
    assert [tuple(r)[:3] for r in O.search(two, O.F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1)]


def test_a_list_with_a_third_of_all_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, ([1.0] * 8 if i % 3 == 0 else rng.normal(size=8).tolist()), 0) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = O.search(df, O.F.col("vec_id") % 100 == 0, part_rows=100).collect()
    assert recall(got, plain(rows, lambda i: i % 100 == 0)) >= 0.95


def test_rows_that_the_sample_says_little_of(spark):
    """Tight groups, whose members share a code, and queries unlike all others."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 16))
    rows = [(i, ((centres[i % 8] + 1e-3 * rng.normal(size=16)) if i % 50 else rng.normal(size=16)).tolist(), 0) for i in range(1, 4001)]
    rows += [(10_000 + 50 * i, (centres[i] + 1e-3 * rng.normal(size=16)).tolist(), 0) for i in range(8)]
    got = O.search(spark.createDataFrame(rows, SCHEMA), O.F.col("vec_id") % 50 == 0, lists=4).collect()
    assert recall(got, plain(rows, lambda i: i % 50 == 0)) == 1
