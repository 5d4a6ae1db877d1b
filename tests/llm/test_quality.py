import zlib

import numpy as np
import pytest

from bourselake.llm import quality as O
from bourselake.llm.queries import op7_quality
from tests.llm.plain import DOCS, odd_documents


def auc(score, label):
    order = np.argsort(np.argsort(score)) + 1.0
    good = label == 1
    return (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_accuracy(spark, small):
    path = small.replace("sf0.001", "sf0.1")
    rows = {r.doc_id: r for r in op7_quality(spark, path).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    held = [i for i in labels if rows[i].held_out]
    y, s = np.array([labels[i] for i in held]), np.array([rows[i].score for i in held])
    assert len(held) > 500 and auc(s, y) > 0.97
    assert (np.array([rows[i].predicted for i in held]) == y).mean() > 0.95
    assert rows.keys() == {r.doc_id for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id").collect()}


def test_odd_rows_and_labels(spark):
    docs = odd_documents() + [(100 + i, ("good words here. " if i % 2 else "BAD!! %%% ") * (3 + i % 7), "en", "a", 1) for i in range(200)]
    labels = [(100 + i, i % 2, 0) for i in range(200)] + [(101, 1, 1), (102, 1, 0), (1, None, None), (None, 1, 0)]
    df, lab = spark.createDataFrame(docs, DOCS).withColumnRenamed("lang", "Score"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = O.scores(df, lab).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    assert all(r.predicted == r.doc_id % 2 for r in out if r.doc_id and r.doc_id >= 100)
    assert {r.score for r in O.scores(df, lab.limit(0)).collect()} == {0.5}
    assert O.scores(df.limit(0), lab).collect() == []


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"{'word ' * (i % 9)}{'!!' * (i % 4)}", "en", "a", 1) for i in range(120)], DOCS)
    rows = [(i, int(i % 4 == 0), 0) for i in range(120)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in rows]
    one, two = ([tuple(r) for r in O.scores(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).orderBy("doc_id").collect()] for x in (rows, turned))
    assert [r[:2] for r in one] == [r[:2] for r in two] and [r[2] for r in one] == pytest.approx([r[2] for r in two], abs=1e-9)


def test_pooled_blocks_rise():
    rng = np.random.default_rng(1)
    score, count = np.sort(rng.random(50)), rng.integers(1, 9, 50).astype(float)
    total = rng.binomial(count.astype(int), score).astype(float)
    knots, values = O.pool(score, total, count)
    assert (np.diff(values) > 0).all() and (np.diff(knots) > 0).all()


def plain_isotonic(total, count):
    """Each value as the max over starts of the min over ends of the means between."""
    mean = lambda a, b: total[a : b + 1].sum() / count[a : b + 1].sum()
    n = len(total)
    return [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


def test_fit_against_plain(spark, monkeypatch):
    """The model against one that is solved on all rows at once, with another solver and another way of pooling."""
    rng = np.random.default_rng(7)
    k = len(O.STATISTICS)
    x = rng.normal(size=(600, k)) * rng.uniform(0.1, 5, k) + 2
    y = (x[:, 0] + rng.normal(size=600) > 2).astype(int)
    fold = rng.integers(1, 5, 600)
    df = spark.createDataFrame([(r.tolist(), int(a), int(f)) for r, a, f in zip(x, y, fold, strict=True)], "statistics array<double>, label int, fold int")
    monkeypatch.setattr(O, "FAN_IN", 3)
    model = O.fit(df.repartition(11))
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0))
    train, rest = fold < 4, fold == 4
    z = np.clip((x - x.mean(axis=0)) / x.std(axis=0), -6, 6)
    z = np.column_stack([np.ones(600), z, np.cos(z @ model.weights + model.phases) * np.sqrt(2 / O.FEATURES)])
    width, n = z.shape[1], train.sum()
    penalty = 1e-2 * n / width + 1e-9
    ridge = np.linalg.lstsq(np.vstack([z[train], np.sqrt(penalty) * np.eye(width)]), np.concatenate([y[train], np.zeros(width)]), rcond=None)[0]
    assert np.allclose(model.ridge, ridge, atol=1e-6)
    raw = z[rest] @ ridge
    at = np.clip(((raw + 0.5) / 2 * O.BINS).astype(int), 0, O.BINS - 1)
    count = np.bincount(at, minlength=O.BINS).astype(float)
    total, score, there = np.bincount(at, y[rest], O.BINS), np.bincount(at, raw, O.BINS), count > 0
    want = plain_isotonic(total[there], count[there])
    got = model.values[1:-1]
    assert np.allclose(sorted(set(np.round(want, 9))), np.round(got, 9))
    assert np.allclose(model.score(x[rest]), np.interp(raw, model.knots, model.values))
