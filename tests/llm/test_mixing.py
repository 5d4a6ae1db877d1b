import collections

import pytest

from bourselake.llm import mixing
from bourselake.llm.queries import op1_mix_sources
from tests.llm.plain import DOCS, odd_documents, space_words


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    share, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        level = (share - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    return target


def held(rows, docs):
    sizes, largest = collections.Counter(), collections.Counter()
    for _, text, _, source, _ in docs:
        n = len(space_words(text))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    want, taken = plain_targets(sizes), collections.Counter()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6, (s, taken[s], t)


def test_whole_table(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = op1_mix_sources(spark, small).collect()
    held(rows, docs)
    assert sorted(map(str, rows)) == sorted(map(str, op1_mix_sources(spark, small).collect()))


def test_odd_rows_and_few_per_bucket(spark):
    docs = odd_documents() + [(100 + i, "w " * (1 + i * i % 90), "en", "abc"[i % 3], 1) for i in range(300)]
    df = spark.createDataFrame(docs, DOCS).withColumnsRenamed({"lang": "P"}).repartition(3)
    held(mixing.mix(df, bucket_rows=7).collect(), docs)


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []


def test_favoured_documents_are_drawn_more_often(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'w w w' as text", "if(id % 2 = 0, 'a', 'b') as source")
    out = mixing.mix(docs, weights=(1, 1), share=0.5, favour=mixing.F.when(mixing.F.col("doc_id") % 4 < 2, 3.0).otherwise(1.0))
    drawn = {r[0]: r[1] for r in out.groupBy(mixing.F.col("doc_id") % 4 < 2).sum("copies").collect()}
    assert sum(drawn.values()) == pytest.approx(2000, abs=2)
    assert 2.6 < drawn[True] / drawn[False] < 3.4


def test_what_documents_at_their_limit_cannot_take_is_shared_again(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'w w w' as text", "'a' as source")
    out = mixing.mix(docs, weights=(1,), share=1.9, favour=mixing.F.when(mixing.F.col("doc_id") % 2 == 0, 50.0).otherwise(1.0))
    taken = {r[0]: r[1] for r in out.groupBy(mixing.F.col("doc_id") % 2).sum("taken").collect()}
    assert taken[0] == 12_000 and abs(taken[0] + taken[1] - 22_800) <= 2


def test_documents_decide_in_place_as_in_the_mix(spark):
    docs = odd_documents() + [(100 + i, "w " * (1 + i * i % 90), "en", "abc"[i % 3], 1) for i in range(200)]
    df = spark.createDataFrame(docs, DOCS).withColumnsRenamed({"lang": "U", "n_chars": "Target"}).repartition(3)
    want = sorted(str((r.doc_id, r.copies, r.taken)) for r in mixing.mix(df, bucket_rows=9).where("copies > 0").collect())
    mixed = mixing.mixed(df, bucket_rows=9)
    assert sorted(str((r.doc_id, r.copies, r.taken)) for r in mixed.collect()) == want
    assert mixed.columns == ["doc_id", "text", "U", "source", "copies", "taken", "target"]
