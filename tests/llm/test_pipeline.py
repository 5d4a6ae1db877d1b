import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from bourselake.llm import simhash as O
from tests.llm.plain import DOCS, lower, odd_documents, space_words
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_mixing import held
from tests.llm.test_simhash import plain_components


def plain_groups(docs, k=5, least=0.8):
    """Smallest doc_id of each group of near duplicates, over all pairs."""
    words = [space_words(lower(t)) for _, t in docs]
    sets = [{" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set() for w in words]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if words[i] == words[j] or sets[i] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]
    root = plain_components(pairs, len(docs))
    smallest = {}
    for (d, _), r in zip(docs, root, strict=True):
        smallest[r] = min(smallest.get(r, d), d)
    return set(smallest.values())


def test_near_duplicates_against_all_pairs(spark, small):
    rng = random.Random(3)
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    for i in range(60):  # near copies of one, two or more changed words, and copies in other letter case
        text = docs[i * 3][1].split(" ")
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            text[rng.randrange(len(text))] = f"changed{rng.randrange(99)}"
        docs.append((10_000 + i, " ".join(text)))
    df = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in docs], DOCS).repartition(5)
    kept = [r.doc_id for r in O.drop_near_duplicates(df).select("doc_id").collect()]
    assert len(kept) == len(set(kept)) and set(kept) == plain_groups(docs)


def test_one_group_of_many_near_copies(spark):
    base = [f"word{i}" for i in range(300)]
    docs = []
    for i in range(150):
        text = list(base)
        text[i * 2 % 300] = f"other{i}"
        docs.append((i, " ".join(text), "en", "a", 1))
    assert [r.doc_id for r in O.drop_near_duplicates(spark.createDataFrame(docs, DOCS)).collect()] == [0]


def test_odd_rows_keep_one_of_each(spark):
    df = spark.createDataFrame(odd_documents(), DOCS).withColumnsRenamed({"lang": "Node", "n_chars": "row"}).repartition(3)
    kept = O.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "None", "4", "6", "8"])
    assert O.drop_near_duplicates(df.limit(0)).collect() == []


def test_stages_and_run(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    first = P.identify_language(spark, docs, small)
    second = P.drop_near_duplicates(spark, first, small)
    kept = [tuple(r) for r in second.select("doc_id", "text").collect()]
    assert {d for d, _ in kept} == plain_groups([tuple(r) for r in first.select("doc_id", "text").collect()])
    third = P.decontaminate_benchmark(spark, second, small)
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    clean = {r[0] for r in plain_hits(kept, items) if not r[5]}
    assert {r.doc_id for r in third.collect()} == clean
    fourth = P.replace_personal_data(spark, third, small)
    rows = fourth.collect()
    assert {r.doc_id for r in rows} == clean and all(r.n_chars == len(r.text) for r in rows)
    assert all(x.columns == docs.columns for x in (first, second, third, fourth))
    out = P.run(spark, small).collect()
    assert {(r.doc_id, r.text) for r in out} <= {(r.doc_id, r.text) for r in rows}
    words = {r.doc_id: len(space_words(r.text)) for r in rows}
    assert all(r.taken == r.copies * words[r.doc_id] and r.copies in (1, 2) for r in out)
    from bourselake.llm import mixing

    held(mixing.mix(fourth).collect(), [tuple(r) for r in rows])


def test_a_stage_may_leave_nothing(spark, small):
    none = spark.createDataFrame([], DOCS)
    for _, stage in P.STAGES:
        none = stage(spark, none, small)
    assert none.collect() == []
    odd = spark.createDataFrame(odd_documents(), DOCS).withColumn("extra", F.lit(1))
    for _, stage in P.STAGES:
        odd = stage(spark, odd, small)
    assert odd.count() > 0
