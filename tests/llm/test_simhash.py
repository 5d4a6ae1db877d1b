import collections
import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from bourselake.llm import simhash as O
from bourselake.llm.queries import op6_simhash
from tests.llm.plain import DOCS, lower, odd_documents, space_words


def plain_print(text, k=3):
    w = space_words(lower(text))
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, n):
    group = list(range(n))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in pairs:
        group[max(top(a), top(b))] = min(top(a), top(b))
    return [top(i) for i in range(n)]


def plain(docs):
    prints = sorted({plain_print(t) for _, t in docs})
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = dict(zip(prints, plain_components(pairs, len(prints)), strict=True))
    smallest = {}
    for d, t in docs:
        r = root[plain_print(t)]
        if d is not None:
            smallest[r] = min(smallest.get(r, d), d)
    return sorted(((d, f"{plain_print(t):016x}", smallest.get(root[plain_print(t)])) for d, t in docs), key=str)


def test_whole_table(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(docs)
    assert len({r[2] for r in want}) < len(want)
    assert sorted(map(tuple, op6_simhash(spark, small).collect()), key=str) == want


def test_odd_rows(spark):
    docs = odd_documents()
    df = spark.createDataFrame(docs, DOCS).withColumnsRenamed({"lang": "Mask", "source": "value"})
    assert sorted(map(tuple, O.groups(df).collect()), key=str) == plain([d[:2] for d in docs])
    assert O.groups(df.limit(0)).collect() == []


@pytest.mark.parametrize("most", [2, 512])
def test_split_shards_lose_no_group(spark, most):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(6)]
    numbers = sorted({c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(7))) & (2**64 - 1) for c in centres for _ in range(60)})
    signed = [x - (x >> 63 << 64) for x in numbers]
    df = spark.createDataFrame([(x, x) for x in signed], "fingerprint long, node long")
    found = O.components(O.links(O.shards(df, most=most), ["mask", "value"], "node", 3)).collect()
    pairs = [(i, j) for i in range(len(numbers)) for j in range(i) if (numbers[i] ^ numbers[j]).bit_count() <= 3]
    sizes = collections.Counter(plain_components(pairs, len(numbers)))
    assert sorted(collections.Counter(r.root for r in found).values()) == sorted(v for v in sizes.values() if v > 1)


def test_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001)]
    found = {r.node: r.root for r in O.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**10), max_size=60), st.integers(0, 4))
def test_tree_finds_all_within_radius(numbers, radius):
    tree = O.Tree(radius)
    for i, x in enumerate(numbers):
        assert sorted(tree.near(x)) == [j for j in range(i) if (numbers[j] ^ x).bit_count() <= radius]
        tree.insert(x, i)


def template_texts(rng, n):
    """Shingle sets that share 240 of 300, all in one band shard, and one pair at 0.82 hidden among them."""
    share = rng.sample(range(10**6), 240)
    sets = [sorted(share + [10**6 + i * 100 + k for k in range(60)]) for i in range(n)]
    sets[-1] = sorted(share + sets[0][240:270] + [10**9 + k for k in range(30)])
    prints = []
    for x in sets:
        hashes = [xxhash.xxh64_intdigest(str(k).encode(), 42) for k in x]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return sets, prints


@pytest.mark.parametrize("part", [7, 1024])
def test_true_pair_among_texts_of_a_template(spark, monkeypatch, part):
    sets, prints = template_texts(random.Random(5), 150)
    assert (prints[0] ^ prints[-1]).bit_count() <= O.WIDE_RADIUS
    signed = [x - (x >> 63 << 64) for x in prints]
    monkeypatch.setattr(O, "PART_NODES", part)
    members = spark.createDataFrame([(f"{i:03d}", 0, 1, x) for i, x in enumerate(signed)], "node string, band int, value long, fingerprint long")
    first = O.first_links(members)
    assert first.where("b is null").count() == len(sets)
    shingles = spark.createDataFrame([(f"{i:03d}", x) for i, x in enumerate(sets)], "node string, shingles array<int>")
    none = spark.createDataFrame([], "node string, root string")
    found = O.last_links(members, none, shingles, 0.8).distinct().collect()
    assert [{r.a, r.b} for r in found] == [{"000", "149"}]


def test_near_duplicates_tests_every_candidate_of_a_shard(spark, monkeypatch):
    """With one band, all texts of a template share a shard or none; the groups are those of all pairs in the radius."""
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    share = words(240)
    texts = [share + words(60) for _ in range(60)]
    texts += [t[:270] + words(20) + t[290:] for t in texts[:20]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    monkeypatch.setattr(O, "band_keys", lambda hashes, each: O.np.tile(O.np.arange(O.BANDS, dtype=O.np.uint64), (len(each), 1)))
    out = {r.doc_id: r.keep_doc for r in O.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    prints = [c.fingerprint & 2**64 - 1 for c in O.traits(spark.createDataFrame(docs, "doc_id long, text string"), 5).orderBy("doc_id").collect()]
    alike = [(i, j) for i in range(len(sets)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= O.WIDE_RADIUS and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(alike) >= 15
    assert [out[i] for i in range(len(docs))] == plain_components(alike, len(docs))


def test_repeated_lines_do_not_part_near_duplicates(spark):
    rng = random.Random(9)
    docs = []
    for i in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        line = words[:20]
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(line * 100 + words))]
    out = {r.doc_id: r.keep_doc for r in O.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out == {i: i // 2 * 2 for i in range(80)}
