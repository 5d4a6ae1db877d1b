import collections
import html.parser
import math
import random

from pyspark.sql import functions as F

from bourselake.llm import language as O
from bourselake.llm.queries import op4_language
from tests.llm.plain import DOCS, odd_documents

PAGES = "page_id long, url string, html string"


def test_whole_table(spark, small):
    rows = op4_language(spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/pages.parquet").count() == len({r.page_id for r in rows})
    assert all(r.accepted and 0.5 <= r.probability <= 1 for r in rows)
    assert sum(r.language == r.text_language for r in rows) > 0.9 * len(rows)


def test_text_alone_on_unseen_documents(spark, small):
    docs = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet").where("n_chars > 100")
    half = F.col("doc_id") % 2 == 0
    model = O.train(docs.where(half).select("text", F.col("lang").alias("language")))
    out = O.text_scores(docs.where(~half).select("lang", "text"), model)
    n, right = out.agg(F.count("*"), F.count_if(F.col("lang") == F.col("text_language"))).first()
    assert right / n > 0.97


def test_fusion_against_plain(spark):
    languages = ["de", "en", "fr"]
    rows = [(i, [-(i * 7 % 5) / 3, -(i * 3 % 4) / 2, -(i % 3) / 1.5], languages[i * i % 3] if i % 11 else None, "de" if i % 4 else "", "com" if i % 3 else "fr", f"h{i % 5}.d{i % 2}", f"d{i % 2}") for i in range(90)]
    df = spark.createDataFrame(rows, "id long, likelihood array<double>, text_language string, declared string, suffix string, host string, domain string")
    got = {r.id: r for r in O.fuse(df, languages).collect()}
    count = collections.Counter()
    for r in rows:
        for k in ((3, r[3]), (4, r[4]), (5, r[5]), (6, r[6]), (0, "")):
            count[k, r[2]] += 1
    total = [count[(0, ""), x] for x in languages]
    share = [(t + 1) / (sum(total) + 3) for t in total]
    for r in rows:
        own = [float(r[2] == x) for x in languages]
        less = lambda k: [count[k, x] - o for x, o in zip(languages, own)]
        smooth = lambda n, p: [(a + 5 * b) / (sum(n) + 5) for a, b in zip(n, p)]
        prior = smooth(less((5, r[5])), smooth(less((6, r[6])), share))
        post = [r[1][i] + sum(math.log((count[(c, r[c]), x] + 0.5) / (total[i] + 10)) for c in (3, 4)) + math.log(prior[i]) for i, x in enumerate(languages)]
        best = max(range(3), key=post.__getitem__)
        assert got[r[0]].language == languages[best]
        assert abs(got[r[0]].probability - 1 / sum(math.exp(p - post[best]) for p in post)) < 1e-5


def test_evidence_decides_where_the_text_is_empty(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    text = {r.lang: r.text for r in docs.where("n_chars > 400").collect()}
    pages = [(i, "https://www.a.fr/x", f"<html lang='fr'><p>{text['fr']}</p></html>") for i in range(9)]
    pages += [(20, "https://www.a.fr/", "<html lang=fr><script>the and of</script></html>"), (21, None, None), (22, "nonsense", ""), (23, "http://x@b.co:80/", f"<HTML class=a LANG=\"de-AT\">{text['en']}")]
    out = {r.page_id: r for r in O.identify_pages(spark.createDataFrame(pages, PAGES).withColumn("Language", F.lit(1)), docs).collect()}
    assert out[20].language == "fr" and not out[20].accepted and out[20].text_language is None
    assert out[23].declared == "de" and out[23].host == "b.co" and out[23].text_language == "en"
    assert not out[21].accepted and not out[22].accepted and len(out) == 13


def test_pipeline_stage_and_empty_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd = spark.createDataFrame(odd_documents(), DOCS)
    kept = O.keep_identified(docs.unionByName(odd.withColumn("doc_id", F.col("doc_id") + 10**6)))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids >= {r.doc_id for r in docs.collect()} and not ids & {10**6 + i for i in (1, 2, 6, 7)}
    assert O.keep_identified(docs.limit(0)).collect() == []
    pages = spark.read.parquet(f"{small}/pages.parquet")
    assert O.identify_pages(pages.limit(0), docs).collect() == []
    assert {r.language for r in O.identify_pages(pages.limit(3), docs.limit(0)).collect()} == {None}


def test_every_language_is_a_class(spark):
    draw = random.Random(1)
    words = {f"l{i:03d}": "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for i in range(100)}
    rows = [(f"{w} {w}x {w}y {k}", language) for i, (language, w) in enumerate(words.items()) for k in ("ab", "cd", "ef")[: 1 + i % 3]] + [("12 34", "digits"), (None, "nothing")]
    df = spark.createDataFrame(rows, "text string, language string").repartition(4)
    model = O.train(df)
    assert model.languages == sorted(words)
    got = O.text_scores(df.where("language like 'l%'").withColumnRenamed("language", "lang"), model)
    assert got.where("lang <> text_language").count() == 0
    copies = df.unionByName(spark.createDataFrame([(f"{words['l000']} zz", "l001")] * 500, df.schema))
    assert O.train(copies, train_texts=1).languages == sorted(words)


def test_a_language_of_copies_is_a_class(spark):
    copies = spark.range(200_000).select(F.format_string("xylo zebra quartz %d", F.col("id") % 8).alias("text"), F.lit("xx").alias("language"))
    others = spark.range(3_000).select(F.format_string("mellow river lantern %d", "id").alias("text"), F.lit("yy").alias("language"))
    model = O.train(copies.unionByName(others), train_texts=100)
    assert model.languages == ["xx", "yy"]
    assert [r.text_language for r in O.text_scores(spark.createDataFrame([("zebra xylo",), ("lantern river",)], "text string"), model).collect()] == ["xx", "yy"]


def test_web_pages_against_a_plain_parser(spark, small):
    class Plain(html.parser.HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.hidden, self.out = [], []

        def handle_starttag(self, tag, attrs):
            self.hidden += [tag] * (tag in ("script", "style", "head"))

        def handle_endtag(self, tag):
            if self.hidden and self.hidden[-1] == tag:
                self.hidden.pop()

        def handle_data(self, data):
            self.out += [data] * (not self.hidden)

    pages = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html")
    own = spark.createDataFrame([(-1, "https://www.a.co.uk/x", "<html lang=de><p>caf&eacute; na&#239;ve a &lt; b &amp;c</p>"), (-2, None, None)], PAGES)
    got = {r.page_id: r.text for r in O.web_pages(pages.unionByName(own)).collect()}
    for r in pages.unionByName(own).collect():
        if r.html is None:
            assert got[r.page_id] is None
            continue
        plain = Plain()
        plain.feed(r.html)
        plain.close()
        assert got[r.page_id].split() == " ".join(plain.out).split()
    assert got[-1].split() == ["café", "naïve", "a", "<", "b", "&c"]


def test_text_model_against_plain(spark):
    rows = [("der hund und die katze", "de"), ("the dog and the cat", "en"), ("le chien et le chat", "fr"), ("die katze", "de"), ("die katze", "de")]
    model = O.train(spark.createDataFrame(rows, "text string, language string"))
    count = {x: collections.Counter() for x in model.languages}
    for text, x in set(rows):
        padded = text.encode()
        for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
            if a != 32:
                count[x][((a << 16 | b << 8 | c) * 0x9E3779B1 & 0xFFFFFFFF) >> 17] += 1
    for text in ("die hunde", "the cats"):
        grams = [t for a, b, c in zip(text.encode(), text.encode()[1:], text.encode()[2:], strict=False) if a != 32 for t in [((a << 16 | b << 8 | c) * 0x9E3779B1 & 0xFFFFFFFF) >> 17]]
        score = [sum(math.log((count[x][g] + 0.5) / (sum(count[x].values()) + O.BUCKETS / 2)) for g in grams) / len(grams) * min(len(grams), O.GRAMS) for x in model.languages]
        got = O.text_scores(spark.createDataFrame([(text,)], "text string"), model).first()
        assert got.grams == len(grams) and all(abs(a - b) < 1e-3 for a, b in zip(got.likelihood, score, strict=True))
        assert got.text_language == model.languages[max(range(3), key=score.__getitem__)]
