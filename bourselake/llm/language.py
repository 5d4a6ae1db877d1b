"""Language identification by Bayesian fusion of text, declared markup language, address and host.

log posterior = text likelihood + log P(declared | language) + log P(suffix | language) + log P(language | host).

- Text: naive Bayes over hashed byte trigrams, learnt from rows whose language is given: of every language a hashed
  sample of about `TRAIN_TEXTS` distinct texts, or all it has. Grams of one text are not independent, so it counts at
  most `GRAMS` times its mean log-likelihood.
- Declared language and address suffix: grouped counts of each value by the language that the text alone suggests.
- Host: the same counts, smoothed towards those of the registered domain, these towards those of all pages; a row's
  own text is taken out of its host's counts.

The text is scanned once; what is grouped and joined is a few numbers per row. Counts by value are partial sums
before the shuffle, so a host with a third of all rows is one row per task. Every language found is a class, however
rare; the model takes 128 KB for each (of hundreds of languages, tens of megabytes). A class whose texts hold no letter
trigram would win wherever others saw nothing, so it is left out.

Defined cases: a null or empty text has a flat likelihood, so the other evidence decides; a missing declaration or
address is a value of its own; repeated rows count as rows; an empty table gives an empty result; very long texts are
scored whole; without any training text the language is null, and `keep_identified` keeps every text that isn't empty.
"""

from __future__ import annotations

import html
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .shared import checkpoint

TRAIN_TEXTS = 5_000
BUCKETS = 1 << 15
#: Weight of a text, in trigrams, and of the smoothing, in rows.
GRAMS, SMOOTHING = 40, 5.0
#: Values that a declaration or suffix is assumed to have; smooths their probabilities.
VALUES = 20
#: Rows of keys, and numbers in tables of counts, that are broadcast at most.
MAX_BROADCAST_ROWS, MAX_BROADCAST_COUNTS = 50_000, 400_000
NONE = ""

# letters in lower case, all else a blank
_FOLDED = np.where(((W._BYTES | 32) >= 97) & ((W._BYTES | 32) <= 122), W._BYTES | 32, np.where(W._BYTES >= 128, W._BYTES, 32)).astype(np.uint8)


class Model(NamedTuple):
    languages: list[str]
    log_likelihood: np.ndarray  # languages x BUCKETS


def trigrams(t: W.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every trigram within a text that begins with a letter."""
    data = _FOLDED[t.data].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(t.offsets) - 1), np.diff(t.offsets))
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    inside = (row[:-2] == row[2:]) & (data[:-2] != 32)
    return code[inside].astype(np.int64), row[:-2][inside]


def train(rows: DataFrame, train_texts: int = TRAIN_TEXTS) -> Model:
    """`rows`: text and language. Of a language with more than `train_texts` distinct texts, a sample by their hashes,
    which holds the one of the smallest hash in any case."""
    rows = rows.where(F.col("language").isNotNull() & (F.length("text") > 0)).withColumn("hash", F.shiftrightunsigned(F.xxhash64("text"), 24))
    kept = rows.select("language", "hash").distinct().groupBy("language").agg(F.count("*").alias("texts"), F.min("hash").alias("least")).collect()  # a row per language
    languages = sorted(r.language for r in kept)
    if not languages:
        return Model([], np.zeros((0, BUCKETS)))
    most = {r.language: max(r.least + 1, min(2**40, 2**40 * train_texts // r.texts)) for r in kept}
    kinds = rows.sparkSession.createDataFrame([(x, i, most[x]) for i, x in enumerate(languages)], "language string, number long, most long")
    chosen = rows.join(F.broadcast(kinds), "language").where(F.col("hash") < F.col("most"))
    chosen = chosen.select("text", "number").distinct()  # a text that many rows share counts once

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in W.slices(batches, "text"):
            grams, row = trigrams(W.texts(batch.column("text")))
            numbers = batch.column("number").to_numpy()
            sums += np.bincount(numbers[row] * BUCKETS + grams, minlength=sums.size).reshape(sums.shape)
        for i in np.flatnonzero(sums.sum(axis=1)):
            at = np.flatnonzero(sums[i])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i)), pa.array(at), pa.array(sums[i][at])], ["number", "bucket", "n"])

    seen = chosen.mapInArrow(count, "number long, bucket long, n long").groupBy("number", "bucket").agg(F.sum("n").alias("n")).toArrow()
    sums = np.full((len(languages), BUCKETS), 0.5, np.float32)
    sums[seen["number"].to_numpy(), seen["bucket"].to_numpy()] += seen["n"].to_numpy()
    has = np.unique(seen["number"].to_numpy())
    return Model([languages[i] for i in has], np.log(sums[has] / sums[has].sum(axis=1, keepdims=True, dtype=np.float64)).astype(np.float32))


def text_scores(rows: DataFrame, model: Model) -> DataFrame:
    """`rows` without text, with the array `likelihood` (a number per language), `grams` and `text_language`."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    others = [c for c in rows.columns if c != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in W.slices(batches, "text"):
            grams, row = trigrams(W.texts(batch.column("text")))
            n = np.bincount(row, minlength=batch.num_rows)
            sums = np.stack([np.bincount(row, table[grams], batch.num_rows) for table in m.log_likelihood], axis=1)
            mean = sums / np.maximum(n, 1)[:, None]
            best = pa.array(np.array(m.languages, object)[mean.argmax(axis=1)], pa.string(), mask=n == 0)
            scaled = pa.FixedSizeListArray.from_arrays(pa.array((mean * np.minimum(n, GRAMS)[:, None]).ravel()), len(m.languages)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], scaled, pa.array(n), best], [*others, "likelihood", "grams", "text_language"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(score, ", ".join([*kinds, "likelihood array<double>", "grams long", "text_language string"]))


def small(df: DataFrame, width: int = 1) -> DataFrame:
    """Counts by value (`width` numbers a row) are broadcast up to MAX_BROADCAST_COUNTS, counted first, else joined by shuffle."""
    df = checkpoint(df)
    return F.broadcast(df) if df.count() * width <= MAX_BROADCAST_COUNTS else df


def fuse(scored: DataFrame, languages: list[str], smoothing: float = SMOOTHING) -> DataFrame:
    """Adds language and probability to rows of likelihood, text_language, declared, suffix, host and domain."""
    names = F.array(*[F.lit(x) for x in languages])
    seen = {r["text_language"]: r["count"] for r in scored.groupBy("text_language").count().collect()}  # a row per language
    total = [float(seen.get(x, 0)) for x in languages]
    share = F.array(*[F.lit((t + 1) / (sum(total) + len(total))) for t in total])
    totals = F.array(*[F.lit(t) for t in total])

    def by(column: str) -> DataFrame:
        each = scored.groupBy(column, "text_language").agg(F.count("*").cast("double").alias("n"))
        counts = F.map_from_entries(F.collect_list(F.when(F.col("text_language").isNotNull(), F.struct("text_language", "n"))))
        tally = F.transform(names, lambda x: F.coalesce(F.try_element_at("counts", x), F.lit(0.0)))
        return each.groupBy(column).agg(counts.alias("counts")).select(F.col(column).alias(f"_{column}"), tally.alias(f"of_{column}"))

    def given(column: str) -> Column:
        """log P(value | language), by share of the language's rows."""
        return F.zip_with(f"of_{column}", totals, lambda n, t: F.log((n + 0.5) / (t + 0.5 * VALUES)))

    joined = scored
    for column in ("declared", "suffix", "host", "domain"):
        joined = joined.join(small(by(column), len(languages)), F.col(column) == F.col(f"_{column}")).drop(f"_{column}")
    own = F.transform(names, lambda x: F.coalesce((F.col("text_language") == x).cast("double"), F.lit(0.0)))
    less = lambda column: F.zip_with(F.col(f"of_{column}"), own, lambda a, b: a - b)
    smoothed = lambda counts, prior: F.zip_with(counts, prior, lambda n, p: (n + smoothing * p) / (F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + smoothing))
    joined = joined.withColumn("_domain_prior", smoothed(less("domain"), share)).withColumn("_host_prior", smoothed(less("host"), F.col("_domain_prior")))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    posterior = add(add(F.col("likelihood"), F.transform("_host_prior", lambda x: F.log(x))), add(given("declared"), given("suffix")))
    joined = joined.withColumn("_posterior", posterior)
    top = F.array_max("_posterior")
    mass = F.aggregate("_posterior", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    at = F.array_position("_posterior", top).cast("int")
    return joined.select(*scored.columns, F.get(names, at - 1).alias("language"), F.round(1 / mass, 6).alias("probability"))


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """`rows`: text, declared, suffix, host, domain and others. Without text; with grams, text_language, language and
    probability."""
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(NONE)) for c in ("declared", "suffix", "host", "domain")})
    if not model.languages:
        return rows.drop("text").select("*", F.lit(0).cast("long").alias("grams"), *[F.lit(None).cast(t).alias(n) for n, t in (("text_language", "string"), ("language", "string"), ("probability", "double"))])
    return fuse(checkpoint(text_scores(rows, model)), model.languages).drop("likelihood")


def primary_tag(tag: Column) -> Column:
    """``de-AT`` → ``de``; other than two or three letters: none."""
    return F.coalesce(F.nullif(F.regexp_extract(F.lower(tag), r"^\s*([a-z]{2,3})(?:[-_].*)?\s*$", 1), F.lit("")), F.lit(NONE))


#: The last two labels of a host, or three where the last two are a public suffix such as co.uk.
_REGISTERED = r"[^.]+\.(?:ac|co|com|edu|go|gov|ne|net|or|org)\.[a-z]{2}$|[^.]+\.[^.]+$|^[^.]+$"


ENTITY = "&#?[A-Za-z0-9]+"


@F.pandas_udf(T.StringType())
def unescaped(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def web_pages(pages: DataFrame) -> DataFrame:
    """page_id, visible text, declared language and the parts of the address of web pages."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    tag = F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z_-]+)", 1)
    text = F.regexp_replace("html", r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    text = F.when(text.rlike(ENTITY), unescaped(F.when(text.rlike(ENTITY), text))).otherwise(text)  # others stay out of Python
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), text.alias("text"), primary_tag(tag).alias("declared"), host.alias("host"))
    return named.withColumns({"domain": F.regexp_extract("host", _REGISTERED, 0), "suffix": F.regexp_extract("host", r"\.([^.]+)$", 1)})


def identify_pages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Per page: page_id, host, declared, text_language, language, probability, accepted (see `accept`)."""
    model = train(documents.select("text", F.col("lang").alias("language")))
    return identify(web_pages(pages), model).select("page_id", "host", "declared", "text_language", "language", "probability", accept().alias("accepted"))


def accept(least: float = 0.5) -> Column:
    """A row whose text has letters and whose language is likelier than not."""
    return (F.col("grams") > 0) & (F.coalesce(F.col("probability"), F.lit(0.0)) >= least)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents, all columns as they are, whose language is identified; `lang` is their declared language.

    Documents have no address; the source stands for host and domain. Rejected are texts without any letter
    trigram and texts of uncertain language.
    """
    model = train(docs.select("text", F.col("lang").alias("language")))
    if not model.languages:
        return docs.where(F.length("text") > 0)
    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text", primary_tag(F.col("lang")).alias("declared"), F.lit(NONE).alias("suffix"), F.col("source").alias("host"), F.col("source").alias("domain"))
    rejected = checkpoint(identify(rows, model).where(~accept()).select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row")).distinct())
    few = F.broadcast if rejected.count() <= MAX_BROADCAST_ROWS else lambda df: df
    return docs.join(few(rejected), docs["doc_id"].eqNullSafe(F.col("_doc")) & (F.xxhash64(docs["text"]) == F.col("_row")), "left_anti")
