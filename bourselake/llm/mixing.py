"""Mixing sources to target weights by Pareto order sampling.

The words of a mix are shared over the sources by weight; no source exceeds `max_repeat` times its words, and
what it can't take is shared again by weight. Within a source a document's expected number of copies is in proportion
to its favour, `max_repeat` at most; what documents at that limit can't take is shared again within the source. The
whole copies of the expected number are certain; the rest is drawn by Pareto order sampling: documents are ranked by the
odds u / (1 - u) of a keyed uniform number over the odds p / (1 - p) of their inclusion probability, and the head of that
order, as many documents as bring the source nearest to its target, gets one copy more.

A source of any size is ranked without a window over it: ranks fall into buckets of about `BUCKET_ROWS` documents, bucket
sums (partial sums before the shuffle) give the bucket in which the target is met, and only that bucket is ordered. What
comes of it is one row per source, with the last rank that is taken; every document then decides by its own columns, so
texts are not shuffled.

Defined cases: a null or empty text has size 0 and is taken 0 words; a very long text is counted whole; a null source is
a source of its own, last in order; rows that repeat doc_id and text are taken alike; a favour that is null or not above
0 counts as 1; an empty table gives an empty mix; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpoint, free_name

#: Documents in a bucket of ranks, about.
BUCKET_ROWS = 2_000
#: Per-source figures are broadcast up to so many sources (counted first), else joined by shuffle.
MAX_BROADCAST_SOURCES = 50_000
SEED = 20240229
#: Words are maximal runs of other characters than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: int, *keys: str) -> Column:
    """A number in (0, 1) that depends on the seed and the keys alone."""
    named = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_repeat: float = 2) -> DataFrame:
    """Rows (source, size, ...), one per source, get their weight, by code point order with null last, and its target.

    Water filling: in the order of room by weight, a source is full while the level of those left would exceed
    its room. One row per source, so one task holds a few numbers per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    room = weighed.withColumn("room", F.col("size") * F.lit(max_repeat))
    fill = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("size").over(every) - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    # the levels fall until the first source that isn't full and are right there; all later sources share it
    levels = room.withColumn("level", level).withColumn("turn", F.row_number().over(fill)).withColumn("open", F.col("weight") * F.col("level") <= F.col("room"))
    first = F.min(F.when(F.col("open"), F.struct("turn", "level"))).over(every)
    return levels.withColumn("target", F.least(F.coalesce(F.col("weight") * first["level"], F.col("room")), F.col("room"))).drop("room", "level", "turn", "open")


def rounded(favour: Column) -> Column:
    """Cut to four binary digits, so that a source has a bounded number of different favours; integers to 16 stay."""
    valid = F.when((favour > 0) & (favour < float("inf")), favour).otherwise(1.0)
    step = F.pow(F.lit(2.0), F.floor(F.log2(valid)) - 3)
    return F.greatest(F.floor(valid / step) * step, F.lit(1e-300))


def measured(docs: DataFrame, seed: int, size: Column | None, favour: Column | None) -> dict[str, Column]:
    """What a document's own columns say of it."""
    own = F.lit(1.0) if favour is None else F.coalesce(favour.cast("double"), F.lit(1.0))
    return {"size": word_count(F.col("text")) if size is None else size, "favour": rounded(own), "u": uniform(seed, "doc_id"), "tie": F.xxhash64("text")}


def levels(sized: DataFrame, weights: tuple[float, ...], share: float, max_repeat: float) -> DataFrame:
    """Per source: of, source_size, target, n, level (copies are level * favour), sure_words, mean_p."""
    kinds = checkpoint(sized.groupBy("source", "favour").agg(F.sum("size").alias("size"), F.count("*").alias("n")))
    total = targets(kinds.groupBy("source").agg(F.sum("size").alias("size"), F.sum("n").alias("n")), weights, share, max_repeat)
    total = total.select(F.col("source").alias("of"), F.col("size").alias("source_size"), F.col("n").alias("rows"), "target")
    kinds = kinds.join(total, F.col("source").eqNullSafe(F.col("of")))
    # water filling: the most favoured documents are at their limit while the level of those left would exceed it
    by = Window.partitionBy("of").orderBy(F.desc("favour"))
    full = F.coalesce(F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * F.lit(float(max_repeat))
    left = F.sum(F.col("size") * F.col("favour")).over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    kinds = kinds.withColumn("level", F.try_divide(F.col("target") - full, left))
    first = F.max(F.when(F.col("level") * F.col("favour") <= max_repeat, F.struct("favour", "level"))).over(Window.partitionBy("of"))
    kinds = kinds.withColumn("level", first["level"])
    copies = rate(max_repeat)
    return kinds.groupBy("of", "source_size", "target", F.col("rows").alias("n"), "level").agg(F.sum(F.floor(copies).cast("long") * F.col("size")).alias("sure_words"), (F.sum(F.col("n") * inclusion(copies)) / F.sum("n")).alias("mean_p"))


def rate(max_repeat: float) -> Column:
    """Expected copies; without a level every document is at its limit."""
    most = F.lit(float(max_repeat))
    return F.when(F.col("source_size") > 0, F.least(F.coalesce(F.col("level") * F.col("favour"), most), most)).otherwise(0.0)


def inclusion(copies: Column) -> Column:
    return F.least(F.greatest(copies - F.floor(copies), F.lit(1e-12)), F.lit(1 - 1e-12))


def placed(rows: DataFrame, max_repeat: float, bucket_rows: int) -> DataFrame:
    """`rows` with the levels of their source get `sure` copies, their Pareto `rank` and its `bucket`."""
    odds = lambda p: p / (1 - p)
    p = inclusion(rate(max_repeat))
    even = odds(F.col("u")) / odds(p) * odds(F.col("mean_p"))  # the same order, spread over 0 to 1
    rows = rows.withColumns({"sure": F.floor(rate(max_repeat)).cast("long"), "rank": even / (1 + even)})
    buckets = F.floor(F.col("n") / bucket_rows) + 1
    return rows.withColumn("bucket", F.least(F.floor(F.col("rank") * buckets), buckets - 1).cast("long"))


def cuts(sized: DataFrame, weights: tuple[float, ...], share: float, max_repeat: float, bucket_rows: int) -> DataFrame:
    """The levels of each source with `cut`, the bucket in which its target is met (null: in none), and `last`, the last
    (rank, doc_id, tie) that is taken there."""
    known = checkpoint(levels(sized, weights, share, max_repeat))
    ranked = placed(sized.join(small(known), F.col("source").eqNullSafe(F.col("of"))), max_repeat, bucket_rows)
    head = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranked.groupBy("of", "bucket", (F.col("target") - F.col("sure_words")).alias("rest")).agg(F.sum("size").alias("words")).withColumn("before", F.coalesce(F.sum("words").over(head), F.lit(0)))
    met = checkpoint(sums.where("before + words > rest").groupBy("of").agg(F.min(F.struct("bucket", "before", "rest")).alias("m")).select(F.col("of").alias("met"), "m.*").withColumnRenamed("bucket", "cut"))
    inner = ranked.join(small(met), F.col("of").eqNullSafe(F.col("met")) & (F.col("bucket") == F.col("cut")))
    alike = inner.groupBy("of", "rank", "doc_id", "tie", "cut", "before", "rest").agg(F.sum("size").alias("size"))
    # a document is taken while half of it at least is below the target
    within = Window.partitionBy("of").orderBy("rank", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("size") / 2 <= F.col("rest")
    last = alike.withColumn("taken", taken).groupBy("of", "cut").agg(F.max(F.when(F.col("taken"), order())).alias("last")).withColumnRenamed("of", "met")
    return known.join(small(checkpoint(last)), F.col("of").eqNullSafe(F.col("met")), "left").drop("met")


def order() -> Column:
    return F.struct("rank", F.col("doc_id").isNotNull().alias("there"), "doc_id", "tie")


def small(df: DataFrame) -> DataFrame:
    """A checkpointed table of one row per source is broadcast up to MAX_BROADCAST_SOURCES of them."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_SOURCES else df


def decided(rows: DataFrame, max_repeat: int, bucket_rows: int) -> DataFrame:
    """`rows` with the cuts of their source get `copies` and `taken`."""
    rows = placed(rows, max_repeat, bucket_rows)
    extra = F.col("cut").isNull() | (F.col("bucket") < F.col("cut")) | (F.col("bucket") == F.col("cut")) & F.coalesce(order() <= F.col("last"), F.lit(False))
    copies = F.least(F.col("sure") + (extra & (F.col("target") > 0)).cast("long"), F.lit(max_repeat).cast("long"))
    return rows.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_repeat: int = 2, seed: int = SEED, size: Column | None = None, favour: Column | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, copies, taken (words taken, repeats counted), tie (hash of the text).

    `favour`: a positive number per document (null: 1); expected copies within a source are in proportion to it.
    """
    own = measured(docs, seed, size, favour)
    sized = checkpoint(docs.select("doc_id", "source", *[c.alias(n) for n, c in own.items()]))  # the text is read and counted once
    per_source = checkpoint(cuts(sized, weights, share, max_repeat, bucket_rows))
    joined = sized.join(small(per_source), F.col("source").eqNullSafe(F.col("of")))
    return decided(joined, max_repeat, bucket_rows).select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "tie")


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_repeat: int = 2, seed: int = SEED, favour: Column | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The documents that the mix takes, all columns as they are, with copies, taken and target.

    Each decides in place by the cut of its source; a column of one of these names is replaced.
    """
    own = measured(docs, seed, None, favour)
    sized = checkpoint(docs.select("doc_id", "source", *[c.alias(n) for n, c in own.items()]))
    per_source = checkpoint(cuts(sized, weights, share, max_repeat, bucket_rows))
    row = free_name(docs, "_document")
    rows = docs.select(F.struct(*docs.columns).alias(row), "doc_id", "source", *[c.alias(n) for n, c in own.items()])
    joined = decided(rows.join(small(per_source), F.col("source").eqNullSafe(F.col("of"))), max_repeat, bucket_rows).where("copies > 0")
    kept = [c for c in docs.columns if c.lower() not in ("copies", "taken", "target")]
    return joined.select(*[F.col(row)[c].alias(c) for c in kept], "copies", "taken", "target")
