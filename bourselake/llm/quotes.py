"""Quotation linking: which earlier message a chat message quotes, and the conversation without the quotes.

Lines that begin with ``>`` marks are quoted, their number is the quote level; a passage is a run of quoted lines of
one level. Lines are normalised (marks off, white space collapsed, lower case), blank ones don't count. Passages are
hashed and joined to the equal runs of own lines of earlier messages; the latest message that holds such a run is the
original. The hash of a run of n lines is made of those of its first and its last 2^k lines, k the greatest with
2^k <= n, and these of halves in turn. So a message has a hash for each line and power of two, however many lengths
are quoted: runs are found by one join on the first 2^k lines and one on the last.

Passages that no message holds as one run (shortened, wrapped, edited) belong to the earlier message that holds most of
their lines, the latest of equals. Lines that are quoted meet the same lines of earlier messages in one sorted pass per
(conversation, line), which gives the latest message that holds the line as its own, and how many do. Where one message
is the latest holder of all lines that any holds, it is that one. For other passages the votes of the latest holders
are a least count, so the winner holds one of the rarest lines that together exceed what it may miss: the holders of
these are the candidates, and all lines of the passage are counted for each.

Replies follow what they answer: a message whose first passage is linked goes to the thread of the linked message,
others begin one; (thread, turn) is the order of the conversation. Threads are found by pointer doubling, a
checkpoint per step. A line such as ``On Monday Ann wrote:`` right before a quote goes with the quote.

Defined cases: null and empty texts have no lines and stay; a null conv_id or turn takes no part in linking; equal rows
quote once, other rows that share (conv_id, turn) quote and are quoted as one message; other columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpoint

_MARKS = r"^\s{0,3}>(?:\s?>)*"
_INTRO = r"(?i)\b(?:wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"
MAX_STEPS = 40


def lines(text: Column) -> Column:
    """Array of (level, body, own): quote level, text without marks, whether it stays in the message."""
    split = F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r")
    parsed = F.transform(split, lambda x: F.struct(F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 0), "[^>]", "")).alias("level"), F.regexp_replace(x, rf"{_MARKS}\s?", "").alias("body")))
    return F.transform(parsed, lambda x, i: F.struct(x["level"].alias("level"), x["body"].alias("body"), ((x["level"] == 0) & ~(x["body"].rlike(_INTRO) & (F.coalesce(F.get(parsed, i + 1)["level"], F.lit(0)) > 0))).alias("own")))


def normal(body: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(body, r"\s+", " ")))


def parse(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, the text without quotes, the deepest quote level, and the lines as parsed."""
    parsed = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", lines(F.col("text")).alias("lines"))
    kept = F.trim(F.regexp_replace(F.array_join(F.transform(F.filter("lines", lambda x: x["own"]), lambda x: x["body"]), "\n"), r"\n{3,}", "\n\n"))
    quoted = F.exists("lines", lambda x: x["level"] > 0)
    deepest = F.array_max(F.transform("lines", lambda x: x["level"]))
    return parsed.withColumns({"own_text": F.when(quoted, kept).otherwise(F.col("text")), "levels": F.coalesce(deepest, F.lit(0)).cast("long")})


def quoted_lines(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, passage (a number within the message), level, hash of each quoted line that isn't blank."""
    row = F.posexplode("lines").alias("at", "x")
    asking = parsed.where("levels > 0 and conv_id is not null and turn is not null")
    # dealt by message first, so that equal rows are dropped and passages counted in one exchange
    asking = asking.select("conv_id", "turn", "lines", F.xxhash64("text").alias("copy")).repartition("conv_id", "turn").dropDuplicates(["conv_id", "turn", "copy"])
    found = asking.select("conv_id", "turn", row)
    order = Window.partitionBy("conv_id", "turn").orderBy("at")
    found = found.select("conv_id", "turn", "at", "x.*").withColumn("new", (F.col("level") != F.lag("level", 1, 0).over(order)).cast("int"))
    found = found.withColumn("passage", F.sum("new").over(order)).where("level > 0").withColumn("line", normal(F.col("body")))
    return found.where("line <> ''").select("conv_id", "turn", "at", "passage", "level", F.xxhash64("line").alias("line"))


def counted(best: DataFrame, found: DataFrame, own: DataFrame) -> DataFrame:
    """`best` (n, source) of each passage by all earlier holders of its lines; given are the votes of the latest ones.

    `found` has the lines of the passages (line, weight, holders), `own` the messages (turn) that hold each line.
    """
    key = ["conv_id", "turn", "passage"]
    unsure = checkpoint(best.where("matched > best.n").select(*key, (F.col("matched") - F.col("best.n")).alias("spare")))
    if unsure.isEmpty():
        return best.select(*key, "best")
    each = found.join(unsure, key).select(*key, "line", "weight", "holders", "spare")
    rarer = Window.partitionBy(*key).orderBy("holders", "line").rowsBetween(Window.unboundedPreceding, -1)
    rare = each.withColumn("before", F.coalesce(F.sum("weight").over(rarer), F.lit(0))).where("before <= spare")
    holds = own.select("conv_id", "line", F.col("turn").alias("source"))
    candidates = rare.join(holds, ["conv_id", "line"]).where("source < turn").select(*key, "source").distinct()
    votes = candidates.join(each, key).join(holds, ["conv_id", "line", "source"]).groupBy(*key, "source").agg(F.sum("weight").alias("n"))
    sure = votes.groupBy(*key).agg(F.max(F.struct("n", "source")).alias("best"))
    return best.join(unsure, key, "left_anti").select(*key, "best").unionByName(sure)


def own_lines(parsed: DataFrame, asked: DataFrame) -> DataFrame:
    """conv_id, turn, copy (of rows that repeat these), at, line: the own lines of all messages in conversations that quote."""
    own = parsed.where("conv_id is not null and turn is not null").join(asked.select("conv_id").distinct(), "conv_id", "left_semi")
    bodies = F.filter(F.transform(F.filter("lines", lambda x: x["own"]), lambda x: normal(x["body"])), lambda x: x != "")
    own = own.select("conv_id", "turn", F.transform(bodies, lambda x: F.xxhash64(x)).alias("hashes"))
    own = own.withColumn("copy", F.xxhash64("hashes")).dropDuplicates(["conv_id", "turn", "copy"])
    return own.select("conv_id", "turn", "copy", F.posexplode("hashes").alias("at", "line"))


def blocks(rows: DataFrame, key: list[str], most: int) -> DataFrame:
    """key, at, k, hash: a row for each line and each k to `most`, with the hash of the 2^k lines from there on."""
    order = Window.partitionBy(*key).orderBy("at")
    rows = rows.select(*key, "at", F.col("line").alias("hash_0"))
    for k in range(most):
        half = F.lead(f"hash_{k}", 2**k).over(order)
        rows = rows.withColumn(f"hash_{k + 1}", F.when(half.isNotNull(), F.xxhash64(f"hash_{k}", half)))
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"hash_{k}").alias("hash")) for k in range(most + 1)])
    return rows.select(*key, "at", F.explode(each).alias("x")).select(*key, "at", "x.k", "x.hash").where("hash is not null")


def latest(holders: DataFrame, asked: DataFrame, key: list[str]) -> DataFrame:
    """The rows of `asked` that have an earlier holder (key, turn), with `source`, the latest one, and `holders`, their number."""
    both = asked.unionByName(holders.select(*key, "turn"), allowMissingColumns=True)
    earlier = Window.partitionBy(*key).orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    holder = F.when(F.col("passage").isNull(), F.col("turn"))
    return both.withColumns({"source": F.max(holder).over(earlier), "holders": F.count(holder).over(earlier)}).where("passage is not null and source is not null")


def whole(passages: DataFrame, held: DataFrame) -> DataFrame:
    """conv_id, turn, passage, source of the passages that an earlier message holds as one run of its own lines."""
    sought = passages.select("conv_id", "k", F.col("head").alias("hash"), "tail", "passage_hash", "skip").distinct()
    begun = held.join(sought, ["conv_id", "k", "hash"]).select("conv_id", "turn", "copy", (F.col("at") + F.col("skip")).alias("at"), "k", F.col("tail").alias("hash"), "passage_hash")
    holders = begun.join(held, ["conv_id", "turn", "copy", "at", "k", "hash"], "left_semi").select("conv_id", "passage_hash", "turn").distinct()
    return latest(holders, passages.select("conv_id", "passage_hash", "turn", "passage"), ["conv_id", "passage_hash"]).select("conv_id", "turn", "passage", "source")


def by_lines(asked: DataFrame, held: DataFrame) -> DataFrame:
    """conv_id, turn, passage, best (n, source) of the passages in `asked` of which an earlier message holds a line."""
    key = ["conv_id", "turn", "passage"]
    own = held.where("k = 0").select("conv_id", F.col("hash").alias("line"), "turn").distinct()
    own = checkpoint(own.join(asked.select("conv_id", "line").distinct(), ["conv_id", "line"], "left_semi"))
    found = latest(own, asked.select("conv_id", "line", "turn", "at", "passage"), ["conv_id", "line"])
    found = checkpoint(found.groupBy(*key, "line", "source", "holders").agg(F.count("*").alias("weight")))
    votes = found.groupBy(*key, "source").agg(F.sum("weight").alias("n"))
    best = votes.groupBy(*key).agg(F.max(F.struct("n", "source")).alias("best"), F.sum("n").alias("matched"))
    return counted(checkpoint(best), found, own)


def links(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, passage, level, passage_hash, n_lines, n_matched, linked_turn (null: no original) of each passage."""
    key = ["conv_id", "turn", "passage"]
    asked = quoted_lines(parsed)
    placed = F.row_number().over(Window.partitionBy(*key).orderBy("at", "line")) - 1
    asked = checkpoint(asked.withColumns({"at": placed, "n_lines": F.count("*").over(Window.partitionBy(*key))}))
    longest = asked.agg(F.max("n_lines")).first()[0] or 1
    most = longest.bit_length() - 1
    first = asked.where("at = 0").select(*key, "level", "n_lines", (F.length(F.bin("n_lines")) - 1).alias("k")).withColumn("skip", F.expr("n_lines - shiftleft(1L, k)"))
    ends = blocks(asked, key, most).join(first, [*key, "k"])
    passages = ends.groupBy(*key, "level", "n_lines", "k", "skip").agg(F.max(F.when(F.col("at") == 0, F.col("hash"))).alias("head"), F.max(F.when(F.col("at") == F.col("skip"), F.col("hash"))).alias("tail"))
    passages = checkpoint(passages.withColumn("passage_hash", F.xxhash64("n_lines", "head", "tail")))
    needed = passages.select("conv_id", "k", F.explode(F.array("head", "tail")).alias("hash")).unionByName(asked.select("conv_id", F.lit(0).alias("k"), F.col("line").alias("hash")))
    held = checkpoint(blocks(own_lines(parsed, asked), ["conv_id", "turn", "copy"], most).join(needed.distinct(), ["conv_id", "k", "hash"], "left_semi"))
    exact = checkpoint(whole(passages, held))
    best = by_lines(asked.join(exact, key, "left_anti"), held).select(*key, "best.n", F.col("best.source").alias("nearest"))
    out = passages.join(exact, key, "left").join(best, key, "left")
    n_matched = F.when(F.col("source").isNotNull(), F.col("n_lines")).otherwise(F.coalesce("n", F.lit(0).cast("long")))
    return out.select(*key, "level", "passage_hash", "n_lines", n_matched.alias("n_matched"), F.coalesce("source", "nearest").alias("linked_turn"))


def threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, linked_turn) of linked messages gets the turn at which its chain of replies begins."""
    now = checkpoint(replies.select("conv_id", "turn", F.col("linked_turn").alias("thread")))
    for _ in range(MAX_STEPS):
        up = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"))
        after = checkpoint(now.join(up, ["conv_id", "thread"], "left"))
        if after.where("next is not null").isEmpty():
            break
        now = after.select("conv_id", "turn", F.coalesce("next", "thread").alias("thread"))
    return now.select("conv_id", "turn", "thread")


def conversations(messages: DataFrame) -> DataFrame:
    """Per message, to be read in the order (conv_id, thread, turn): conv_id, turn, role, text without quotes, levels,
    n_passages, n_linked, linked_turn of the first passage that has one, thread."""
    parsed = parse(messages)
    found = checkpoint(links(parsed))
    each = found.groupBy("conv_id", "turn").agg(F.count("*").alias("n_passages"), F.count("linked_turn").alias("n_linked"), F.min(F.when(F.col("linked_turn").isNotNull(), F.struct("level", "passage", "linked_turn"))).alias("first"))
    each = checkpoint(each.select("conv_id", "turn", "n_passages", "n_linked", F.col("first.linked_turn").alias("linked_turn")))
    replies = threads(each.where("linked_turn is not null"))
    # messages without quotes, in most corpora nearly all, meet only the few rows of those that quote
    linked = each.join(replies, ["conv_id", "turn"], "left")
    out = parsed.join(linked, ["conv_id", "turn"], "left")
    count = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select("conv_id", "turn", "role", F.col("own_text").alias("text"), "levels", count("n_passages"), count("n_linked"), "linked_turn", F.coalesce("thread", "turn").alias("thread"))
