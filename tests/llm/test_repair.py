import collections
import functools
import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from bourselake.llm import repair as O
from bourselake.llm.queries import op12_repair

ROWS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Counts, cost, audit and repaired text of one conversation, by trying every edit."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(SPACE)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, state, inserted):
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 3:
            for role in ("user", "assistant"):
                if role[0] in follow[state]:
                    cost, audit, rest = best(i, role[0], inserted + 1)
                    options.append((5 + cost, "I" + audit, (f"{role}:", *rest)))
        if i < len(rows):
            cost, audit, rest = best(i + 1, state, 0)
            options.append((2 + cost, "D" + audit, rest))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                for letter, paid, role in (("K", 0, rows[i][2]), ("R", 1, "user"), ("R", 1, "assistant")):
                    if role[:1] and role[0] in follow[state]:
                        cost, audit, rest = best(i + 1, role[0], 0)
                        options.append((paid + more + cost, letter + audit, (f"{role}:{rows[i][3]}", *rest)))
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    count = collections.Counter(faults)
    return gaps, count["blank"], count["duplicate"], count["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected(rows):
    groups = {r[0]: [] for r in rows}
    for r in plain_damage(rows):
        groups[r[0]].append(r)
    return {k: plain_repair(v) for k, v in groups.items()}


def drawn(seed, most=14):
    draw = random.Random(seed)
    texts = ["Yes.", "no", "Is it?", "", None, " \t", "Well!  \n", "a.b", "Yes. ", "été.", "ends "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "uncle", "A"]
    return [(conv if conv < 58 else None, draw.choice([t, t, t, draw.randrange(9), None]), draw.choice(roles), draw.choice(texts)) for conv in range(60) for t in range(draw.randrange(most))]


def got(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_against_trying_every_edit(spark):
    rows = drawn(1)
    df = spark.createDataFrame(rows, ROWS).withColumn("Cost", F.lit(1)).repartition(5)
    assert got(O.report(O.damaged(df))) == expected(rows)


def test_conversations_in_pieces(spark):
    """The same rows, with conversations cut at a few rows or bytes."""
    rows = drawn(2, 40)
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    want = expected(rows)
    for most in ({"most_rows": 5}, {"most_bytes": 12}, {"most_rows": 1}):
        assert got(O.report(O.damaged(df), **most)) == want


def test_one_conversation_with_most_rows(spark):
    rows = [(7, i // 3, ["user", "assistant", "user"][i % 3], f"Text {i % 50}." if i % 7 else "open") for i in range(3_000)] + [(8, 1, "user", "Hi."), (8, 2, "assistant", "Ho.")]
    whole = got(O.report(spark.createDataFrame(rows, ROWS)))
    cut = got(O.report(spark.createDataFrame(rows, ROWS).repartition(4), most_rows=100))
    assert whole == cut and whole[8][6] == "KK"
    solved, known = O._long(O.marked(spark.createDataFrame(rows[:-2], ROWS)), 100, 10**6)
    assert solved.select("piece").distinct().count() >= 30 and known.count() == 1


def test_turns_and_empty_tables(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Why?"), (1, 2, "user", "Why?"), (1, 3, "assistant", "So."), (2, 0, "assistant", "Hm.")]
    out = O.turns(spark.createDataFrame(rows, ROWS)).orderBy("conv_id", "piece", "position").collect()
    assert [(r.conv_id, r.role, r.text) for r in out] == [(1, "system", "Be kind."), (1, "user", "Why?"), (1, "assistant", "So.")]
    empty = spark.createDataFrame([], ROWS)
    assert O.report(O.damaged(empty)).collect() == [] and O.turns(empty).collect() == []
    dropped = next(i for i in range(99) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert got(O.report(O.damaged(spark.createDataFrame([(dropped, 0, "user", "Hi.")], ROWS)))) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op12_repair(spark, small)) == expected(rows)
