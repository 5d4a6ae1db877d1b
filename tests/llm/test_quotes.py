import random
import re

from bourselake.llm import quotes as O
from bourselake.llm.queries import op5_quotes

SCHEMA = "conv_id long, turn long, role string, text string"


def norm(x):
    return re.sub(r"\s+", " ", x, flags=re.A).strip(" ").lower()


def holds_run(own, body):
    return any(own[i : i + len(body)] == body for i in range(len(own)))


def plain(rows):
    """Brute force over every pair of messages of a conversation."""
    parsed = {}
    for c, t, role, text in rows:
        ls = []
        for x in re.split(r"\r\n|\n|\r", text or ""):
            m = re.match(r"\s{0,3}>(?:\s?>)*", x, re.A)
            ls.append((m[0].count(">") if m else 0, re.sub(r"^\s{0,3}>(?:\s?>)*\s?", "", x, flags=re.A) if m else x))
        own = [(lv == 0 and not (re.search(r"(?i)\b(?:wrote|writes|schrieb|a écrit|escribió)\s*:\s*$", b) and i + 1 < len(ls) and ls[i + 1][0] > 0)) for i, (lv, b) in enumerate(ls)]
        parsed[c, t] = role, text, ls, own
    first, counts = {}, {}
    for (c, t), (_, _, ls, _) in parsed.items():
        passages, last = [], 0
        for lv, b in ls:
            if lv != last and lv:
                passages.append((lv, []))
            if lv and norm(b):
                passages[-1][1].append(norm(b))
            last = lv
        passages = [p for p in passages if p[1]]
        got = []
        for k, (lv, body) in enumerate(passages):
            votes = {}
            runs = [t2 for (c2, t2), (_, _, l2, o2) in parsed.items() if c2 == c and t2 < t and holds_run([norm(b) for (_, b), o in zip(l2, o2) if o and norm(b)], body)]
            if runs:
                got.append((lv, k, max(runs)))
                continue
            for line in body:
                holders = [t2 for (c2, t2), (_, _, l2, o2) in parsed.items() if c2 == c and t2 < t and line in {norm(b) for (_, b), o in zip(l2, o2) if o}]
                if holders:
                    votes[max(holders)] = votes.get(max(holders), 0) + 1
            got.append((lv, k, max(votes, key=lambda s: (votes[s], s)) if votes else None))
        counts[c, t] = len(passages), sum(g[2] is not None for g in got)
        if any(g[2] is not None for g in got):
            first[c, t] = min(g for g in got if g[2] is not None)[2]
    out = []
    for (c, t), (role, text, ls, own) in parsed.items():
        thread = t
        while (c, thread) in first:
            thread = first[c, thread]
        deepest = max(lv for lv, _ in ls)
        body = re.sub(r"\n{3,}", "\n\n", "\n".join(b for (_, b), o in zip(ls, own) if o)).strip(" ") if deepest else text
        out.append((c, t, role, body, deepest, *counts[c, t], first.get((c, t)), thread))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


MESSAGES = [
    (1, 0, "user", "How do I build it?\nIt fails on Mondays."),
    (1, 1, "assistant", "Run make.\nThen wait."),
    (1, 2, "user", "On Monday bot wrote:\n> run   MAKE.\n> Then wait.\nThat fails."),
    (1, 3, "assistant", "> > Run make.\n> That fails.\n>\nTry again"),
    (1, 4, "user", ">> nobody said this\nok"),
    (1, 5, "user", "Then wait."),
    (1, 6, "assistant", "  >> Then wait.\n> > It fails on Mondays.\n\n\n\nwell"),
    (2, 0, "user", "Run make."),
    (2, 1, "assistant", "> Run make.\r\n> Then wait.\rdone"),
    (2, 2, "user", "a > b and\n->no quote"),
]


def test_nested_quotes_against_plain(spark):
    got = rows(O.conversations(spark.createDataFrame(MESSAGES, SCHEMA).repartition(3)))
    assert got == plain(MESSAGES)
    by = {r[:2]: r for r in got}
    assert by[1, 3][8] == 0 or by[1, 3][8] == 1
    assert by[1, 2][3].strip() == "That fails." and by[1, 2][7] == 1


def test_whole_table(spark, small):
    messages = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(op5_quotes(spark, small)) == plain(messages)


def test_long_chain_and_hot_conversation(spark):
    chain = [(7, 0, "u", "line 0")] + [(7, i, "u", f"> line {i - 1}\nline {i}") for i in range(1, 70)]
    hot = [(8, i, "u", f"same line\n> same line\nown {i}") for i in range(400)]
    got = {r.turn: r for r in O.conversations(spark.createDataFrame(chain + hot, SCHEMA)).where("conv_id = 7").collect()}
    assert all(r.thread == 0 for r in got.values()) and got[69].linked_turn == 68
    out = O.conversations(spark.createDataFrame(hot, SCHEMA)).collect()
    assert len(out) == 400 and all(r.linked_turn == r.turn - 1 for r in out if r.turn)


def test_odd_rows(spark):
    odd = [(None, 1, "u", "> x"), (1, None, "u", "> x"), (1, 1, None, None), (1, 2, "u", ""), (1, 3, "u", "> "), (1, 4, "u", ">" * 90 + "deep"), (1, 4, "u", ">" * 90 + "deep"), (1, 5, "u", "> x\n" * 3000)]
    df = spark.createDataFrame([(*r, 1) for r in odd], SCHEMA + ", Thread int")
    out = O.conversations(df).collect()
    assert len(out) == len(odd) and not any(r.n_linked for r in out)
    assert {r.levels for r in out if r.turn == 4} == {90}
    assert O.conversations(df.limit(0)).collect() == []


def test_all_holders_of_a_line_are_counted(spark):
    rng = random.Random(4)
    messages = [(0, 1, "u", "Hello all\nThe build fails\nRegards"), (0, 2, "u", "Hello all\nFixed\nRegards"), (0, 3, "u", "> Hello all\n> The build fails\n> Regards")]
    for c in range(1, 30):
        for t in range(12):
            own = [f"line {rng.randrange(7)}" for _ in range(rng.randrange(1, 5))]
            quoted = [f"> line {rng.randrange(8)}" for _ in range(rng.randrange(5))]
            messages.append((c, t, "u", "\n".join(quoted + own)))
    held = {(c, t): [x for x in text.lower().split("\n") if x[0] != ">"] for c, t, _, text in messages}
    want = {}
    for c, t, _, text in messages:
        asked = [x[2:].lower() for x in text.split("\n") if x[0] == ">"]
        votes = [(holds_run(held[c, s], asked), sum(x in held[c, s] for x in asked), s) for s in range(t) if (c, s) in held]
        if asked:
            _, n, s = max(votes, default=(False, 0, None))
            want[c, t] = (n, s if n else None)
    got = {(r.conv_id, r.turn): (r.n_matched, r.linked_turn) for r in O.links(O.parse(spark.createDataFrame(messages, SCHEMA))).collect()}
    assert want[0, 3] == (3, 1) and got == want


def test_passages_are_joined_to_runs_of_earlier_messages(spark):
    rng = random.Random(5)
    messages = [(0, 1, "u", "a\n\nb\nc\nd\ne"), (0, 2, "u", "e\nd\nc\nb\na"), (0, 3, "u", "> b\n>\n> c\n> d"), (0, 4, "u", "> c\n> b\n> e")]
    for t in range(40):
        own = [f"line {rng.randrange(2)}" for _ in range(rng.randrange(1, 40))]
        quoted = [f"> line {rng.randrange(2)}" for _ in range(rng.randrange(8))]
        messages.append((1, t, "u", "\n".join(quoted + own)))
    messages += [(2, 0, "u", "\n".join(f"row {i}" for i in range(3000))), (2, 1, "u", "row 3\nrow 2500"), (2, 2, "u", "\n".join(f"> row {i}" for i in range(1, 2900)))]
    df = spark.createDataFrame(messages + messages[:5], SCHEMA)
    got = {(r.conv_id, r.turn): (r.n_lines, r.n_matched, r.linked_turn) for r in O.links(O.parse(df)).collect()}
    assert got[0, 3] == (3, 3, 1) and got[0, 4] == (3, 3, 2) and got[2, 2] == (2899, 2899, 0)
    held = {t: [x for x in text.split("\n") if x[0] != ">"] for c, t, _, text in messages if c == 1}
    for c, t, _, text in messages:
        asked = [x[2:] for x in text.split("\n") if c == 1 and x[0] == ">"]
        runs = [s for s in range(t) if holds_run(held.get(s, []), asked)]
        if asked and runs:
            assert got[1, t] == (len(asked), len(asked), max(runs))
