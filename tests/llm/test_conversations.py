from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from claimlens.llm.conversations import cheapest, repair_conversations
from claimlens.llm.queries import op11_conversation_repair

SPACE = " \t\n\r\x0b\x0c"


def first_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        said = text.strip(SPACE)
        if not said:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def best_edits(rows):
    """Cost, audit and lines by a table over rows; a state is what the repaired roles end in."""
    following = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                new = "a" if state == "u" else "u"
                role = "assistant" if new == "a" else "user"
                made = (cost + 5, audit + "I", [*lines, f"{role}:"])
                if new not in table or made[:2] < table[new][:2]:
                    table[new] = made
        return table

    table = inserted({"": (0, "", [])})
    for (role, text), fault in zip(rows, first_faults(rows), strict=True):
        after = {}

        def offer(state, cost, audit, lines, after=after):
            if state not in after or (cost, audit) < after[state][:2]:
                after[state] = (cost, audit, lines)

        for state, (cost, audit, lines) in table.items():
            offer(state, cost + 2, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if role[:1] and role[:1] in following[state]:
                offer(role[0], cost + extra, audit + "K", [*lines, f"{role}:{text}"])
            new = "a" if state == "u" else "u"
            name = "assistant" if new == "a" else "user"
            offer(new, cost + 1 + extra, audit + "R", [*lines, f"{name}:{text}"])
        table = inserted(after)
    return min((table[s] for s in ("", "a") if s in table), key=lambda t: t[:2])


def expected(rows):
    """Report of one conversation's (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    said = [r[1:] for r in rows]
    kinds = first_faults(said)
    turns = {r[0] for r in rows} - {None}
    initials = [role[:1] for role, _ in said]
    cost, audit, lines = best_edits(said)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def after_damage(conv, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    act = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    if act == 0:
        return []
    text = "" if act == 1 else re.sub("[.!?]", "", text) if act == 2 else text
    return [(turn, "user" if act == 4 else role, text)] * (2 if act == 3 else 1)


def check(got, rows):
    by_conv = defaultdict(list)
    for r in rows:
        by_conv[r[0]] += after_damage(*r)
    assert len(got) == len(by_conv)
    for r in got:
        want = expected(by_conv[r["conv_id"]])
        assert tuple(r[c] for c in got[0].__fields__[1:]) == want, r


def some_rows(rng, n):
    roles = ["system", "user", "assistant", "usher", "", "tool", None]
    texts = ["Yes.", "No!", "What", "Well", "", " \n", None, "a.\t", "b?", "cut"]
    return [
        (rng.choice(roles[: rng.choice([3, 7])]), rng.choice(texts if rng.random() < 0.5 else ["%d." % i, "%d" % i]))
        for i in range(n)
    ]


def lines_of(turns):
    by_conv = defaultdict(list)
    for r in turns.collect():
        by_conv[r["conv_id"]].append((r["place"], f"{r['role']}:{r['text']}"))
    return {c: "\n".join(t for _, t in sorted(v)) for c, v in by_conv.items()}


def test_table_of_conversations(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/conversations.parquet").collect()]
    check(op11_conversation_repair(spark, small_dir).collect(), rows)


def test_damage_nulls_ties_and_lost_conversations(spark, tmp_path):
    rng = random.Random(3)
    rows = [(c, rng.choice([None, t, t, t // 2]), *r, "x") for c in [None, *range(150)] for t, r in enumerate(some_rows(rng, rng.randint(1, 9)))]
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Lost.", "x"))
    schema = "conv_id bigint, turn bigint, role string, text string, audit string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op11_conversation_repair(spark, str(tmp_path)).collect()
    check(got, [r[:4] for r in rows])
    lost = next(r for r in got if r["conv_id"] == gone)
    assert lost["audit"] == "" and lost["cost"] == 0 and lost["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("bits", [0, 1, 2, 20])
def test_long_conversations_in_blocks(spark, bits):
    rng = random.Random(bits)
    rows = [(c, t if rng.random() < 0.9 else None, *r) for c in (None, 1, 2, 3, 4) for t, r in enumerate(some_rows(rng, 40))]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    whole, whole_turns = repair_conversations(frame)
    blocks, block_turns = repair_conversations(frame, long_rows=0, block_bits=bits)
    by_id = {r["conv_id"]: tuple(r) for r in whole.collect()}
    assert {r["conv_id"]: tuple(r[c] for c in whole.columns) for r in blocks.collect()} == by_id
    lines = lines_of(whole_turns)
    assert lines_of(block_turns) == lines
    for conv in by_id:
        said = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        want = expected(said)
        assert by_id[conv][1:] == want[:-1]
        assert hashlib.sha256(lines.get(conv, "").encode()).hexdigest() == want[-1]


def test_only_the_long_ones_go_in_blocks(spark):
    rng = random.Random(9)
    rows = [(c, t, *r) for c, n in ((1, 60), (2, 5), (3, 3)) for t, r in enumerate(some_rows(rng, n))]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    want = {tuple(r) for r in repair_conversations(frame)[0].collect()}
    mixed, turns = repair_conversations(frame, long_rows=10, block_bits=3)
    assert {tuple(r) for r in mixed.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit").collect()} == want
    assert set(turns.columns) == {"conv_id", "place", "edit", "role", "text"}


def test_no_exit_and_no_rows():
    assert cheapest([]) == (0, "", 0)
    assert cheapest([1], 0, {1: 0}, False) is None
    assert cheapest(bytes(3 * [3, 6] * 5000))[:2] == (0, "K" * 30000)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id string, turn int, role string, text string, cost int")
    report, turns = repair_conversations(frame)
    assert report.collect() == [] and turns.collect() == []
