"""Conversation repair: the cheapest edits, found by two Dijkstra searches that meet in the edit lattice.

A node of the lattice is (rows read, state): nothing said yet, system said, user said, assistant said.
Reading a row keeps it, gives it the role the state asks for, or deletes it; between rows
the next role may be inserted.  One heap grows from the start, the other from the ends; both
go on until no cheaper and no equally cheap path can be left, so every crossing of least cost
is known.  Among those the edits are read off with the least letter first: from a node, letters lead to
different nodes, and no edits of a node can be the beginning of others at the same cost, so
this gives the least of all concatenated audits.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import type_of
from claimlens.sources.storage import stage

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5

# Conversations up to so many rows and bytes of text are repaired whole by one task; longer ones are
# cut into blocks of at most 2^BLOCK_BITS rows.
LONG_ROWS = 16_384
LONG_BYTES = 32_000_000
BLOCK_BITS = 14

START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = {START: 0, ASSISTANT: 0}
SPACE = " \t\n\r\x0b\x0c"
FINE, GONE, TRUNCATED = range(3)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}

# The state reached by an insertion or a new role.
_NEXT = [USER, USER, ASSISTANT, USER]
# The states in which a row may keep its role, by initial: s, u, a, any other.
_KEEPS = [{START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {}]


def _edits(initial: int, fault: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) for reading a row in a state, letters in order."""
    edits = [("D", DELETE, state)]
    if fault != GONE:
        extra = CUT_OFF if fault == TRUNCATED else 0
        if state in _KEEPS[initial]:
            edits.append(("K", KEEP + extra, _KEEPS[initial][state]))
        edits.append(("R", REROLE + extra, _NEXT[state]))
    return edits


# A row's symbol is 3 * initial + fault.
_READ = [[_edits(s // 3, s % 3, q) for q in range(4)] for s in range(12)]
_UNREAD = [
    [[(p, cost) for p in range(4) for _, cost, to in _READ[s][p] if to == q] for q in range(4)] for s in range(12)
]
_UNINSERT = [[p for p in range(4) if _NEXT[p] == q] for q in range(4)]
_FAR = 1 << 60


def cheapest(
    symbols: list[int] | bytes, entry: int = START, exits: dict[int, int] = ENDS, ends: bool = True
) -> tuple[int, str, int] | None:
    """Cost, least audit and exit state of the cheapest edits from ``entry`` to one of ``exits``.

    ``exits`` gives what each state still costs after the last row.  ``ends`` says that the conversation ends
    there, so that rows may be inserted after the last row too; without it that is left to
    the next block.  None if no exit can be reached.
    """
    n = len(symbols)
    size = 4 * (n + 1)
    ahead, behind = [_FAR] * size, [_FAR] * size
    ahead_done, behind_done = bytearray(size), bytearray(size)
    ahead[entry] = 0
    heap, back = [entry], []
    for state, cost in exits.items():
        behind[4 * n + state] = cost
        heappush(back, cost * size + 4 * n + state)
    best = ahead[4 * n + entry] + behind[4 * n + entry] if n == 0 else _FAR

    def onward(node: int) -> list[tuple[str, int, int]]:
        i, state = node >> 2, node & 3
        found = []
        if i < n:
            found = [(letter, cost, 4 * i + 4 + to) for letter, cost, to in _READ[symbols[i]][state]]
        if i < n or ends:
            found.insert(1 if i < n else 0, ("I", INSERT, 4 * i + _NEXT[state]))
        return found

    def before(node: int) -> list[tuple[int, int]]:
        i, state = node >> 2, node & 3
        found = [(4 * i - 4 + p, cost) for p, cost in _UNREAD[symbols[i - 1]][state]] if i else []
        if i < n or ends:
            found += [(4 * i + p, INSERT) for p in _UNINSERT[state]]
        return found

    # An equal sum is still searched, so that all crossings of least cost are finished.
    while (heap[0] // size if heap else _FAR) + (back[0] // size if back else _FAR) <= min(best, _FAR - 1):
        if not back or (heap and heap[0] // size <= back[0] // size):
            cost, node = divmod(heappop(heap), size)
            if ahead_done[node]:
                continue
            ahead_done[node] = 1
            for _, step, to in onward(node):
                if cost + step < ahead[to]:
                    ahead[to] = cost + step
                    heappush(heap, (cost + step) * size + to)
                    best = min(best, cost + step + behind[to])
        else:
            cost, node = divmod(heappop(back), size)
            if behind_done[node]:
                continue
            behind_done[node] = 1
            for to, step in before(node):
                if cost + step < behind[to]:
                    behind[to] = cost + step
                    heappush(back, (cost + step) * size + to)
                    best = min(best, cost + step + ahead[to])
    if best >= _FAR:
        return None

    # What the forward search has settled and what leads from there to a crossing or an exit.
    leads = bytearray(size)
    waiting = [
        node
        for node in range(size)
        if ahead_done[node]
        and (
            (node >> 2 == n and ahead[node] + exits.get(node & 3, _FAR) == best)
            or any(behind_done[to] and ahead[node] + step + behind[to] == best for _, step, to in onward(node))
        )
    ]
    for node in waiting:
        leads[node] = 1
    while waiting:
        node = waiting.pop()
        for of, step in before(node):
            if ahead_done[of] and not leads[of] and ahead[of] + step == ahead[node]:
                leads[of] = 1
                waiting.append(of)
    node, spent, audit = entry, 0, []
    while not (node >> 2 == n and spent + exits.get(node & 3, _FAR) == best):
        for letter, step, to in onward(node):
            crossed = behind_done[to] and spent + step + behind[to] == best
            if crossed or (leads[to] and spent + step == ahead[to]):
                audit.append(letter)
                spent += step
                node = to
                break
        else:
            raise AssertionError("a cheapest path has no next edit")
    return best, "".join(audit), node & 3


def initial_of(role: str) -> int:
    return "sua".find(role[0]) % 4 if role else 3


def faults(roles: list[str], texts: list[str]) -> list[int]:
    """Symbol of each row; blank rows and duplicates are both ``GONE``."""
    seen = set()
    symbols = []
    for role, text in zip(roles, texts, strict=True):
        said = text.rstrip(SPACE)
        key = role, text
        if not said or key in seen:
            fault = GONE
        else:
            fault = FINE if said[-1] in ".!?" else TRUNCATED
        seen.add(key)
        symbols.append(3 * initial_of(role) + fault)
    return symbols


def illegal_pairs(symbols: list[int] | bytes) -> int:
    """Neighbours whose initials are not s-u, u-a or a-u."""
    initials = [s // 3 for s in symbols]
    return sum(pair not in ((0, 1), (1, 2), (2, 1)) for pair in zip(initials, initials[1:], strict=False))


def edited(audit: str, entry: int, symbols: list[int] | bytes) -> Iterator[tuple[str, int | None, str | None]]:
    """(edit, row or None, new role or None) of all but deleted rows."""
    state, row = entry, 0
    for letter in audit:
        if letter == "I":
            state = _NEXT[state]
            yield letter, None, ROLE_OF[state]
            continue
        if letter == "K":
            state = _KEEPS[symbols[row] // 3][state]
            yield letter, row, None
        elif letter == "R":
            state = _NEXT[state]
            yield letter, row, ROLE_OF[state]
        row += 1


_REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_TURN = pa.struct([("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _mend(turns: list, roles: list[str], texts: list[str]) -> tuple[dict, list[dict]]:
    symbols = faults(roles, texts)
    cost, audit, _ = cheapest(symbols)
    known = {t for t in turns if t is not None}
    blank = sum(not t.rstrip(SPACE) for t in texts)
    report = {
        "gaps": max(known) - min(known) + 1 - len(known) if known else 0,
        "blank": blank,
        "duplicate": sum(s % 3 == GONE for s in symbols) - blank,
        "truncated": sum(s % 3 == TRUNCATED for s in symbols),
        "illegal": illegal_pairs(symbols),
        "cost": cost,
        "audit": audit,
    }
    said = [
        {
            "place": place,
            "edit": edit,
            "role": role if role is not None else roles[row],
            "text": "" if row is None else texts[row],
        }
        for place, (edit, row, role) in enumerate(edited(audit, START, symbols))
    ]
    return report, said


def _order(id_column: str) -> list[Column]:
    return [F.col(id_column), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _repair_whole(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report and turns of conversations that fit into a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", *[c.split()[0] for c in _REPORT.split(", ")], "said"]

        def packed(done: list[tuple]) -> pa.RecordBatch:
            reports = [r for _, r, _ in done]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _, _ in done], id_type),
                    *(pa.array([r[c] for r in reports], pa.string() if c == "audit" else pa.int64()) for c in names[1:-1]),
                    pa.array([s for _, _, s in done], pa.list_(_TURN)),
                ],
                names=names,
            )

        held: tuple[list, list, list] = ([], [], [])
        of, done, bytes_done, id_type = None, [], 0, None
        for batch in batches:
            id_type = batch.column(0).type
            for i, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if i != of and held[0]:
                    done.append((of, *_mend(*held)))
                    bytes_done += sum(map(len, held[2]))
                    held = ([], [], [])
                    if len(done) >= 500 or bytes_done > 8_000_000:
                        yield packed(done)
                        done, bytes_done = [], 0
                of = i
                for column, value in zip(held, (turn, role, text), strict=True):
                    column.append(value)
        if held[0]:
            done.append((of, *_mend(*held)))
        if done:
            yield packed(done)

    sorted_rows = rows.repartition("id").sortWithinPartitions(*_order("id"))
    said = "array<struct<place: bigint, edit: string, role: string, text: string>>"
    mended = stage(sorted_rows.mapInArrow(run, f"id {type_of(rows, 'id')}, {_REPORT}, said {said}"), "repaired")
    return mended.drop("said"), mended.select("id", F.explode("said").alias("t")).select("id", "t.*")


def _repair_in_blocks(rows: DataFrame, block_bits: int) -> tuple[DataFrame, DataFrame]:
    """The same for long conversations, whose rows are sorted and searched in blocks.

    Each block gives the least cost from each state to each; these are added up from the
    end, a few numbers a block, so every block knows what its exits still cost.  Then each block's
    edits are searched again for each entry, and the entries are followed from the start.
    An audit is one string of less than 2^31 letters, so a conversation has a bounded number of blocks.
    """
    kind = type_of(rows, "id")
    sorted_rows = rows.repartitionByRange(*_order("id")).sortWithinPartitions(*_order("id"))
    turns = stage(sorted_rows.withColumn("pos", F.monotonically_increasing_id()), "long-turns")
    said = F.rtrim(F.translate("text", "\t\n\r\x0b\x0c", "     "))
    first = turns.groupBy("id", "role", F.sha2("text", 256).alias("said")).agg(F.min("pos").alias("pos"))
    initial = F.expr("CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END")
    marked = (
        turns.select("id", "pos", initial.alias("initial"), F.right(said, F.lit(1)).alias("end"))
        .join(first.select("pos", F.lit(True).alias("new")), "pos", "left")
        .withColumn("blank", (F.col("end") == "").cast("bigint"))
        .withColumn("duplicate", F.expr("CAST(blank = 0 AND new IS NULL AS bigint)"))
        .withColumn("truncated", F.expr("CAST(blank = 0 AND duplicate = 0 AND end NOT IN ('.', '!', '?') AS bigint)"))
        .withColumn("symbol", F.expr("3 * initial + CASE WHEN blank + duplicate > 0 THEN 1 WHEN truncated > 0 THEN 2 ELSE 0 END"))
    )
    counts = {c: F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")}
    blocks = (
        marked.groupBy("id", F.shiftright("pos", block_bits).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "symbol"))).alias("s"), *counts.values())
        .select("id", "block", F.expr("s[0].pos").alias("pos"), F.expr("transform(s, x -> x.symbol)").alias("symbols"), *counts)
    )
    last = F.col("block") == F.max("block").over(Window.partitionBy("id"))
    blocks = stage(blocks.withColumn("last", last), "blocks")

    def tolls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                symbols = bytes(one.column(2).to_pylist()[0])
                ends = one.column(3).to_pylist()[0]
                costs = [
                    found[0] if (found := cheapest(symbols, p, {q: 0}, ends)) else None
                    for p in range(4)
                    for q in range(4)
                ]
                added = [
                    pa.array([costs], pa.list_(pa.int64())),
                    pa.array([illegal_pairs(symbols)], pa.int64()),
                    pa.array([symbols[0] // 3], pa.int64()),
                    pa.array([symbols[-1] // 3], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    [one.column(0), one.column(1), one.column(3), *added],
                    names=["id", "block", "last", "costs", "illegal", "first_initial", "last_initial"],
                )

    def from_the_end(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        left, exits = [0, None, None, 0], []
        for costs in reversed(group["costs"].tolist()):
            exits.append(left)
            paths = [[c + e for c, e in zip(costs[4 * p : 4 * p + 4], left, strict=True) if c == c and c is not None and e is not None] for p in range(4)]
            left = [min(p, default=None) for p in paths]
        border = sum(
            pair not in ((0, 1), (1, 2), (2, 1))
            for pair in zip(group["last_initial"].tolist(), group["first_initial"].tolist()[1:], strict=False)
        )
        illegal = group["illegal"].tolist()
        illegal[0] += border
        return group[["id", "block"]].assign(exits=exits[::-1], cost=left[START], illegal=illegal)

    costs = blocks.select("id", "block", "symbols", "last").mapInArrow(
        tolls,
        f"id {kind}, block bigint, last boolean, costs array<bigint>, illegal bigint, first_initial bigint, last_initial bigint",
    )
    exits = costs.groupBy("id").applyInPandas(
        from_the_end, f"id {kind}, block bigint, exits array<bigint>, cost bigint, illegal bigint"
    )

    def same(a: DataFrame, b: DataFrame) -> DataFrame:
        on = a["id"].eqNullSafe(b["id"]) & (a["block"] == b["block"])
        return a.join(b, on).drop(b["id"]).drop(b["block"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                symbols, ends, left = (one.column(c).to_pylist()[0] for c in ("symbols", "last", "exits"))
                after = {q: c for q, c in enumerate(left) if c is not None}
                found = [cheapest(bytes(symbols), p, after, ends) for p in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [
                        one.column("id"),
                        one.column("block"),
                        pa.array([[f and f[1] for f in found]], pa.list_(pa.string())),
                        pa.array([[f and f[2] for f in found]], pa.list_(pa.int64())),
                    ],
                    names=["id", "block", "audits", "leads_to"],
                )

    known = stage(same(blocks, exits), "block-exits")
    audits = stage(
        known.select("id", "block", "symbols", "last", "exits").mapInArrow(
            search, f"id {kind}, block bigint, audits array<string>, leads_to array<bigint>"
        ),
        "block-audits",
    )

    def from_the_start(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        entries, places, state, place = [], [], START, 0
        for to, letters in zip(group["leads_to"].tolist(), group["letters"].tolist(), strict=True):
            entries.append(state)
            places.append(place)
            place += letters[state]
            state = int(to[state])
        return group[["id", "block"]].assign(entry=entries, place=places)

    letters = audits.select("id", "block", "leads_to", F.expr("transform(audits, a -> bigint(coalesce(length(a), 0)))").alias("letters"))
    entries = letters.groupBy("id").applyInPandas(from_the_start, f"id {kind}, block bigint, entry int, place bigint")
    chosen = same(audits.select("id", "block", "audits"), entries)
    chosen = chosen.select("id", "block", "entry", "place", F.expr("audits[entry]").alias("audit"))
    done = stage(same(known.drop("exits"), chosen), "block-edits")
    known_turns = turns.filter("turn IS NOT NULL").groupBy("id", "turn").agg(F.lit(1).alias("one"))
    gaps = known_turns.groupBy("id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    report = done.groupBy("id").agg(
        *counts.values(),
        F.sum("illegal").alias("illegal"),
        F.max("cost").alias("cost"),
        F.expr("array_join(transform(array_sort(collect_list(struct(block, audit))), x -> x.audit), '')").alias("audit"),
    )
    report = report.join(gaps, report["id"].eqNullSafe(gaps["id"]), "left").select(
        report["id"], F.coalesce("gaps", F.lit(0)).cast("bigint").alias("gaps"), *counts, "illegal", "cost", "audit"
    )

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                pos, symbols, entry, place, audit = (
                    one.column(c).to_pylist()[0] for c in ("pos", "symbols", "entry", "place", "audit")
                )
                edits = list(edited(audit, entry, symbols))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([one.column("id")] * len(edits)) if edits else one.column("id").slice(0, 0),
                        pa.array([None if row is None else pos + row for _, row, _ in edits], pa.int64()),
                        pa.array(range(place, place + len(edits)), pa.int64()),
                        pa.array([e for e, _, _ in edits], pa.string()),
                        pa.array([r for _, _, r in edits], pa.string()),
                    ],
                    names=["id", "pos", "place", "edit", "new_role"],
                )

    edits = done.select("id", "pos", "symbols", "entry", "place", "audit").mapInArrow(
        expand, f"id {kind}, pos bigint, place bigint, edit string, new_role string"
    )
    kept = edits.join(turns.select("pos", "role", "text"), "pos", "left").select(
        "id", "place", "edit", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return report, kept


def repair_conversations(
    rows: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    long_rows: int = LONG_ROWS,
    long_bytes: int = LONG_BYTES,
    block_bits: int = BLOCK_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Two tables: a report per conversation, and the repaired turns.

    A conversation's rows are taken by turn, nulls first, then by role and text.  A row is blank if it has
    nothing but white space, else a duplicate if its role and text came before, else
    truncated if it does not end in ``. ! ?``.  Keeping a row costs 0, a new role 1, deleting 2
    (blank rows and duplicates must go), inserting an empty turn 5, a truncated row that stays 5.
    What remains has an optional system turn, then user and assistant in turn.

    The report has ``<id>, gaps`` (turn numbers missing between least and greatest), ``blank, duplicate,
    truncated, illegal`` (neighbouring roles out of order), ``cost`` and ``audit`` (a letter per edit:
    K, R, D, I; of equal costs the least).  The turns have ``<id>, place`` (their order), ``edit, role, text``.

    A null role or text counts as one space, a null id is a conversation of its own.  Rows that repeat
    are duplicates; other columns are not read.  Empty tables give empty tables.  Conversations beyond
    ``long_rows`` or ``long_bytes`` are searched in blocks, with the same results.
    """
    narrow = rows.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{turn_column}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role_column}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(" ")).alias("text"),
    )
    sizes = narrow.groupBy("id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = stage(sizes.filter((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select("id"), "long-conversations")
    if long.isEmpty():
        report, turns = _repair_whole(narrow)
    else:
        in_long = narrow["id"].eqNullSafe(long["id"])
        report, turns = _repair_whole(narrow.join(long, in_long, "left_anti"))
        more_report, more_turns = _repair_in_blocks(narrow.join(long, in_long, "left_semi"), block_bits)
        report, turns = report.unionByName(more_report), turns.unionByName(more_turns)
    return report.withColumnRenamed("id", id_column), turns.withColumnRenamed("id", id_column)
