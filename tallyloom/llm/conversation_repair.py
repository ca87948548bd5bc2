"""Repair of the turn structure of conversations by cheapest edits.

A conversation may open with a system message, then users and assistants alternate in pairs:
``(s?(ua)+)?`` in initials of roles. Four states say how far a prefix has come: nothing yet, after
the system message, after a user, after an assistant. Each message is kept, given the role that
the state asks for, or deleted; messages with an empty text may be put in anywhere.

The cheapest edits are found by Hirschberg's scheme. A stretch of messages is cut in the middle;
a forward vector has the least cost of reaching each of the four states there, a backward vector
the least cost of going on from each. Among the states whose sum is least, the one with the
ASCII-least edits before the cut is the crossing, and both halves follow on their own, so only
vectors are kept, never a table of all messages and states. States are taken right after a message,
before anything is put in, so edit strings that reach the cut are never prefixes of each other and
their order decides the order of the whole.

On Spark, messages are sorted by ranges, which cut a conversation of any size, and packed into
blocks of one byte a message. A block of a longer conversation also carries its 4 x 4 least costs
(and the order of the edit strings behind them); one pass over a conversation's blocks makes the
same choice of crossings at block borders, and every block is then solved in a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import partitions
from tallyloom.session import ship_by_value, stored

ship_by_value(__name__)

#: Messages of a block; a stretch below ``LEAF`` is solved by a small table of vectors.
BLOCK, LEAF = 16_384, 16

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state that an inserted or renamed message leads to.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEEP, RENAME, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: What is left to put in at the end of a conversation.
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
FAR = 1 << 50

#: A message's code: initial (0 other, 1 s, 2 u, 3 a) and fault (0 none, 4 truncated, 8 blank, 12 duplicate).
INITIALS = {"s": 1, "u": 2, "a": 3}
TRUNC, BLANK, DUPLICATE = 4, 8, 12
#: How many inserted messages lead from one state to another; more than two never pay.
INSERTS = {(START, USER): 1, (START, ASSISTANT): 2, (SYSTEM, USER): 1, (SYSTEM, ASSISTANT): 2, (USER, ASSISTANT): 1,
           (ASSISTANT, USER): 1} | {(x, x): 0 for x in range(4)}


def _moves(code: int) -> list[list[tuple[int, int, str]]]:
    """Per state before a message: (state after it, cost, edits), the best for each state after."""
    initial, fault = code & 3, code & 12
    extra = TRUNCATED if fault == TRUNC else 0
    out = []
    for x in range(4):
        best: dict[int, tuple[int, str]] = {}
        for (a, y), n in INSERTS.items():
            if a != x:
                continue
            ways = [(y, DELETE, "D")]
            if fault < BLANK:
                ways.append((NEXT[y], RENAME + extra, "R"))
                if initial == SYSTEM and y == START:
                    ways.append((SYSTEM, KEEP + extra, "K"))
                elif initial and initial == NEXT[y]:
                    ways.append((NEXT[y], KEEP + extra, "K"))
            for z, cost, edit in ways:
                way = (cost + n * INSERT, "I" * n + edit)
                best[z] = min(best.get(z, way), way)
        out.append([(z, cost, edits) for z, (cost, edits) in sorted(best.items())])
    return out


MOVES = [_moves(code) for code in range(16)]
#: The same by state after the message: (state before, cost, edits).
INTO = [[[(x, c, e) for x in range(4) for z, c, e in ways[x] if z == y] for y in range(4)] for ways in MOVES]
CLOSE = [INSERT * len(CLOSING[x]) for x in range(4)]


def forward(codes, cost: list[int], rank: list[int]) -> tuple[list[int], list[int]]:
    """Least cost of each state after the messages, and the order of the ASCII-least edits to it."""
    for code in codes:
        into = INTO[code]
        found = [
            min(((cost[x] + c, rank[x], e) for x, c, e in ways if cost[x] < FAR), default=(FAR, 9, "")) for ways in into
        ]
        cost = [f[0] for f in found]
        order = sorted({f[1:] for f in found})
        rank = [order.index(f[1:]) for f in found]
    return cost, rank


def backward(codes, cost: list[int]) -> list[int]:
    """Least cost of going on from each state before the messages to the given end."""
    for code in reversed(codes):
        cost = [min(c + cost[y] for y, c, _ in ways) for ways in MOVES[code]]
    return cost


def _only(x: int) -> list[int]:
    return [0 if y == x else FAR for y in range(4)]


def crossing(codes, middle: int, x: int, end: list[int]) -> int:
    """The state at ``middle`` on the ASCII-least of the cheapest ways from ``x`` to the end."""
    cost, rank = forward(codes[:middle], _only(x), [0] * 4)
    rest = backward(codes[middle:], end)
    return min(range(4), key=lambda y: (cost[y] + rest[y], rank[y]))


def _leaf(codes, x: int, end: list[int]) -> tuple[str, int]:
    """Edits of a few messages and the state after them, along vectors of all places."""
    rest = [end]
    for code in reversed(codes):
        rest.append(backward([code], rest[-1]))
    rest.reverse()
    out = []
    for i, code in enumerate(codes):
        _, edits, x = min((c + rest[i + 1][y], e, y) for y, c, e in MOVES[code][x])
        out.append(edits)
    return "".join(out), x


def edits(codes: bytes, x: int = START, y: int | None = None) -> str:
    """The ASCII-least of the cheapest edits from state ``x`` to ``y``, or to a proper end."""
    end = CLOSE if y is None else _only(y)
    out, todo = [], [(0, len(codes), x, end)]
    while todo:
        a, b, x, end = todo.pop()
        if b - a <= LEAF:
            part, x = _leaf(codes[a:b], x, end)
            out.append(part)
        else:
            middle = crossing(codes[a:b], (b - a) // 2, x, end)
            m = a + (b - a) // 2
            todo += [(m, b, middle, end), (a, m, x, _only(middle))]
    return "".join(out) + (CLOSING[x] if y is None else "")


def summary(codes: bytes) -> tuple[list[int], list[int]]:
    """Least costs from each state before a block to each after it, and the order of the edits."""
    found = [forward(codes, _only(x), [0] * 4) for x in range(4)]
    return [c for cost, _ in found for c in cost], [r for _, rank in found for r in rank]


def price(codes: bytes, audit: str) -> int:
    """What edits cost, closing ones included."""
    marks = audit.replace("I", "")
    own = sum({"K": KEEP, "R": RENAME, "D": DELETE}[m] for m in marks)
    cut = sum(TRUNCATED for code, m in zip(codes, marks) if code & 12 == TRUNC and m != "D")
    return own + cut + INSERT * (len(audit) - len(marks))


def apply_edits(audit: str, messages: Iterator[tuple]) -> Iterator[tuple]:
    """The (role, text) pairs that edits make of messages."""
    state = START
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield ROLES[state], ""
            continue
        role, text = next(messages)
        if edit == "D":
            continue
        if edit == "R" or not (state == START and role[:1] == "s"):
            state = NEXT[state]
            yield (ROLES[state] if edit == "R" else role), text
        else:
            state = SYSTEM
            yield role, text


#: White space of the blank test, and what ends a sentence (fixed values).
_SPACES = r" \t\n\u000B\f\r"
BLOCKS = (
    "conv_id {conv}, pos long, n int, codes binary, alone boolean, blank long, duplicate long, truncated long, "
    "illegal long, first int, last int, min_turn long, max_turn long, first_turn long, last_turn long, turns long, "
    "costs array<long>, ranks array<long>"
)


def _plain(messages: DataFrame) -> DataFrame:
    """The columns read here, whatever else is there; null roles and texts are one blank."""
    return messages.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


def _order() -> list[Column]:
    """Order inside a conversation. Rows of one turn go by role, start of the text and digest."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 48), F.unhex(F.md5("text"))]


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the place of each row: range, then row of the range."""
    part = TaskContext.get().partitionId()
    at = part << 40
    for batch in batches:
        pos = pa.array(np.arange(at, at + batch.num_rows, dtype=np.int64))
        at += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pos], [*batch.schema.names, "pos"])


def _located(messages: DataFrame) -> DataFrame:
    """One small row for each message with its place in the order of all, stored."""
    n = partitions(messages.sparkSession)
    last = F.regexp_extract("text", rf"([^{_SPACES}])[{_SPACES}]*\z", 1)
    keys = [k.alias(f"k{i}") for i, k in enumerate([F.col("turn"), F.col("role"), *_order()[2:]])]
    narrow = messages.select(
        "conv_id",
        *keys,
        (last == "").alias("blank"),
        last.isin("", ".", "!", "?").alias("whole"),
        F.substring("role", 1, 1).alias("initial"),
        F.monotonically_increasing_id().alias("row"),
    )
    by = ["conv_id", "k0", "k1", "k2", "k3", "row"]
    ranged = narrow.repartitionByRange(n, *by).sortWithinPartitions(*by)
    ranged = ranged.select("conv_id", "k0", "k1", "k3", "blank", "whole", "initial")
    conv = messages.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv}, turn long, role string, digest binary, blank boolean, whole boolean, initial string"
    ranged = ranged.toDF("conv_id", "turn", "role", "digest", "blank", "whole", "initial")
    return stored(ranged.mapInArrow(_number, f"{schema}, pos long"), "messages")


class _Block:
    """Collects messages of one conversation."""

    def __init__(self, conv, pos: int, opens: bool):
        self.conv, self.pos, self.opens = conv, pos, opens
        self.codes, self.turns = bytearray(), []

    def row(self, alone: bool) -> tuple:
        codes = bytes(self.codes)
        a = np.frombuffer(codes, np.uint8)
        fault, initial = a & 12, (a & 3).astype(int)
        turns = [t for t in self.turns if t is not None]
        costs, ranks = (None, None) if alone else summary(codes)
        return (
            self.conv, self.pos, len(codes), codes, alone,
            int((fault == BLANK).sum()), int((fault == DUPLICATE).sum()), int((fault == TRUNC).sum()),
            illegal_pairs(initial), int(initial[0]), int(initial[-1]),
            turns[0] if turns else None, turns[-1] if turns else None, turns[0] if turns else None,
            turns[-1] if turns else None, len({*turns}), costs, ranks,
        )


def illegal_pairs(initials: np.ndarray) -> int:
    """Neighbours whose initials are none of su, ua, au."""
    pairs = initials[:-1] * 4 + initials[1:]
    return int((~np.isin(pairs, [1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2])).sum())


def _pack(schema: pa.Schema, size: int):
    """Blocks of the rows of each range; a marker before a row says that it is the first of its kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, block, part, fresh = [], None, None, None

        def close(alone: bool) -> None:
            ready.append(block.row(alone))

        for batch in batches:
            columns = batch.to_pydict()
            for p, pos, marker, conv, turn, blank, whole, initial in zip(
                *(columns[c] for c in ("part", "pos", "marker", "conv_id", "turn", "blank", "whole", "initial"))
            ):
                if marker == 0:
                    fresh = pos
                    continue
                new_part = p != part
                new_conv = new_part or block is None or conv != block.conv
                if new_conv or len(block.codes) >= size:
                    if block is not None:
                        close(block.opens and new_conv and not new_part)
                    # a conversation that may go on from another range or block is never alone
                    block = _Block(conv, pos, opens=new_conv and not new_part)
                part = p
                fault = BLANK if blank else DUPLICATE if fresh != pos else 0 if whole else TRUNC
                block.codes.append(INITIALS.get(initial, 0) | fault)
                block.turns.append(turn)
            if len(ready) > 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in ready], schema)
                ready.clear()
        if block is not None:
            close(False)
        if ready:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in ready], schema)

    return run


def _blocks(located: DataFrame, size: int) -> DataFrame:
    """Rows of the conversations packed into blocks, faults included, stored."""
    spark = located.sparkSession
    n = partitions(spark)
    part = F.shiftright("pos", 40).alias("part")
    firsts = located.filter(~F.col("blank")).groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos"))
    rows = located.select(part, "pos", F.lit(1).alias("marker"), "conv_id", "turn", "blank", "whole", "initial")
    markers = firsts.select(part, "pos", F.lit(0).alias("marker"))
    merged = rows.unionByName(markers, allowMissingColumns=True).repartition(n, "part")
    conv = located.schema["conv_id"].dataType.simpleString()
    ddl = BLOCKS.format(conv=conv)
    return stored(
        merged.sortWithinPartitions("part", "pos", "marker").mapInArrow(_pack(_arrow(spark, ddl), size), ddl),
        "conversation-blocks",
    )


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _cross(table: pa.Table) -> pa.Table:
    """Crossings at the block borders of one conversation, and the pairs and turns across them."""
    rows = sorted(table.to_pylist(), key=lambda r: r["pos"])
    rest = [CLOSE]
    for r in reversed(rows):
        rest.append([min(r["costs"][4 * x + y] + rest[-1][y] for y in range(4)) for x in range(4)])
    rest.reverse()
    x, out, before, seen = START, [], None, None
    for i, r in enumerate(rows):
        y = min(range(4), key=lambda y: (r["costs"][4 * x + y] + rest[i + 1][y], r["ranks"][4 * x + y]))
        across = 0 if before is None else illegal_pairs(np.array([before, r["first"]]))
        again = int(seen is not None and seen == r["first_turn"])
        out.append((r["pos"], x, None if i + 1 == len(rows) else y, across, again))
        before = r["last"]
        seen = r["last_turn"] if r["last_turn"] is not None else seen
        x = y
    names = ["pos", "enter", "leave", "across", "again"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column("codes").to_pylist()
        ways = zip(codes, batch.column("enter").to_pylist(), batch.column("leave").to_pylist())
        audits = [edits(c, x, y) for c, x, y in ways]
        costs = [price(c, a) for c, a in zip(codes, audits)]
        kept = [c for c in batch.schema.names if c not in ("codes", "enter", "leave")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(audits, pa.string()), pa.array(costs, pa.int64())],
            [*kept, "audit", "cost"],
        )


def repair_plan(messages: DataFrame, size: int = BLOCK) -> DataFrame:
    """Cheapest edits of conversations: one row for each block of at most ``size`` messages.

    Columns: ``conv_id``, ``pos`` (order of the blocks), ``audit`` (initials of Keep, Rerole,
    Delete and Insert in order), ``cost`` and the counts that ``report`` adds up.

    ``messages`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored. Rows
    are taken by turn, nulls first; rows of one turn by role, then text. A null role or text is
    one blank; rows of a null conversation form one conversation. A row equal in role and text to
    an earlier one of its conversation is a duplicate. An empty table gives no rows.
    """
    blocks = _blocks(_located(_plain(messages)), size)
    parts = blocks.filter(~F.col("alone")).drop("codes")
    crossed = parts.groupBy("conv_id").applyInArrow(_cross, "pos long, enter int, leave int, across long, again long")
    counts = ("blank", "duplicate", "truncated", "illegal", "min_turn", "max_turn", "turns")
    apart = blocks.filter("alone").select(
        "conv_id", "pos", "codes", *counts,
        F.lit(START).alias("enter"), F.lit(None).cast("int").alias("leave"),
        F.lit(0).cast("long").alias("across"), F.lit(0).cast("long").alias("again"),
    )
    joined = blocks.filter(~F.col("alone")).join(crossed, "pos").select(apart.columns)
    whole = apart.unionByName(joined)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema if f.name not in ("codes", "enter", "leave")]
    return stored(whole.mapInArrow(_solve, f"{', '.join(kept)}, audit string, cost long"), "repair-plan")


def report(plan: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``conversations``: gaps, faults, cost and the whole audit.

    A conversation without messages has zeros and an empty audit.
    """
    turns = F.max("max_turn") - F.min("min_turn") + 1 - (F.sum("turns") - F.sum("again"))
    pieces = F.array_sort(F.collect_list(F.struct("pos", "audit")))
    found = plan.groupBy("conv_id").agg(
        F.coalesce(turns, F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.sum("across")).alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"),
    )
    ids = conversations.select("conv_id").distinct()
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in found.columns[1:-1]]
    right = found.withColumnRenamed("conv_id", "found_id")
    return ids.join(right, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit")
    )


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies each conversation's edits, which come before its messages."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            columns = batch.to_pydict()
            yield from zip(*(columns[c] for c in ("conv_id", "audit", "role", "text")))

    out, size = [], 0
    for conv, own in groupby(rows(), key=lambda r: r[0]):
        audit, first = [], None
        for r in own:
            if r[1] is None:
                first = r
                break
            audit.append(r[1])
        messages = (r[2:] for part in ([first] if first else [], own) for r in part)
        for i, (role, text) in enumerate(apply_edits("".join(audit), messages)):
            out.append((conv, i, role, text))
            size += len(text)
            if len(out) >= 4096 or size > 4 << 20:
                yield _messages(out)
                out, size = [], 0
    if out:
        yield _messages(out)


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    conv, place, role, text = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(conv), pa.array(place, pa.int64()), pa.array(role, pa.string()), pa.array(text, pa.string())],
        ["conv_id", "place", "role", "text"],
    )


def repaired_messages(messages: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` from 0, ``role`` and ``text``.

    Rows lie in order, a whole conversation in one partition. A conversation streams through its
    task message by message; only its edits, about a byte a message, are held.
    """
    plain = _plain(messages)
    order = [c.alias(f"k{i}") for i, c in enumerate(_order())]
    order[:2] = [F.col("turn").alias("k0"), F.col("role").alias("k1")]
    rows = plain.select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("pos"), *order, "role", "text")
    pieces = plan.select("conv_id", F.lit(0).alias("kind"), "pos", "audit")
    merged = pieces.unionByName(rows, allowMissingColumns=True).repartition(partitions(plan.sparkSession), "conv_id")
    by = ["conv_id", "kind", "pos", "k0", "k1", "k2", "k3"]
    conv = messages.schema["conv_id"].dataType.simpleString()
    return (
        merged.sortWithinPartitions(*by)
        .select("conv_id", "audit", "role", "text")
        .mapInArrow(_rebuild, f"conv_id {conv}, place long, role string, text string")
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    ids, digests, sha = [], [], None
    for batch in batches:
        columns = batch.to_pydict()
        for conv, place, role, text in zip(*(columns[c] for c in ("conv_id", "place", "role", "text"))):
            if place == 0:
                if sha is not None:
                    digests.append(sha.hexdigest())
                ids.append(conv)
                sha = hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
    if sha is not None:
        digests.append(sha.hexdigest())
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(digests, pa.string())], ["conv_id", "sha256"])


def message_digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text`` lines of each conversation of ``repaired_messages``, as it lies."""
    conv = repaired.schema["conv_id"].dataType.simpleString()
    return repaired.mapInArrow(_digest, f"conv_id {conv}, sha256 string")
