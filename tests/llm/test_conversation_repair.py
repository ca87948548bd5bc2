import hashlib
import random
import zlib

import pytest

from tallyloom.llm import conversation_repair as C
from tallyloom.llm.queries import QUERIES, damaged_messages


def plain_edits(kinds):
    """Cheapest and ASCII-least edits by all ways, strings and all, from the rules as stated."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}

    after = {}
    for i in range(len(kinds), -1, -1):
        here = {}
        for put in (3, 2, 1, 0):
            for state in ("", "s", "u", "a"):
                ways = [(0, "")] if i == len(kinds) and state in ("", "a") else []
                if put < 3:
                    c, e = here[step[state], put + 1]
                    ways.append((c + 3, "I" + e))
                if i < len(kinds):
                    initial, fault = kinds[i]
                    c, e = after[state, 0]
                    ways.append((c + 4, "D" + e))
                    if fault not in ("blank", "duplicate"):
                        extra = 3 if fault == "truncated" else 0
                        c, e = after[step[state], 0]
                        ways.append((c + 3 + extra, "R" + e))
                        if initial == step[state] or (initial == "s" and state == ""):
                            c, e = after[initial, 0]
                            ways.append((c + extra, "K" + e))
                here[state, put] = min(ways, default=(10**9, ""))
        after = here
    return after["", 0]


def plain_repair(rows):
    """All columns of the query for one conversation's (turn, role, text) rows in order."""
    seen, kinds, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        kinds.append((role[:1], fault))
    cost, audit = plain_edits(tuple(kinds))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(kinds, kinds[1:]))
    state, out, queue = "", [], list(rows)
    for e in audit:
        turn = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        name = {"u": "user", "a": "assistant"}[turn]
        if e == "I":
            out.append(f"{name}:")
            state = turn
            continue
        _, role, text = queue.pop(0)
        if e != "D":
            role = name if e == "R" else role
            out.append(f"{role}:{text}")
            state = role[0]
    sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *faults.values(), illegal, cost, audit, sha)


def some_conversations(n=120):
    rng = random.Random(3)
    rows = []
    for conv in [None, *range(n)]:
        turn = rng.choice([0, 0, 0, 5, -2])
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 40])):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why?", "open", "", " \n", None, "Ja.", "So so. \t"])
            rows.append((conv, turn, role, text, "x", 7))
            turn += rng.choice([1, 1, 1, 2])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, audit string, pos long"


def expected(rows, damage):
    found = {r[0]: [] for r in rows}
    for conv, turn, role, text, *_ in rows:
        show = lambda v: " " if v is None else str(v)
        role, text = show(role), show(text)
        fault = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20 if damage else 9
        if fault == 0:
            continue
        text = "" if fault == 1 else text.translate({ord(c): None for c in ".!?"}) if fault == 2 else text
        role = "user" if fault == 4 else role
        found[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    return {k: plain_repair(sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for k, v in found.items()}


def run(messages, original, size=C.BLOCK):
    plan = C.repair_plan(messages, size)
    shas = {r.conv_id: r.sha256 for r in C.message_digests(C.repaired_messages(messages, plan)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, shas.get(r.conv_id, empty))
        for r in C.report(plan, original).collect()
    }


@pytest.mark.parametrize("size", [C.BLOCK, 3])
def test_equals_brute_force(spark, size):
    rows = some_conversations()
    rows += [(500, None, "user", "b.", "", 0), (500, None, "assistant", "a.", "", 0), (500, None, "user", "b.", "", 0)]
    rows += [(501, 1, "user", "x" * 300_000 + ".", "", 0)] * 3
    messages = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert run(messages, messages, size) == expected(rows, False)


def test_one_conversation_over_many_ranges(spark):
    rng = random.Random(8)
    rows = [(1, i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"t{i}."]), "", 0) for i in range(700)]
    messages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = {}
    ordered = sorted(((t, r, x) for _, t, r, x, *_ in rows), key=lambda r: r)
    want[1] = plain_repair(ordered)
    assert run(messages, messages, 50) == want


def test_damage_and_query_columns(spark):
    rows = some_conversations(300)
    messages = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert run(damaged_messages(messages), messages) == expected(rows, True)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert run(none, none) == {}


def test_halving_equals_all_ways():
    rng = random.Random(1)
    faults = {"": 0, "truncated": C.TRUNC, "blank": C.BLANK, "duplicate": C.DUPLICATE}
    for n in [*range(9), 33, 60, 150]:
        for _ in range(40):
            kinds = tuple((rng.choice("suatx"), rng.choice(["", "", *faults])) for _ in range(n))
            codes = bytes(C.INITIALS.get(i, 0) | faults[f] for i, f in kinds)
            cost, audit = plain_edits(kinds)
            assert (C.price(codes, C.edits(codes)), C.edits(codes)) == (cost, audit)


def test_query_on_the_tables(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"](spark, folder).collect()}
    assert got == expected(rows, True)
