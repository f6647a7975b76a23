from __future__ import annotations

import hashlib
import random
import sys
import zlib
from functools import cache
from itertools import product

import pytest
from conftest import SF_DIR

from repopulse.llm import conversations, repair
from repopulse.llm.queries import op12_conversation_repair

ROWS = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"
PAIRS = ("su", "ua", "au")
sys.setrecursionlimit(20_000)  # the search below goes as deep as a conversation is long


def best(rows):
    """(cost, audit, lines) of (role, text, fault) rows: the least over all edits, by search."""

    @cache
    def after(i, state, inserts):
        """The cheapest and then ASCII-least edits from row i on, `inserts` rows put in just before."""
        wanted, then = ("assistant", "a") if state == "u" else ("user", "u")
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", (), after_end))
        if i < len(rows):
            role, text, fault = rows[i]
            ways.append((4, "D", (), lambda: after(i + 1, state, 0)))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] == then or role[:1] == "s" and state == "":
                    ways.append((more, "K", (f"{role}:{text}",), lambda: after(i + 1, role[:1], 0)))
                ways.append((more + 3, "R", (f"{wanted}:{text}",), lambda: after(i + 1, then, 0)))
        if inserts < 4:
            ways.append((3, "I", (f"{wanted}:",), lambda: after(i, then, inserts + 1)))
        found = []
        for cost, letter, lines, rest in ways:
            more, letters, others = rest()
            found.append((cost + more, letter + letters, (*lines, *others)))
        return min(found, key=lambda x: x[:2], default=(10**9, "", ()))

    def after_end():
        return 0, "", ()

    return after(0, "", 0)


def judged(rows):
    """Faults of (conv_id, turn, role, text) rows in order."""
    seen, found = set(), []
    for _, _, role, text in rows:
        said = text.strip(BLANK)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def plainly(rows):
    """What `mend` should find, per conversation."""
    groups = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        groups.setdefault(conv, []).append((conv, turn, role, text))
    found = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        faults = judged(own)
        cost, audit, lines = best(tuple(faults))
        turns = {r[1] for r in own if r[1] is not None}
        kinds = [f[2] for f in faults]
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            kinds.count("blank"),
            kinds.count("duplicate"),
            kinds.count("truncated"),
            sum(a[2][:1] + b[2][:1] not in PAIRS for a, b in zip(own, own[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest"]


def found_in(spark, rows):
    found = conversations.repaired_digests(spark, rows).collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in found}


def conversation(conv, length, rng):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    texts = ["Yes.", "No", " ", "", None, "Why?", "Go on!", "And so on"]
    return [(conv, turn, rng.choice(roles), rng.choice(texts)) for turn in range(length)]


def test_the_programme_equals_a_search(spark):
    """All short sequences of rows, and every cut of them into two pieces."""
    names = {"s": ("system", ""), "u": ("user", ""), "a": ("assistant", ""), "x": ("tool", ""),
             "t": ("user", "truncated"), "b": ("user", "blank")}
    codes = {"s": 1, "u": 2, "a": 3, "x": 0, "t": 2 + repair.TRUNCATED, "b": 2 + repair.UNWANTED}
    for length in range(5):
        for letters in product(names, repeat=length):
            rows = tuple((names[c][0], f"{i}.", names[c][1]) for i, c in enumerate(letters))
            wanted = best(rows)
            given = bytes(codes[c] for c in letters)
            cost, audit, kept, state = repair.cheapest(given, repair.FINAL, repair.START, True)
            assert (cost, audit) == wanted[:2] and state in (0, 3)
            for cut in range(length + 1):
                middle = repair.through(given[cut:], repair.FINAL)
                c1, a1, _, q = repair.cheapest(given[:cut], middle, repair.START, False)
                c2, a2, _, _ = repair.cheapest(given[cut:], repair.FINAL, q, True)
                assert (c1 + c2, a1 + a2) == (cost, audit)


def test_short_conversations_equal_a_search(spark):
    rng = random.Random(5)
    rows = [r for conv in range(200) for r in conversation(conv, rng.randrange(1, 9), rng)]
    docs = spark.createDataFrame(rows, ROWS).repartition(5)
    assert found_in(spark, docs) == plainly(rows)


@pytest.mark.parametrize("least", [1, 7, 64])
def test_pieces_of_a_long_conversation(spark, monkeypatch, least):
    """One conversation holds most rows and several ranges; pieces of any size give the same."""
    monkeypatch.setattr(conversations, "LEAST_PIECE", least)
    rng = random.Random(11)
    rows = [(0, i, r, f"{t or ''} {i if i % 3 else ''}") for _, i, r, t in conversation(0, 400, rng)]
    rows += [r for conv in range(1, 30) for r in conversation(conv, rng.randrange(1, 9), rng)]
    docs = spark.createDataFrame(rows, ROWS).repartition(6)
    assert found_in(spark, docs) == plainly(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None),
        (None, 1, "user", "Hm."),
        (1, None, "user", "First."),
        (1, 5, "assistant", "Then."),
        (1, 5, "assistant", "Then."),
        (1, 9, "user", None),
        (2, 1, "", "No role."),
        (3, 1, "user", "x" * 100_000),
        (3, 1, "user", "Equal turn."),
        (4, None, "system", " \t\x0b"),
    ]
    extra = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], f"{ROWS}, conv string, part int, place int")
    assert found_in(spark, extra) == plainly(rows)
    assert found_in(spark, spark.createDataFrame([], ROWS)) == {}


def test_one_row_repeated_very_often(spark):
    rows = [(0, 3, "user", "Same.")] * 2000 + [(0, 4, "assistant", "End.")]
    found = found_in(spark, spark.createDataFrame(rows, ROWS).repartition(4))
    assert found[0][1:6] == (0, 1999, 0, 1999, 4 * 1999)
    assert sorted(found[0][6]) == ["D"] * 1999 + ["K", "K"]


def test_turns_are_the_repaired_rows(spark):
    rows = [(7, 0, "user", "Hi."), (7, 1, "user", "There?"), (7, 2, "assistant", "")]
    turns = conversations.mend(spark, spark.createDataFrame(rows, ROWS)).turns.orderBy("place").collect()
    assert ":".join(r["role"][0] for r in turns) in ("u:a", "u:a:u:a")


def damage(rows):
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        role = "user" if fault == 4 else role
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)


def test_query_equals_a_search_over_the_table(spark, sf_dir):
    table = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    wanted = plainly(list(damage(table)))
    rows = {r["conv_id"]: tuple(r)[1:] for r in op12_conversation_repair(spark, sf_dir).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert rows == {r[0]: wanted.get(r[0], nothing) for r in table}


def test_a_conversation_that_loses_all_rows(spark, folder):
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(conv, 0, "user", "Gone.")], ROWS).write.parquet(f"{folder}/conversations.parquet")
    (row,) = op12_conversation_repair(spark, folder).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
