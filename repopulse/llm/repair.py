"""Cheapest edits of one conversation, row by row, by a checkpointed dynamic programme.

Roles of a repaired conversation read `(s?(ua)+)?` by their initials. A vector
holds, per state, the least cost of all rows that follow. Going backwards only the
vectors at every square-root-th row are kept; going forwards one block of vectors at
a time is made anew, and the edit with the least letter that keeps the cost is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import inf, isqrt

# What is known of a row: its kind, by the initial of its role, and two marks.
OTHER, SYSTEM, USER, ASSISTANT = range(4)
TRUNCATED, UNWANTED = 4, 8
# Costs of the edits and of a truncated row that stays.
REROLE, DELETE, INSERT, STAYS_TRUNCATED = 3, 4, 3, 3
# States: nothing yet, after system, after user, after assistant.
START, STATES = 0, range(4)
#: The kind that an inserted or changed row has in each state, and the state after it.
WANTED = (USER, USER, ASSISTANT, USER)
AFTER = (2, 2, 3, 2)
KEPT = {(0, SYSTEM): 1, (0, USER): 2, (1, USER): 2, (2, ASSISTANT): 3, (3, USER): 2}

Vector = tuple[float, float, float, float]


def _with_inserts(costs: list[float]) -> Vector:
    """Costs once rows may be inserted first; more than two would come back to a state."""
    return tuple(
        min(
            costs[q],
            INSERT + costs[AFTER[q]],
            2 * INSERT + costs[AFTER[AFTER[q]]],
        )
        for q in STATES
    )


#: Costs after the last row: only inserts are left.
FINAL: Vector = _with_inserts([0, inf, inf, 0])


def _row_edits(code: int) -> list[list[tuple[str, int, int]]]:
    """Per state the edits of such a row that use it up: letter, cost, next state; by letter."""
    found = []
    for q in STATES:
        edits = [("D", DELETE, q)]
        if not code & UNWANTED:
            stays = STAYS_TRUNCATED if code & TRUNCATED else 0
            if (q, code & 3) in KEPT:
                edits.append(("K", stays, KEPT[q, code & 3]))
            edits.append(("R", REROLE + stays, AFTER[q]))
        found.append(edits)
    return found


EDITS = [_row_edits(code) for code in range(16)]


def before(code: int, after: Vector) -> Vector:
    """The vector before a row, from the one after it."""
    edits = EDITS[code]
    return _with_inserts([min(cost + after[to] for _, cost, to in edits[q]) for q in STATES])


def through(codes: bytes, after: Vector) -> Vector:
    """The vector before all these rows, from the one after them."""
    for code in reversed(codes):
        after = before(code, after)
    return after


def transitions(codes: bytes) -> list[Vector]:
    """Per state after the rows, the least cost to get there from each state before them."""
    return [through(codes, tuple(0 if q == end else inf for q in STATES)) for end in STATES]


def _vectors(codes: bytes, after: Vector) -> Iterator[list[Vector]]:
    """The vectors before each row and after it, block by block, forwards."""
    step = isqrt(len(codes)) + 1
    starts = range(0, len(codes), step)
    checkpoints = [after]
    for start in reversed(starts):
        checkpoints.append(through(codes[start : start + step], checkpoints[-1]))
    for start in starts:
        checkpoints.pop()
        block = [checkpoints[-1]]
        for code in reversed(codes[start : start + step]):
            block.append(before(code, block[-1]))
        yield block[::-1]


def cheapest(codes: bytes, after: Vector, state: int, is_last: bool) -> tuple[int, str, list, int]:
    """(cost, letters, rows, state): the ASCII-least of the cheapest edits from a state on.

    Rows that stay or come in are (place or -1, new kind or None), in order. Inserts
    after the last row belong to the last piece of a conversation only.
    """
    cost, letters, rows, at = 0, [], [], 0

    def insert() -> None:
        nonlocal cost, state
        cost += INSERT
        letters.append("I")
        rows.append((-1, WANTED[state]))
        state = AFTER[state]

    for block in _vectors(codes, after):
        for here, then in zip(block, block[1:]):
            edits = EDITS[codes[at]]
            if DELETE + then[state] != here[state]:
                # Inserts come before keeping and changing roles, but after deleting.
                while INSERT + here[AFTER[state]] == here[state]:
                    insert()
                    if DELETE + then[state] == here[state]:
                        break
            letter, price, to = next(
                edit for edit in edits[state] if edit[1] + then[edit[2]] == here[state]
            )
            if letter != "D":
                rows.append((at, None if letter == "K" else WANTED[state]))
            cost += price
            letters.append(letter)
            state, at = to, at + 1
    while is_last and after[state] > 0:
        insert()
    return cost, "".join(letters), rows, state
