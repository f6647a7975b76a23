"""Repair of the structure of conversations, of any length, over many partitions.

All rows are put in order; every conversation is cut into pieces of about the square
root of its rows. A piece's least costs from state to state make one small table, and
chains of those give the cost vector after each piece, the checkpoints, and then the
state before it. With both, pieces are repaired on their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from math import inf
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm import repair
from repopulse.llm.lines import BLANK
from repopulse.llm.sweep import in_order
from repopulse.session import staged

#: Rows that a piece has at least, unless its conversation or its range ends.
LEAST_PIECE = 64
#: Rows that leave Python at a time.
ROWS = 2_000
KEY = ["conv", "part", "piece"]
# Kinds of roles by their initial, pairs of initials that may follow each other, new roles.
KINDS = {"s": repair.SYSTEM, "u": repair.USER, "a": repair.ASSISTANT}
FOLLOWING = {(repair.SYSTEM, repair.USER), (repair.USER, repair.ASSISTANT), (repair.ASSISTANT, repair.USER)}
ROLES = {repair.USER: "user", repair.ASSISTANT: "assistant", None: None}
#: No way from one state to another, as infinity cannot be stored.
NEVER = -1

PIECES = (
    "conv string, part int, piece int, alone boolean, codes binary, turns array<long>, "
    "roles array<string>, digests array<binary>, illegal long, first int, last int, costs array<long>"
)
SOLVED = (
    "conv string, part int, piece int, alone boolean, turns array<long>, roles array<string>, "
    "digests array<binary>, illegal long, cost long, audit string, places array<int>, "
    "new_roles array<string>"
)


def _key(column: str) -> Column:
    """A text that tells apart all values and null."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit(""))


def _text(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(" "))


def _facts(rows: DataFrame) -> DataFrame:
    """What decides about each row, without its text."""
    said = F.rtrim(F.col("text"), F.lit(BLANK))
    initial = F.left(F.col("role"), F.lit(1))
    kind = F.lit(repair.OTHER)
    for letter, number in KINDS.items():
        kind = F.when(initial == letter, number).otherwise(kind)
    return rows.select(
        "conv",
        "turn",
        "role",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        kind.alias("kind"),
        (said == "").alias("blank"),
        ((said != "") & ~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("open_end"),
    )


def _table(columns: list[str], schema: str) -> Callable[[list[tuple]], pa.RecordBatch]:
    """Maker of a record batch from tuples, for the simple types used here."""
    kinds = {
        "string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(),
        "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
        "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()),
    }
    types = [kinds[field.split()[1]] for field in schema.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(arrays, names=columns)

    return made


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _mapped(rows: DataFrame, schema: str, function: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """Rows that a function of a partition's rows gives, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = _table(_names(schema), schema), []
        for row in function(_rows(batches)):
            held.append(row)
            if len(held) == ROWS:
                yield made(held)
                held = []
        if held:
            yield made(held)

    return rows.mapInArrow(run, schema)


def _cut(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Pieces of ordered rows (part, conv, turn, role, digest, code, spacing).

    A conversation that neither starts nor ends a range and fits one piece is
    alone; of the others the costs from state to state go along.
    """
    for part, of_part in groupby(rows, itemgetter(0)):
        held: tuple | None = None
        for conv, run in groupby(of_part, itemgetter(1)):
            is_first = held is None
            if held is not None:
                yield _piece(*held)
            previous, piece, number = None, [], 0
            for row in run:
                if len(piece) == row[6]:
                    yield _piece(part, conv, number, False, piece, previous)
                    previous, piece, number = piece[-1][5] & 3, [], number + 1
                piece.append(row)
            # Whether the range ends here is known once the next conversation has come.
            held = (part, conv, number, number == 0 and not is_first, piece, previous)
        if held is not None:
            yield _piece(*held[:3], False, *held[4:])


def _piece(part: int, conv: str, number: int, alone: bool, rows: list, previous: int | None) -> tuple:
    codes = bytes(row[5] for row in rows)
    kinds = [code & 3 for code in codes]
    pairs = zip(kinds if previous is None else [previous, *kinds], kinds[1:] if previous is None else kinds)
    costs = None
    if not alone:
        table = repair.transitions(codes)
        costs = [NEVER if x == inf else x for vector in table for x in vector]
    return (
        conv, part, number, alone, codes,
        [row[2] for row in rows], [row[3] for row in rows], [row[4] for row in rows],
        sum(pair not in FOLLOWING for pair in pairs), kinds[0], kinds[-1], costs,
    )


def _checkpoints(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The vector after each piece (conv, part, piece, costs), given the last pieces first."""
    for conv, pieces in groupby(rows, itemgetter(0)):
        after, is_last = repair.FINAL, True
        for _, part, piece, costs in pieces:
            yield conv, part, piece, list(map(int, after)), is_last
            ways = [[inf if x == NEVER else x for x in costs[4 * end : 4 * end + 4]] for end in repair.STATES]
            after = tuple(min(ways[end][q] + after[end] for end in repair.STATES) for q in repair.STATES)
            is_last = False


def _ends(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The state after each piece (conv, part, piece, codes, first, last, after, is_last) from each before it."""
    for conv, part, piece, codes, first, last, after, is_last in rows:
        ends = [repair.cheapest(codes, after, q, is_last)[3] for q in repair.STATES]
        yield conv, part, piece, first, last, ends, after, is_last


def _starts(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The state before each piece, given the first pieces first, and what its joint with the last range adds."""
    for conv, pieces in groupby(rows, itemgetter(0)):
        state, end = repair.START, None
        for _, part, piece, first, last, ends, after, is_last in pieces:
            joint = int(piece == 0 and end is not None and (end, first) not in FOLLOWING)
            yield conv, part, piece, state, joint, after, is_last
            state, end = ends[state], last


def _solved(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, part, piece, alone, codes, turns, roles, digests, illegal, state, joint, after, is_last in rows:
        cost, audit, kept, _ = repair.cheapest(codes, after or repair.FINAL, state, is_last)
        yield (
            conv, part, piece, alone, turns, roles, digests, illegal + joint, cost, audit,
            [place for place, _ in kept], [ROLES[kind] for _, kind in kept],
        )


def _in_runs(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Each conversation's pieces in one partition, in order; only small rows pass here."""
    return rows.repartition("conv").sortWithinPartitions("conv", *order)


@dataclass(frozen=True)
class Repaired:
    """`conversations`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    `turns`: conv, place, role, text and `alone`, the repaired rows in the order of place."""

    conversations: DataFrame
    turns: DataFrame


def mend(spark: SparkSession, rows: DataFrame) -> Repaired:
    """Faults of conversations and the cheapest edits that mend them.

    `rows` has conv_id, turn, role and text. A conversation is read by turn, null
    first, then by role and the text's SHA-256; equal rows follow each other. Null
    roles and texts are one space; a null conv_id is a conversation of its own. A
    row's first fault counts: blank, duplicate (role and text seen earlier),
    truncated (its last character but white space is none of `.!?`). `illegal`
    counts neighbours whose roles' initials are not su, ua or au, `gaps` the turns
    missing between the least and the greatest.

    Keep costs 0, Rerole to user or assistant 3, Delete 4, and it is the only edit
    of a blank or duplicate row; an inserted row, user or assistant without text,
    costs 3, a truncated one that stays 3. `audit` has the edits' initials in order;
    of equally cheap ones the ASCII-least. A role whose initial is not s, u or a,
    or that is empty, cannot be kept. Empty tables have no rows; other columns are
    not looked at, whatever their names.

    Texts are read twice and shuffled only where a row stays; all else are facts of
    some fifty bytes a row. A conversation may hold any share of the rows: its rows
    are spread over ranges and pieces of about the square root of their number;
    one small table a piece passes through a single task.
    """
    given = rows.select(
        _key("conv_id").alias("conv"),
        F.col("`turn`").cast("long").alias("turn"),
        _text("role").alias("role"),
        _text("text").alias("text"),
    )
    ordered = in_order(spark, _facts(given), "conv", "turn", "role", "digest")
    said = ["conv", "role", "digest"]
    repeats = staged(
        spark,
        ordered.where(~F.col("blank"))
        .groupBy(*said)
        .agg(F.count("*").alias("n"), F.min(F.struct("turn", "row_id")).alias("earliest"))
        .where("n > 1")
        .select(*said, F.col("earliest.row_id").alias("earliest")),
        "repeats",
    )
    long = staged(
        spark,
        ordered.groupBy("conv").agg(F.count("*").alias("n")).where(F.col("n") > LEAST_PIECE**2),
        "long",
    )
    is_copy = ~F.col("blank") & F.coalesce(F.col("earliest") != F.col("row_id"), F.lit(False))
    cut_off = ~is_copy & F.col("open_end")
    unwanted = F.col("blank") | is_copy
    marks = F.when(unwanted, repair.UNWANTED).otherwise(F.when(cut_off, repair.TRUNCATED).otherwise(0))
    coded = staged(
        spark,
        ordered.join(repeats, said, "left")
        .join(long, "conv", "left")
        .select(
            "part", "conv", "turn", "role", "digest",
            (F.col("kind") + marks).alias("code"),
            F.coalesce(F.ceil(F.sqrt("n")), F.lit(LEAST_PIECE)).cast("int").alias("spacing"),
            "row_id", "blank", is_copy.alias("is_copy"), cut_off.alias("cut_off"),
        ),
        "coded",
    )
    order = ["part", "conv", "turn", "role", "digest", "row_id"]
    pieces = staged(
        spark,
        _mapped(
            coded.repartition("part")
            .sortWithinPartitions(*order)
            .select("part", "conv", "turn", "role", "digest", "code", "spacing"),
            PIECES,
            _cut,
        ),
        "pieces",
    )
    solved = staged(spark, _mapped(_with_starts(spark, pieces), SOLVED, _solved), "solved")

    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    faults = coded.groupBy("conv").agg(
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"),
        F.count_if("blank").alias("blank"),
        F.count_if("is_copy").alias("duplicate"),
        F.count_if("cut_off").alias("truncated"),
    )
    edits = solved.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_sort(F.collect_list(F.struct("part", "piece", "audit"))).alias("audits"),
    )
    ids = rows.select("conv_id").distinct().withColumn("conv", _key("conv_id"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    conversations = (
        ids.join(faults, "conv", "left")
        .join(edits, "conv", "left")
        .select(
            "conv",
            "conv_id",
            *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
            F.coalesce(F.array_join("audits.audit", ""), F.lit("")).alias("audit"),
        )
    )
    return Repaired(conversations, _turns(given, solved))


def _with_starts(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """Pieces with the state before them and the vector after them; none of either where alone."""
    parted = pieces.where(~F.col("alone"))
    last_first = _in_runs(parted.select(*KEY, "costs"), F.desc("part"), F.desc("piece"))
    stored = "conv string, part int, piece int, after array<long>, is_last boolean"
    after = staged(spark, _mapped(last_first, stored, _checkpoints), "after")
    known = parted.join(after, KEY).select(*KEY, "codes", "first", "last", "after", "is_last")
    ends = _mapped(
        known,
        "conv string, part int, piece int, first int, last int, ends array<int>, "
        "after array<long>, is_last boolean",
        _ends,
    )
    starts = _mapped(
        _in_runs(staged(spark, ends, "ends"), "part", "piece"),
        "conv string, part int, piece int, state int, joint int, after array<long>, is_last boolean",
        _starts,
    )
    return pieces.join(staged(spark, starts, "starts"), KEY, "left").select(
        *KEY, "alone", "codes", "turns", "roles", "digests", "illegal",
        F.coalesce("state", F.lit(repair.START)).alias("state"),
        F.coalesce("joint", F.lit(0)).alias("joint"),
        "after",
        F.coalesce("is_last", F.lit(True)).alias("is_last"),
    )


def _turns(given: DataFrame, solved: DataFrame) -> DataFrame:
    """The repaired rows: those inserted, and those that stay with their texts."""
    turn_key = F.coalesce(F.col("turn").cast("string"), F.lit(" ")).alias("turn_key")
    out = solved.select(
        *KEY, "alone", "turns", "roles", "digests",
        F.posexplode(F.arrays_zip("places", "new_roles")).alias("at", "row"),
    ).select(
        "conv",
        F.struct("part", "piece", "at").alias("place"),
        "alone",
        F.get("turns", F.col("row.places")).alias("turn"),
        F.get("roles", F.col("row.places")).alias("role"),
        F.get("digests", F.col("row.places")).alias("digest"),
        F.col("row.places").alias("from"),
        F.col("row.new_roles").alias("new_role"),
    )
    inserted = out.where("from < 0").select(
        "conv", "place", "alone", F.col("new_role").alias("role"), F.lit("").alias("text")
    )
    said = ["conv", "turn_key", "role", "digest"]
    # Of equal rows at most one stays; copies collapse before the shuffle.
    texts = given.select(
        "conv", turn_key, "role", F.unhex(F.sha2("text", 256)).alias("digest"), "text"
    ).dropDuplicates(said)
    stay = out.where("from >= 0").select("conv", "place", "alone", turn_key, "role", "digest", "new_role")
    kept = stay.join(texts, said).select(
        "conv", "place", "alone", F.coalesce("new_role", "role").alias("role"), "text"
    )
    return kept.unionByName(inserted)


def _hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """SHA-256 of bodies that follow each other, joined by a line feed."""
    for conv, bodies in groupby(rows, itemgetter(0)):
        found = hashlib.sha256()
        for number, (_, body) in enumerate(bodies):
            found.update((b"\n" if number else b"") + body.encode())
        yield conv, found.hexdigest()


def digests(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv, digest): SHA-256 of each conversation's `role:text`, joined by line feeds.

    Pieces are joined where they lie. A conversation of several pieces is hashed
    piece by piece in one task, as the hash of a text cannot be made from parts; no
    more than one piece of it is in memory.
    """
    line = F.concat("role", F.lit(":"), "text")
    order = F.array_sort(F.collect_list(F.struct(F.col("place.at").alias("at"), line.alias("line"))))
    joined = (
        turns.groupBy("conv", F.col("place.part").alias("part"), F.col("place.piece").alias("piece"), "alone")
        .agg(order.alias("lines"))
        .select("conv", "part", "piece", "alone", F.array_join("lines.line", "\n").alias("body"))
    )
    held = staged(
        spark,
        joined.select(
            "conv", "part", "piece", "alone",
            F.when(F.col("alone"), F.sha2("body", 256)).alias("digest"),
            F.when(~F.col("alone"), F.col("body")).alias("body"),
        ),
        "bodies",
    )
    parted = _in_runs(held.where(~F.col("alone")), "part", "piece").select("conv", "body")
    whole = held.where("alone").select("conv", "digest")
    return whole.unionByName(_mapped(parted, "conv string, digest string", _hashed))


def repaired_digests(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """`Repaired.conversations` with `digest`, the SHA-256 of the repaired rows; of none, that of empty text."""
    found = mend(spark, rows)
    known = digests(spark, found.turns)
    empty = F.sha2(F.lit(""), 256)
    return found.conversations.join(known, "conv", "left").withColumn("digest", F.coalesce("digest", empty))
