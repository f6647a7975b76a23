"""Removal of documents that hold passages of benchmark items.

Documents are taken in shards; each shard gets a suffix array of its words, and
every suffix of every item is looked up in it by binary search, which yields the
longest verbatim match and all places of each window. Items reach the shards in
blocks of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of item texts in one broadcast block, and of document texts in one shard.
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 8 << 20

# Every octet that cannot be part of a word becomes a space, and A-Z lower case.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def split_words(text: str | None) -> list[bytes]:
    """Runs of a-z, 0-9 and all non-ASCII characters, after lower-casing A-Z."""
    return (text or "").encode().translate(_TABLE).split()


@dataclass
class Block:
    """Items as word numbers; a suffix that starts a window has its length in `need`."""

    vocabulary: dict[bytes, int]
    words: np.ndarray
    starts: np.ndarray
    need: np.ndarray
    left: np.ndarray
    window_of: np.ndarray
    items_of: list[list[str]]


def make_block(items: list[tuple[str, list[bytes]]], window: int) -> Block:
    vocabulary: dict[bytes, int] = {}
    words, starts, need, left, window_of = [], [], [], [], []
    numbers: dict[tuple, int] = {}
    items_of: list[set[str]] = []
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in text]
        length = min(window, len(ids))
        for i in range(len(ids) - length + 1) if ids else ():
            number = numbers.setdefault(tuple(ids[i : i + length]), len(numbers))
            if number == len(items_of):
                items_of.append(set())
            items_of[number].add(item)
            starts.append(len(words) + i)
            need.append(length)
            left.append(len(ids) - i)
            window_of.append(number)
        words += [*ids, 0]
    ints = lambda x: np.array(x, np.int64)
    return Block(
        vocabulary, ints(words), ints(starts), ints(need), ints(left), ints(window_of),
        [sorted(x) for x in items_of],
    )


def blocks_of(spark: SparkSession, benchmark: DataFrame, window: int) -> list:
    """Broadcasts of the items, each of at most BLOCK_BYTES or a single item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text")
    blocks, held, size = [], [], 0

    def send() -> None:
        if held:
            blocks.append(spark.sparkContext.broadcast(vars(make_block(held, window))))

    for item, text in items.toLocalIterator():
        words = split_words(text)
        if held and size + len(text or "") > BLOCK_BYTES:
            send()
            held, size = [], 0
        if words:
            held.append((item, words))
            size += len(text)
    send()
    return blocks


def suffix_array(words: np.ndarray, deepest: int) -> np.ndarray:
    """Places of `words` in the order of the suffixes that start there.

    Ranks are refined by doubling the compared length until all differ or it
    reaches `deepest`.
    """
    rank, length = words, 1
    while length < deepest:
        after = np.zeros_like(rank)
        after[:-length] = rank[length:] + 1
        distinct, rank = np.unique(rank * (len(words) + words.max() + 2) + after, return_inverse=True)
        if len(distinct) == len(words):
            break
        length *= 2
    return np.argsort(rank, kind="stable")


def _bound(words, order, lo, hi, depth, wanted, after: bool) -> np.ndarray:
    """In each interval of the suffix array, the first place whose word is not below `wanted`."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        middle = (lo + hi) >> 1
        found = words[np.minimum(order[np.where(open_, middle, 0)] + depth, len(words) - 1)]
        below = open_ & ((found <= wanted) if after else (found < wanted))
        lo = np.where(below, middle + 1, lo)
        hi = np.where(open_ & ~below, middle, hi)
    return lo


def search(words: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, dict]:
    """Matches of every item suffix in the text `words`, which ends with a 0.

    Place and length of every match that cannot be made longer at either end; and all
    places of each window that occurs, by the window's number. Suffixes are looked up
    to the length of their window; every place in the interval found is followed on.
    """
    order = suffix_array(words, int(block.need.max()))
    n = len(block.starts)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(words))
    first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
    active, depth = np.arange(n), 0
    while len(active):
        wanted = block.words[block.starts[active] + depth]
        a = _bound(words, order, lo[active], hi[active], depth, wanted, after=False)
        b = _bound(words, order, a, hi[active], depth, wanted, after=True)
        active, a, b = active[a < b], a[a < b], b[a < b]
        lo[active], hi[active] = a, b
        depth += 1
        whole = block.need[active] == depth
        first[active[whole]], last[active[whole]] = a[whole], b[whole]
        active = active[~whole]
    matched = np.flatnonzero(last > first)
    found, all_places = {}, []
    for q in matched:
        all_places.append(order[first[q] : last[q]])
        found.setdefault(int(block.window_of[q]), all_places[-1])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), found
    place = np.concatenate(all_places)
    suffix = np.repeat(matched, last[matched] - first[matched])
    # Where the words before are equal too, the suffix before has the same match and more.
    start = block.starts[suffix]
    before = np.where(start > 0, block.words[start - 1], 0)
    inner = (place > 0) & (before > 0) & (before == words[place - 1])
    place, suffix = place[~inner], suffix[~inner]
    return place, _followed(words, block, place, suffix), found


def _followed(words: np.ndarray, block: Block, place: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """How long the match of each suffix at its place is, which is at least its window."""
    length = block.need[suffix].copy()
    start, left = block.starts[suffix], block.left[suffix]
    going = np.arange(len(place))
    while True:
        going = going[length[going] < left[going]]
        at = place[going] + length[going]
        same = words[at] == block.words[start[going] + length[going]]
        going = going[same]
        if not len(going):
            return length
        length[going] += 1


def _shard(texts: list[str | None], blocks: list) -> list[tuple]:
    """(n_words, n_hit, item ids, longest match, its place) of each text."""
    n_words = [0] * len(texts)
    items: list[set[str]] = [set() for _ in texts]
    longest = [(0, -1)] * len(texts)
    edges: list[np.ndarray | None] = [None] * len(texts)
    for handle in blocks or [None]:
        block = handle and Block(**handle.value)
        least = int(block.need.min()) if block else 0
        runs, docs, places = [], [], []
        for i, text in enumerate(texts):
            words = split_words(text)
            n_words[i] = len(words)
            if not block or not words:
                continue
            ids = np.fromiter(map(block.vocabulary.get, words, repeat(0)), np.int64, len(words))
            # Only stretches of item words that are long enough can match.
            cuts = np.flatnonzero(np.concatenate(([0], ids, [0])) == 0)
            for a, b in zip(cuts, cuts[1:]):
                if b - a > least:
                    runs.append(np.append(ids[a : b - 1], 0))
                    docs.append(np.full(b - a, i))
                    places.append(np.arange(a, b))
        if not runs:
            continue
        words, doc, at = np.concatenate(runs), np.concatenate(docs), np.concatenate(places)
        where, deep, windows = search(words, block)
        # Per document the longest match, and of equal ones the first.
        best = np.lexsort((at[where], -deep, doc[where]))
        best = best[np.append(True, np.diff(doc[where][best]) > 0)] if len(best) else best
        for i, length, start in zip(doc[where][best].tolist(), deep[best].tolist(), at[where][best].tolist()):
            longest[i] = max(longest[i], (length, start), key=lambda x: (x[0], -x[1]))
        for number, found in windows.items():
            length = int(block.need[block.window_of == number][0])
            for i in np.unique(doc[found]).tolist():
                items[i].update(block.items_of[number])
                if edges[i] is None:
                    edges[i] = np.zeros(n_words[i] + 1, np.int32)
            order = np.argsort(doc[found], kind="stable")
            own, starts = doc[found][order], at[found][order]
            for i, part in zip(np.unique(own).tolist(), np.split(starts, np.flatnonzero(np.diff(own)) + 1)):
                np.add.at(edges[i], part, 1)
                np.add.at(edges[i], part + length, -1)
    hit = [0 if e is None else int((np.cumsum(e[:-1]) > 0).sum()) for e in edges]
    return [(n_words[i], hit[i], sorted(items[i]), *longest[i]) for i in range(len(texts))]


FINDINGS = (
    "n_words long, n_hit long, n_items long, items_sha256 string, "
    "items array<string>, longest_match long, longest_place long"
)


def findings(text: Column, blocks: list) -> Column:
    """What the blocks' items have in common with a text, as a struct of FINDINGS."""

    @F.arrow_udf(FINDINGS)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found, held, size = [], [], 0
            for text in batch:
                held.append(text.as_py())
                size += len(held[-1] or "")
                if size >= SHARD_BYTES:
                    found += _shard(held, blocks)
                    held, size = [], 0
            found += _shard(held, blocks)
            yield pa.StructArray.from_arrays(
                [
                    pa.array([x[0] for x in found], pa.int64()),
                    pa.array([x[1] for x in found], pa.int64()),
                    pa.array([len(x[2]) for x in found], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x[2]).encode()).hexdigest() for x in found]),
                    pa.array([x[2] for x in found], pa.list_(pa.string())),
                    pa.array([x[3] for x in found], pa.int64()),
                    pa.array([x[4] if x[3] else None for x in found], pa.int64()),
                ],
                names=[x.split()[0] for x in FINDINGS.split(", ")],
            )

    return of(text)


def matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """All columns of `docs` in the struct `row`, with the columns of FINDINGS.

    A window is `window` consecutive words of an item, or all words of an item of
    fewer; a document word inside any occurrence of a window is hit. `items` are
    the ids, as strings, of items with an occurring window; `longest_match` is the
    length in words of the longest match that any item suffix has in this document,
    and `longest_place` the word at which it first starts; both do not depend on how
    documents fall into shards.
    Null texts have no words, a null item id counts as the empty string, repeated
    ids count once, and without items nothing is hit. No row is shuffled.
    """
    found = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        findings(F.col("text"), blocks_of(spark, benchmark, window)).alias("found"),
    )
    return found.select("row", "found.*")


def without_benchmark(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10
) -> DataFrame:
    """The documents no word of which is hit, with their columns.

    Null and empty texts are not hit; repeated rows all stay or go; without items all
    documents stay.
    """
    return matches(spark, docs, benchmark, window).where("n_hit = 0").select("row.*")
