"""Removal of passages that an earlier document holds, by level-wise doubling.

The first level looks at windows of half the length, and of those only at one in
each stretch that a full window spans: the one with the least hash, which is the
same in every copy of the window. Only where such a window occurs in two
different texts are windows of twice its length formed, and these are decided by
128-bit hashes. Exact copies of a whole text are settled before, by a digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm.rolling import WordHashes, windows
from repopulse.session import staged

KEY = ["doc_id", "text_key"]
#: Rows of windows that leave Python at a time.
ROWS = 100_000


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _digest(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def _least(hashes: np.ndarray, stretch: int) -> np.ndarray:
    """For each stretch of that many entries, the place of its least one."""
    return sliding_window_view(hashes, stretch).argmin(axis=1) + np.arange(len(hashes) - stretch + 1)


def _anchors(window: int):
    """Per text: number of words, digest, and the windows of the first level."""
    half = window // 2

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in batches:
            counts, digests, hashes, places = [], [], [], []
            for text in batch["text"]:
                words = _words(text.as_py())
                counts.append(len(words))
                digests.append(_digest(words))
                found = windows(memory.of(words), half)
                at = np.unique(_least(found, window - half + 1)) if len(words) >= window else []
                hashes.append(found[at].view(np.int64) if len(at) else [])
                places.append(np.asarray(at, np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_key"],
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(hashes, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                names=["doc_id", "text_key", "n_words", "digest", "hashes", "places"],
            )

    return of


def _full_windows(window: int):
    """Rows of the full windows whose least half is among the text's `places`."""
    half = window // 2

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()

        def rows(held: list) -> pa.RecordBatch:
            ids, keys, starts, first, second = zip(*held)
            n = [len(x) for x in starts]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(ids, np.int64), n)),
                    pa.array(np.repeat(np.array(keys, np.int64), n)),
                    pa.array(np.concatenate(starts).astype(np.int32)),
                    pa.array(np.concatenate(first).view(np.int64)),
                    pa.array(np.concatenate(second).view(np.int64)),
                ],
                names=["doc_id", "text_key", "place", "h1", "h2"],
            )

        for batch in batches:
            held, size = [], 0
            for i, text in enumerate(batch["text"]):
                hashes = memory.of(_words(text.as_py()))
                least = _least(windows(hashes, half), window - half + 1)
                starts = np.flatnonzero(np.isin(least, batch["places"][i].values.to_numpy()))
                first = windows(hashes, window)[starts]
                second = windows(hashes ^ np.uint64(0x5DEECE66D), window)[starts]
                held.append((batch["doc_id"][i].as_py(), batch["text_key"][i].as_py(), starts, first, second))
                size += len(starts)
                if size >= ROWS:
                    yield rows(held)
                    held, size = [], 0
            if held:
                yield rows(held)

    return of


def _without(window: int):
    """What is left of each text once the windows at `places` are taken out."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests, texts = [], [], []
            for text, places in zip(batch["text"], batch["places"]):
                words = _words(text.as_py())
                starts = places.values.to_numpy()
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + window, -1)
                gone = np.cumsum(edges[:-1]) > 0
                left = [w for w, out in zip(words, gone.tolist()) if not out]
                removed.append(int(gone.sum()))
                digests.append(_digest(left))
                texts.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_key"],
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(texts, pa.string()),
                ],
                names=["doc_id", "text_key", "n_removed", "kept_digest", "kept_text"],
            )

    return of


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows of one id and text share a key; ids alone need not be unique."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def repeated_passages(spark: SparkSession, docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, text_key, n_words, digest, n_removed, kept_digest, kept_text) of every row.

    A word is removed if it lies in a window of `window` consecutive words that
    also starts in a document with a smaller doc_id; windows are those of the
    input. Digests are SHA-256 of the words joined by one space, `kept_text` those
    that are left, or null where nothing is removed. `text_key` tells apart texts
    of one id. Null and short texts lose nothing; a row without id neither loses
    nor removes anything; repeated rows of one id are no reason to remove; an
    empty table gives none.

    Texts are shuffled once; after that only those that share a window of the first
    level with another text are. What is known of each window or digest is staged
    before it is joined, so that a frequent one can be split among tasks.
    """
    keyed = _keyed(docs)
    first = staged(
        spark,
        keyed.mapInArrow(
            _anchors(window),
            "doc_id long, text_key long, n_words long, digest binary, "
            "hashes array<long>, places array<int>",
        ),
        "anchors",
    )
    # Copies of a whole text: only the least id of each text goes on.
    whole = first.select(*KEY, "n_words", "digest")
    long = whole.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    owners = staged(
        spark, long.groupBy("digest").agg(F.min("doc_id").alias("owner")), "owners"
    )
    status = whole.join(owners, "digest", "left")
    # First level: windows found in two different texts.
    # Rows of one id share their places, which can only add candidates.
    found = first.where("doc_id is not null").select(
        "doc_id",
        F.xxhash64("digest").alias("of_text"),
        F.explode(F.arrays_zip("hashes", "places")).alias("w"),
    )
    found = found.select(
        "doc_id", "of_text", F.col("w.hashes").alias("hash"), F.col("w.places").alias("place")
    )
    shared = staged(
        spark,
        found.groupBy("hash")
        .agg(F.min("of_text").alias("a"), F.max("of_text").alias("b"))
        .where("a != b")
        .select("hash"),
        "shared",
    )
    places = (
        found.join(shared, "hash", "left_semi")
        .groupBy("doc_id")
        .agg(F.collect_set("place").alias("places"))
    )
    firsts = status.where("doc_id = owner").select(*KEY).distinct()
    places = places.join(firsts, "doc_id").select(*KEY, "places")
    texts = staged(spark, keyed.join(places, KEY), "texts")
    # Second level: full windows, each with the least id that has it.
    rows = texts.mapInArrow(
        _full_windows(window), "doc_id long, text_key long, place int, h1 long, h2 long"
    )
    least = staged(
        spark,
        rows.groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        .where("owner < last")
        .select("h1", "h2", "owner"),
        "least",
    )
    hits = (
        rows.join(least, ["h1", "h2"])
        .where("doc_id > owner")
        .groupBy(*KEY)
        .agg(F.collect_set("place").alias("places"))
    )
    changed = (
        texts.select(*KEY, "text")
        .dropDuplicates(KEY)
        .join(hits, KEY)
        .mapInArrow(
            _without(window),
            "doc_id long, text_key long, n_removed long, kept_digest binary, kept_text string",
        )
    )
    gone = F.col("doc_id") > F.col("owner")
    none = F.lit(_digest([]))
    return status.join(changed, KEY, "left").select(
        *KEY,
        "n_words",
        "digest",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, none).otherwise(F.coalesce("kept_digest", "digest")).alias("kept_digest"),
        F.when(gone, "").otherwise(F.col("kept_text")).alias("kept_text"),
    )


def without_repeats(spark: SparkSession, docs: DataFrame, window: int = 50) -> DataFrame:
    """All documents with their columns, the text without what earlier documents hold.

    Texts that lose nothing stay as they are; of the others the words are left,
    joined by one space.
    """
    found = repeated_passages(spark, docs, window)
    changed = found.where("n_removed > 0").select(*KEY, "kept_text").dropDuplicates(KEY)
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        "doc_id",
        F.xxhash64("text").alias("text_key"),
    )
    text = F.coalesce("kept_text", "row.text")
    return rows.join(changed, KEY, "left").select(
        *(text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns)
    )
