"""Near-duplicates by SimHash.

Fingerprints are computed once per text and linked by the pigeonhole principle:
of 2d blocks of a fingerprint, at least d are equal in two that differ in at most
d bits. Fingerprints that share d blocks with another one go on to blocks of four
bits, of which all but d must be equal; such a bucket cannot hold more than 16^d
different fingerprints, whatever the corpus. Pairs within it are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm.components import connected_components
from repopulse.session import staged

BITS = 64
SEED = 42
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 15


def _hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 of every shingle; of the whole sequence if it has fewer words."""
    words = text.encode().lower().split()
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if words else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def _fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64 bits; zero for null and for texts without words."""
    hashes = _hashes(text or "", shingle)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), CHUNK):
        octets = hashes[i : i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Fingerprint of a text as a long; `shingle` is the words per shingle."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array((_fingerprint(t.as_py(), shingle) for t in texts), pa.int64())

    return of(text)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _blocks(n: int) -> list[int]:
    """Masks of n blocks of nearly equal width, each of whole groups of four bits."""
    cuts = [4 * (BITS // 4 * i // n) for i in range(n + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def links(spark: SparkSession, prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs u < v of the different fingerprints `print` that differ in at most max_bits bits.

    `max_bits` is 8 at most.
    """
    if max_bits == 0:
        return prints.select(F.col("print").alias("u"), F.col("print").alias("v")).limit(0)
    full = (1 << BITS) - 1
    free = [sum(some) for some in combinations(_blocks(2 * max_bits), max_bits)]

    def keyed(masks: list[tuple[int, int]]) -> Column:
        """(which mask, what it leaves of the fingerprint) for each mask."""
        return F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(i).alias("which"),
                        F.col("print").bitwiseAND(F.lit(_signed(full & ~mask))).alias("key"),
                    )
                    for i, mask in masks
                )
            )
        ).alias("k")

    coarse = prints.select("print", keyed(list(enumerate(free)))).select("print", "k.*")
    shared = coarse.groupBy("which", "key").agg(F.count("*").alias("n")).where("n > 1")
    # Staged, so that the join can split a bucket among tasks.
    shared = staged(spark, shared.select("which", "key"), "buckets")
    crowded = coarse.join(shared, ["which", "key"], "left_semi").select("print", "which")
    # Fine blocks lie within the coarse blocks that may differ.
    fine = [sum(some) for some in combinations(_blocks(BITS // 4), max_bits)]
    masks = [[(i, m) for i, m in enumerate(fine) if m & ~wide == 0] for wide in free]
    parts = F.array(*(F.array(*(F.lit(i) for i, _ in own)) for own in masks))
    wipes = F.array(*(F.lit(_signed(full & ~m)) for m in fine))
    placed = crowded.select("print", F.explode(parts[F.col("which")]).alias("which")).distinct()
    placed = placed.withColumn("key", F.col("print").bitwiseAND(wipes[F.col("which")]))
    a, b = placed.alias("a"), placed.alias("b")
    near = (
        (F.col("a.which") == F.col("b.which"))
        & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.print") < F.col("b.print"))
        & (F.bit_count(F.col("a.print").bitwiseXOR(F.col("b.print"))) <= max_bits)
    )
    return a.join(b, near).select(F.col("a.print").alias("u"), F.col("b.print").alias("v")).distinct()


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """(row_id, doc_id, print, group, component_id) of every row, from a staged table.

    `print` is the fingerprint as a long, `group` the least fingerprint that links
    reach from it, and `component_id` the least doc_id of the group. Null texts and
    texts without words have the fingerprint zero and are linked like any other;
    null ids are members without a say in `component_id`, which is null if the
    group has no other; repeated rows are rows of the same group; an empty table
    gives none. Only fingerprints are shuffled, never texts.
    """
    prints = docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("print"))
    return grouped(spark, staged(spark, numbered(prints), "prints"), max_bits)


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with `row_id`, to be staged before use: a number is as stable as its table."""
    return rows.withColumn("row_id", F.monotonically_increasing_id())


def grouped(spark: SparkSession, prints: DataFrame, max_bits: int) -> DataFrame:
    """`near_duplicates` for staged rows of (row_id, doc_id, print)."""
    nodes = staged(spark, prints.groupBy("print").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = connected_components(spark, links(spark, nodes, max_bits))
    member = nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "least_id", F.coalesce("root", "print").alias("group")
    )
    ids = member.groupBy("group").agg(F.min("least_id").alias("component_id"))
    labels = staged(spark, member.join(ids, "group").select("print", "group", "component_id"), "labels")
    return prints.join(labels, "print").select("row_id", "doc_id", "print", "group", "component_id")


def keep_one(
    spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One document of each group, with its columns: that of the least doc_id.

    Null ids come last; of several rows with the least id that with the least hash of
    its text stays, and of equal rows any. Null and empty texts have a fingerprint like
    others, so one of them stays; an empty table has none; columns may have any name.
    """
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        fingerprint(F.col("text"), shingle).alias("print"),
    )
    held = staged(spark, numbered(rows), "rows")
    found = grouped(spark, held.select("row_id", F.col("row.doc_id"), "print"), max_bits)
    texts = held.select("row_id", F.xxhash64("row.text").alias("text_key"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "row_id")
    first = found.join(texts, "row_id").groupBy("group").agg(F.min(order)["row_id"].alias("row_id"))
    return held.join(first, "row_id", "left_semi").select("row.*")
