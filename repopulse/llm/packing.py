"""Packing of token streams into windows that all hold the same mixture of sources.

Each source is a queue of tokens, with a first deficit of its own. Every token is
due at its place in the queue, plus that deficit, over the weight of its source, and
windows take tokens in the order in which they are due: deficit round-robin with a
quantum of one token. What a source could not place in one window is thereby carried
into the next, over all windows and partitions.

The order is found without any task that sees all queues: time is cut into cells of
some windows' tokens, the tokens of each cell are counted per queue and summed up
over the cells, and where a window ends inside a cell is settled there.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repopulse.llm.tokens import worker_encoder
from repopulse.session import arrow_batches, staged

#: Places of a queue that are looked at together; no piece goes beyond one block.
BLOCK = 1 << 18
#: Windows that a cell of time holds about.
CELL = 8
#: Bytes of texts that are encoded at a time.
BATCH_BYTES = 2 << 20
#: Rows with ids that are worked on at a time.
ROWS = 500


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few, so that a worker holds little besides what it is sent."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def _encoded(path: str, end: int, lower: bool):
    """Ids of each text and its place in its source's queue within this partition."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, ends = worker_encoder(path, lower), TaskContext.get().partitionId(), {}
        tail = np.array([end], encoder.kind).tobytes()

        def rows(ids: list, sources: list, texts: list) -> pa.RecordBatch:
            found = [x + tail for x in encoder.encode(texts)]
            before = []
            for source, own in zip(sources, found):
                before.append(ends.get(source, 0))
                ends[source] = before[-1] + len(own) // len(tail)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sources, pa.string()),
                    pa.array([part] * len(ids), pa.int64()),
                    pa.array(before, pa.int64()),
                    pa.array([len(x) // len(tail) for x in found], pa.int64()),
                    pa.array(found, pa.binary()),
                ],
                names=["doc_id", "source", "part", "before", "n", "ids"],
            )

        held: tuple[list, list, list] = ([], [], [])
        size = 0
        for batch in batches:
            for row in zip(batch["doc_id"], batch["source"], batch["text"]):
                for column, value in zip(held, row):
                    column.append(value.as_py())
                size += len(held[2][-1] or "")
                if size >= BATCH_BYTES:
                    yield rows(*held)
                    held, size = ([], [], []), 0
        if held[0]:
            yield rows(*held)

    return of


@dataclass(frozen=True)
class Cells:
    """Cells of time: from `starts[i]` on they are `steps[i]` long and numbered from `firsts[i]`.

    A cell holds about that many tokens, by the weights of the queues that last at
    least half as long as it is late.
    """

    starts: np.ndarray
    steps: np.ndarray
    firsts: np.ndarray

    @staticmethod
    def of(weights: dict[int, float], tokens: int) -> Cells:
        """From the summed weights of the queues by the binary logarithm of their end."""
        starts, steps, firsts, number = [], [], [], 0
        edges = sorted({0.0, *(2.0**b for b in weights), *(2.0 ** (b + 1) for b in weights)})
        for start, end in zip(edges, edges[1:]):
            rate = sum(w for b, w in weights.items() if 2.0 ** (b + 1) > start)
            starts.append(start)
            steps.append(tokens / rate)
            firsts.append(number)
            number += int(np.ceil((end - start) / steps[-1])) + 1
        return Cells(np.array(starts), np.array(steps), np.array(firsts, np.int64))

    def at(self, due: np.ndarray) -> np.ndarray:
        """The cell of each time."""
        i = np.searchsorted(self.starts, due, side="right") - 1
        return self.firsts[i] + ((due - self.starts[i]) / self.steps[i]).astype(np.int64)


def due(place, deficit, weight):
    """When the token at a place of a queue is due; later for every further place."""
    return (place + deficit) / weight


def firsts(cells: Cells, low: int, high: int, deficit: float, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """The cells that the places from `low` to before `high` of a queue reach, and the first place in each.

    Times ascend with places, so the first places are searched where there are
    fewer cells than places.
    """
    cell_of = lambda places: cells.at(due(places, deficit, weight))
    a, b = cell_of(np.array([low, high - 1])).tolist()
    if b - a >= (high - low) // 32:
        places = np.arange(low, high)
        found = cell_of(places)
        first = np.append(True, found[1:] != found[:-1])
        return found[first], places[first]
    wanted = np.arange(a + 1, b + 1)
    under, over = np.full(len(wanted), low), np.full(len(wanted), high - 1)
    while (under < over).any():
        middle = (under + over) >> 1
        early = cell_of(middle) < wanted
        under, over = np.where(early, middle + 1, under), np.where(early, over, middle)
    places = np.append(low, under)
    # Of cells without a place only the last stays, the one that the next place is in.
    kept = np.append(places[1:] != places[:-1], True)
    return cell_of(places[kept]), places[kept]


def _runs(cells: Cells):
    """The tokens of each cell, from blocks of places of one queue."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low, high = row["block"] * BLOCK, min((row["block"] + 1) * BLOCK, row["tokens"])
                found, place = firsts(cells, low, high, row["deficit"], row["weight"])
                n = np.diff(np.append(place, high))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found),
                        pa.array([row["source"]] * len(n), pa.string()),
                        pa.array(np.full(len(n), row["weight"])),
                        pa.array(np.full(len(n), row["deficit"])),
                        pa.array(place),
                        pa.array(n.astype(np.int64)),
                    ],
                    names=[x.split()[0] for x in RUNS.split(", ")],
                )

    return of


RUNS = "cell long, source string, weight double, deficit double, place long, n long"
STRETCHES = "source string, block long, place long, n long, sequence_id long"


def cuts(
    weight: np.ndarray, deficit: np.ndarray, place: np.ndarray, n: np.ndarray, before: np.ndarray
) -> Iterator[np.ndarray]:
    """For each number in `before`, how many tokens of each queue's run come first, when that many of all do.

    Runs are in the order of their queues, which decides among tokens due at once.
    """
    if not len(before):
        return
    run = np.repeat(np.arange(len(n)), n)
    start = np.cumsum(n) - n
    times = due((place - start)[run] + np.arange(len(run)), deficit[run], weight[run])
    ordered = np.partition(times, before)
    bounds = np.append(start, len(times)).tolist()
    for count in before.tolist():
        last = ordered[count]
        # Within a run times ascend.
        taken = np.array([np.searchsorted(times[a:b], last) for a, b in zip(bounds, bounds[1:])])
        tied = run[np.flatnonzero(times == last)[: count - int(taken.sum())]]
        yield taken + np.bincount(tied, minlength=len(n))


def _windows(length: int):
    """The window of each stretch of a queue, from runs in the order of cell and source.

    Rows are (part, before, cell, source, weight, deficit, place, n), where `before`
    counts the tokens of all earlier parts.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    def stretches(cell: list[tuple], rank: int) -> Iterator[tuple]:
        weight, deficit = (np.array([r[k] for r in cell]) for k in (4, 5))
        place, n = (np.array([r[k] for r in cell], np.int64) for k in (6, 7))
        total = int(n.sum())
        ends = np.arange((rank // length + 1) * length - rank, total, length)
        edges = [np.zeros(len(n), np.int64), *cuts(weight, deficit, place, n, ends), n]
        for number, (low, high) in enumerate(zip(edges, edges[1:])):
            for i in np.flatnonzero(high > low).tolist():
                start, end = int(place[i] + low[i]), int(place[i] + high[i])
                yield cell[i][3], start // BLOCK, start, end - start, rank // length + number

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = [x.split()[0] for x in STRETCHES.split(", ")], []
        for _, of_part in groupby(rows(batches), lambda r: r[0]):
            rank = None
            for _, of_cell in groupby(of_part, lambda r: r[2]):
                cell = list(of_cell)
                rank = cell[0][1] if rank is None else rank
                held += stretches(cell, rank)
                rank += sum(r[7] for r in cell)
                if len(held) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held)], names=names)
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held)], names=names)

    return of


PLACED = "source string, block long, place long, n long, doc_id long, start long, doc_tokens long, ids binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (source, place, doc_id, n, ids), cut where their queue's blocks end."""
    for batch in _few(batches):
        place, n = (batch[c].to_numpy() for c in ("place", "n"))
        first, last = place // BLOCK, (place + n - 1) // BLOCK
        row = np.repeat(np.arange(len(n)), last - first + 1)
        step = np.arange(len(row)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1)
        block = first[row] + step
        low = np.maximum(block * BLOCK, place[row])
        high = np.minimum((block + 1) * BLOCK, place[row] + n[row])
        start, ids = low - place[row], batch["ids"]
        if len(row) > len(n):
            octets = [ids[r].as_buffer() for r in row.tolist()]
            width = [x.size // m for x, m in zip(octets, n[row].tolist())]
            spans = zip(octets, width, start.tolist(), (high - place[row]).tolist())
            ids = pa.array([memoryview(x)[a * w : b * w] for x, w, a, b in spans], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                batch["source"].take(pa.array(row)), pa.array(block), pa.array(low), pa.array(high - low),
                batch["doc_id"].take(pa.array(row)), pa.array(start), pa.array(n[row]), ids,
            ],
            names=[x.split()[0] for x in PLACED.split(", ")],
        )


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, source string, place long"
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces from the stretches and documents of each block of a queue.

    Rows are (source, block, place, n, sequence_id, doc_id, start, doc_tokens, ids),
    by source and block; a block's stretches have a sequence_id and come first.
    """
    names = [x.split()[0] for x in PIECES.split(", ")]
    types = [pa.int64()] * 6 + [pa.string(), pa.int64()]
    key, froms, windows, held = None, [], [], []
    for batch in _few(batches):
        for source, block, place, n, window, doc_id, start, doc_tokens, ids in zip(
            *(column.to_pylist() for column in batch.columns)
        ):
            if (source, block) != key:
                key, froms, windows = (source, block), [], []
            if window is not None:
                # Stretches of two cells in one window make one piece.
                if not windows or windows[-1] != window:
                    froms.append(place)
                    windows.append(window)
                continue
            data = memoryview(np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4")).cast("B")
            at, i = place, bisect_right(froms, place) - 1
            while at < place + n:
                end = min(froms[i + 1] if i + 1 < len(froms) else place + n, place + n)
                low, high = at - place, end - place
                crc = zlib.crc32(data[4 * low : 4 * high])
                held.append((doc_id, start + low, high - low, crc, doc_tokens, windows[i], source, at))
                at, i = end, i + 1
        if held:
            arrays = [pa.array(x, kind) for x, kind in zip(zip(*held), types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
            held = []


def _queues(sources: DataFrame, weights: dict[str, float] | None) -> DataFrame:
    """(source, tokens) with weight and first deficit."""
    deficit = (F.pmod(F.xxhash64("source"), F.lit(1 << 31)) + 0.5) / (1 << 31)
    if weights is None:
        weight = F.col("tokens").cast("double")
    else:
        given = sources.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in weights.items()], "source string, given double"
        )
        sources = sources.join(given, "source", "left")
        weight = F.coalesce("given", F.lit(float(min(weights.values()))))
    return sources.select("source", "tokens", weight.alias("weight"), deficit.alias("deficit"))


def _stretches(spark: SparkSession, queues: DataFrame, length: int) -> DataFrame:
    """The window of every stretch of every queue, none of them beyond a block.

    The driver receives the summed weight of the queues that end in each octave of
    time.
    """
    octave = F.floor(F.log2(F.col("tokens") / F.col("weight"))).alias("octave")
    ends = queues.groupBy(octave).agg(F.sum("weight").alias("weight")).collect()
    cells = Cells.of({r["octave"]: r["weight"] for r in ends}, CELL * length)
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / BLOCK))
    spread = queues.select("*", F.explode(blocks).alias("block")).repartition(
        spark.sparkContext.defaultParallelism, "source", "block"
    )
    runs = staged(spark, spread.mapInArrow(_runs(cells), RUNS), "runs")
    # All runs of a cell lie in one range.
    ranged = runs.repartitionByRange("cell").withColumn("part", F.spark_partition_id())
    ranged = staged(spark, ranged, "cells")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    before = ranged.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    ordered = (
        ranged.join(before, "part")
        .select("part", "before", *(x.split()[0] for x in RUNS.split(", ")))
        .repartition("part")
        .sortWithinPartitions("part", "cell", "source")
    )
    return ordered.mapInArrow(_windows(length), STRETCHES)


def pack(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    end: int = 2,
    length: int = 4096,
    weights: dict[str, float] | None = None,
    lower: bool = True,
) -> DataFrame:
    """Pieces of all documents' ids, with the sequence and offset each goes to.

    `path` names a vocabulary file; each document's ids are followed by `end`.
    `weights` gives the share of each source in a window, by default its share of
    all tokens; sources without one weigh as much as the lightest that has. Every
    sequence but the last is full. Windows keep to the shares within a few tokens
    for as long as a source has tokens left; then the others share its part. There
    may be any number of sources.
    Columns: doc_id, start (in the document's ids), length, ids_crc32, doc_tokens,
    sequence_id, source, place (in its queue), offset (in the sequence).

    Null and empty texts are packed as `end` alone, a null source is the source
    ''; null ids and repeated rows are packed like any other; an empty table
    gives no pieces; other columns are not looked at, whatever their names. A queue
    follows the order in which its rows are stored. Of tokens due at once the source
    that is first by name goes first. Ids are staged once and shuffled once; texts
    and ids reach Python in batches of bounded bytes.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("source"), "text")
    schema = "doc_id long, source string, part long, before long, n long, ids binary"
    with arrow_batches(spark, BATCH_BYTES):
        held = staged(spark, rows.mapInArrow(_encoded(path, end, lower), schema), "ids")
    parts = staged(
        spark,
        held.groupBy("part", "source").agg(F.sum("n").alias("tokens")),
        "parts",
    )
    sources = parts.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    queues = staged(spark, _queues(sources, weights), "queues")
    stretches = _stretches(spark, queues, length)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "part", "source", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")
    )
    placed = held.join(starts, ["part", "source"]).select(
        "source", (F.col("base") + F.col("before")).alias("place"), "doc_id", "n", "ids"
    )
    both = placed.mapInArrow(_blocks, PLACED).unionByName(stretches, allowMissingColumns=True)
    pieces = (
        both.select(
            "source", "block", "place", "n", "sequence_id", "doc_id", "start", "doc_tokens", "ids"
        )
        .repartition("source", "block")
        .sortWithinPartitions("source", "block", F.col("sequence_id").isNull(), "place")
        .mapInArrow(_pieces, PIECES)
    )
    with arrow_batches(spark, BATCH_BYTES):
        pieces = staged(spark, pieces, "pieces")
    inside = (
        Window.partitionBy("sequence_id")
        .orderBy("source", "place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return pieces.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
