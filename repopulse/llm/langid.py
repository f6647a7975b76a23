"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The
probability of a word is the sum over all ways to cut it into pieces, found by a
forward pass over its octets; a text's is the product over its words. The
probabilities are fitted by expectation maximisation, whose expected counts come
from the forward and backward passes over the words of a bounded sample.

Short words pass through the lattice side by side. Long ones, such as all the text
of a script without spaces, pass through it octet by octet, in parts and with scaled
sums, so that any length takes the same memory and no segmentation is left out.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.session import staged

#: Numbers that one task remembers of short words before it starts anew.
REMEMBERED = 10_000_000
#: Numbers of the lattice of short words that pass through it together.
TOGETHER = 4_000_000
#: Octets of a short word.
SHORT = 32
#: First octets of a long word whose pieces are looked up at a time.
PART = 1 << 14
#: Octets after which the sums of a long word are scaled.
SCALED = 16
#: Languages that are fitted and scored together; any number of such blocks follow each other.
LANGUAGE_BLOCK = 64

# Octets of words stay: a-z and all of non-ASCII characters; all others separate words.
_TABLE = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def word_pieces(text: str | None) -> list[bytes]:
    """Runs of letters of the lower-case text."""
    return (text or "").lower().encode().translate(_TABLE).split()


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass
class Trie:
    """All pieces as a table of transitions; `piece` is -1 where none ends."""

    next: np.ndarray
    piece: np.ndarray
    symbols: np.ndarray
    longest: int

    @property
    def pieces(self) -> int:
        return int(self.piece.max()) + 1


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a vocabulary of base64 lines that can occur in words, which start with a space."""
    with open(path, "rb") as lines:
        found = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    rest = {c for c in range(256) if chr(c).islower() and c < 128 or c >= 128}
    return [p for p in found if p and set(p[1:]) <= rest and p[0] in rest | {32}]


def make_trie(pieces: list[bytes]) -> Trie:
    """Single octets that the vocabulary lacks are added, so every word has a segmentation."""
    single = [bytes([c]) for c in (32, *range(97, 123), *range(128, 256))]
    pieces = list(dict.fromkeys([*pieces, *single]))
    used = sorted({c for p in pieces for c in p})
    symbols = np.zeros(256, np.int64)
    symbols[used] = np.arange(len(used))
    nodes: dict[bytes, int] = {b"": 0}
    for p in pieces:
        for i in range(1, len(p) + 1):
            nodes.setdefault(p[:i], len(nodes))
    follow = np.full((len(nodes), len(used)), -1, np.int32)
    piece = np.full(len(nodes), -1, np.int32)
    for prefix, node in nodes.items():
        if prefix:
            follow[nodes[prefix[:-1]], symbols[prefix[-1]]] = node
    for i, p in enumerate(pieces):
        piece[nodes[p]] = i
    return Trie(follow, piece, symbols, max(map(len, pieces)))


def _matrix(trie: Trie, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of each word behind a space, and lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    width = int(lengths.max())
    padded = b"".join((b" " + w).ljust(width) for w in words)
    return trie.symbols[np.frombuffer(padded, np.uint8)].reshape(len(words), width), lengths


def _lattice(trie: Trie, symbols: np.ndarray, lengths: np.ndarray) -> Iterator[tuple]:
    """(from, to, words, pieces) of all pieces in all words, by their first octet."""
    for start in range(symbols.shape[1]):
        rows = np.flatnonzero(lengths > start)
        nodes = np.zeros(len(rows), np.int64)
        for end in range(start + 1, symbols.shape[1] + 1):
            going = lengths[rows] >= end
            rows, nodes = rows[going], nodes[going]
            nodes = trie.next[nodes, symbols[rows, end - 1]]
            rows, nodes = rows[nodes >= 0], nodes[nodes >= 0]
            if not len(rows):
                break
            found = trie.piece[nodes]
            yield start, end, rows[found >= 0], found[found >= 0]


def _batches(words: list[bytes], languages: int) -> Iterator[range]:
    """Ranges of short words whose lattices fit in memory together."""
    together = max(100, TOGETHER // ((SHORT + 2) * max(languages, 1)))
    for i in range(0, len(words), together):
        yield range(i, min(i + together, len(words)))


def _parts(trie: Trie, symbols: np.ndarray, backwards: bool = False) -> Iterator[tuple]:
    """(first, starts, ends, pieces) of all pieces in one long word, by parts of first octets.

    Within a part the pieces are in the order of their first octet.
    """
    firsts = range(0, len(symbols), PART)
    for first in reversed(firsts) if backwards else firsts:
        at = np.arange(first, min(first + PART, len(symbols)))
        nodes, found = np.zeros(len(at), np.int64), []
        step = 0
        while len(at):
            nodes = trie.next[nodes, symbols[at + step]]
            at, nodes = at[nodes >= 0], nodes[nodes >= 0]
            step += 1
            piece = trie.piece[nodes]
            found.append((at[piece >= 0], np.full((piece >= 0).sum(), step), piece[piece >= 0]))
            going = at + step < len(symbols)
            at, nodes = at[going], nodes[going]
        starts, steps, pieces = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(starts, kind="stable")
        yield first, starts[order], (starts + steps)[order], pieces[order]


def _bounds(starts: np.ndarray, first: int, count: int) -> list[int]:
    return np.searchsorted(starts, np.arange(first, first + count + 1)).tolist()


def _symbols(trie: Trie, word: bytes) -> np.ndarray:
    return trie.symbols[np.frombuffer(b" " + word, np.uint8)]


def _long_forward(trie: Trie, shares: np.ndarray, symbols: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Logarithm of a long word's probability per language.

    Sums are held for the octets that pieces can reach, divided by their largest
    every few octets. `keep` receives the sums of every octet with their logarithmic
    scale, for the backward pass.
    """
    scale = np.zeros(shares.shape[1])
    ahead = np.ones((1, shares.shape[1]))
    for first, starts, ends, pieces in _parts(trie, symbols):
        count = min(PART, len(symbols) - first)
        reach = max(int(ends.max()) - first, count) + 1
        sums = np.zeros((max(reach, len(ahead)), shares.shape[1]))
        sums[: len(ahead)] = ahead
        bounds = _bounds(starts, first, count)
        arcs = shares[pieces]
        ends = ends - first
        for at in range(count):
            if at % SCALED == 0:
                reached = sums[at : at + trie.longest]
                largest = reached.max(axis=0)
                reached /= largest
                scale += np.log(largest)
            if keep is not None:
                keep.append((sums[at].copy(), scale.copy()))
            a, b = bounds[at], bounds[at + 1]
            # Pieces from one octet end at different ones.
            sums[ends[a:b]] += sums[at] * arcs[a:b]
        ahead = sums[count:]
    return np.log(ahead[0]) + scale


def _long_counts(trie: Trie, share: np.ndarray, word: bytes, times: float, counts: np.ndarray) -> None:
    """Adds the expected number of each piece in a long word, for one language."""
    symbols, kept = _symbols(trie, word), []
    whole = float(_long_forward(trie, share[:, None], symbols, kept)[0])
    forward = np.array([x[0][0] for x in kept])
    scales = np.array([x[1][0] for x in kept])
    scale, behind, base = 0.0, np.ones(1), len(symbols)
    for first, starts, ends, pieces in _parts(trie, symbols, backwards=True):
        count = min(PART, len(symbols) - first)
        sums = np.zeros(base - first + len(behind))
        sums[base - first : base - first + len(behind)] = behind
        bounds = _bounds(starts, first, count)
        arcs = share[pieces]
        for at in range(count - 1, -1, -1):
            a, b = bounds[at], bounds[at + 1]
            part = arcs[a:b] * sums[ends[a:b] - first]
            sums[at] = part.sum()
            weight = forward[first + at] * np.exp(scales[first + at] + scale - whole)
            counts[pieces[a:b]] += times * weight * part
            if at % SCALED == 0:
                reached = sums[at : at + trie.longest]
                largest = reached.max()
                reached /= largest
                scale += np.log(largest)
        behind, base = sums[: trie.longest], first


def log_probabilities(trie: Trie, shares: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Logarithm of each word's probability per language; `shares` is pieces x languages."""
    found = np.empty((len(words), shares.shape[1]))
    long = [i for i, w in enumerate(words) if len(w) > SHORT]
    for i in long:
        found[i] = _long_forward(trie, shares, _symbols(trie, words[i]))
    short = [i for i, w in enumerate(words) if len(w) <= SHORT]
    for batch in _batches(short, shares.shape[1]):
        own = [short[i] for i in batch]
        symbols, lengths = _matrix(trie, [words[i] for i in own])
        forward = np.zeros((len(lengths), symbols.shape[1] + 1, shares.shape[1]))
        forward[:, 0] = 1
        for start, end, rows, pieces in _lattice(trie, symbols, lengths):
            forward[rows, end] += forward[rows, start] * shares[pieces]
        found[own] = np.log(forward[np.arange(len(lengths)), lengths])
    return found


def expected_counts(trie: Trie, share: np.ndarray, words: list[bytes], times: np.ndarray) -> np.ndarray:
    """Expected number of each piece in the words, over all segmentations, for one language."""
    counts = np.zeros(len(share))
    short = [i for i, w in enumerate(words) if len(w) <= SHORT]
    for i, word in enumerate(words):
        if len(word) > SHORT:
            _long_counts(trie, share, word, float(times[i]), counts)
    for batch in _batches(short, 8):
        own = [short[i] for i in batch]
        symbols, lengths = _matrix(trie, [words[i] for i in own])
        weight = times[own].astype(float)
        forward = np.zeros((len(lengths), symbols.shape[1] + 1))
        forward[:, 0] = 1
        arcs = list(_lattice(trie, symbols, lengths))
        for start, end, rows, pieces in arcs:
            forward[rows, end] += forward[rows, start] * share[pieces]
        backward = np.zeros_like(forward)
        whole = (np.arange(len(lengths)), lengths)
        backward[whole] = 1
        weight /= forward[whole]
        for start, end, rows, pieces in reversed(arcs):
            part = share[pieces] * backward[rows, end]
            backward[rows, start] += part
            np.add.at(counts, pieces, part * forward[rows, start] * weight[rows])
    return counts


@dataclass
class Block:
    """Some languages with their log priors; their piece probabilities are a broadcast."""

    languages: list[str]
    prior: np.ndarray
    shares: object


@dataclass
class Model:
    """All languages, in blocks by name; `trie` is a broadcast."""

    blocks: list[Block]
    trie: object

    @property
    def languages(self) -> list[str]:
        return [x for block in self.blocks for x in block.languages]


def _sample(labelled: DataFrame, sample: int, counts: dict[str, int]) -> DataFrame:
    """About `sample` documents of each language counted, by a hash of id and text."""
    limits = F.create_map(
        *(F.lit(x) for k, n in counts.items() for x in (k, min(1 << 30, (sample << 30) // n)))
    )
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    own = labelled.where(F.col("lang").isin(list(counts)))
    return own.where(place < F.element_at(limits, F.col("lang")))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from collections import Counter

    for batch in batches:
        found: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            found.setdefault(lang.as_py(), Counter()).update(word_pieces(text.as_py()))
        for lang, counter in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(counter), pa.string()),
                    pa.array(list(counter), pa.binary()),
                    pa.array(list(counter.values()), pa.int64()),
                ],
                names=["lang", "word", "times"],
            )


def _expectation(trie_handle, languages: list[str], shares_handle):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, shares = Trie(**trie_handle.value), shares_handle.value
        total = np.zeros_like(shares)
        for batch in batches:
            langs, words = batch["lang"].to_pylist(), batch["word"].to_pylist()
            times = batch["times"].to_numpy()
            for k, lang in enumerate(languages):
                own = [i for i, x in enumerate(langs) if x == lang]
                if own:
                    total[:, k] += expected_counts(trie, shares[:, k], [words[i] for i in own], times[own])
        pieces, columns = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns, pa.int64()), pa.array(pieces, pa.int64()), pa.array(total[pieces, columns])],
            names=["language", "piece", "expected"],
        )

    return of


def fit(
    spark: SparkSession,
    labelled: DataFrame,
    path: str,
    sample: int = 2000,
    rounds: int = 4,
    smoothing: float = 0.1,
) -> Model:
    """Piece probabilities of every non-null `lang` of the labelled rows (doc_id, text, lang).

    `path` names the vocabulary. About `sample` rows of each language are used, all
    if it has fewer; the prior counts all rows. A language is fitted by its own rows
    alone, so any number of languages follow each other in blocks. Expectations are
    computed and summed by Spark; the driver receives one count per language and, per
    block and round, at most one number per language of the block and piece of the
    vocabulary, and broadcasts as many.
    """
    trie = make_trie(read_pieces(path))
    handle = spark.sparkContext.broadcast(vars(trie))
    labelled = labelled.where("lang is not null")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    names, every = sorted(counts), sum(counts.values())
    blocks = []
    for i in range(0, len(names), LANGUAGE_BLOCK):
        languages = names[i : i + LANGUAGE_BLOCK]
        chosen = _sample(labelled, sample, {x: counts[x] for x in languages})
        words = chosen.select("lang", "text").mapInArrow(_word_counts, "lang string, word binary, times long")
        words = staged(spark, words.groupBy("lang", "word").agg(F.sum("times").alias("times")), "words")
        words = words.repartition(spark.sparkContext.defaultParallelism)
        shares = spark.sparkContext.broadcast(np.full((trie.pieces, len(languages)), 1 / trie.pieces))
        for _ in range(rounds):
            found = (
                words.mapInArrow(
                    _expectation(handle, languages, shares), "language long, piece long, expected double"
                )
                .groupBy("language", "piece")
                .agg(F.sum("expected").alias("expected"))
                .toArrow()
            )
            total = np.full((trie.pieces, len(languages)), smoothing)
            total[found["piece"].to_numpy(), found["language"].to_numpy()] += found["expected"].to_numpy()
            shares.unpersist()
            shares = spark.sparkContext.broadcast(total / total.sum(axis=0))
        prior = np.log(np.array([counts[x] for x in languages], float) / every)
        blocks.append(Block(languages, prior, shares))
    return Model(blocks, handle)


def _best_of_block(block: Block, trie_handle, text: Column) -> Column:
    """Struct of the block's most probable language, its log probability, and that of all of them.

    All null for null and for a text without any letter.
    """
    languages, prior, handle = block.languages, block.prior, block.shares

    @F.arrow_udf("lang string, best double, total double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie, shares = Trie(**trie_handle.value), handle.value
        known: dict[bytes, int] = {}
        table = np.empty((0, len(languages)))

        def learn(words: set[bytes]) -> None:
            nonlocal table
            if (len(known) + len(words)) * len(languages) > REMEMBERED:
                known.clear()
                table = table[:0]
            new = [w for w in words if w not in known]
            known.update(zip(new, range(len(known), len(known) + len(new))))
            table = np.concatenate((table, log_probabilities(trie, shares, new)))

        def judged(held: list[list[bytes] | None]) -> Iterator[tuple]:
            learn({w for words in held if words for w in words if len(w) <= SHORT})
            for words in held:
                if words is None:
                    yield None, None, None
                    continue
                at = [known[w] for w in words if len(w) <= SHORT]
                logs = prior + table[np.array(at, np.int64)].sum(axis=0)
                # Long words hardly come twice, so they are not remembered.
                for word in words:
                    if len(word) > SHORT:
                        logs = logs + _long_forward(trie, shares, _symbols(trie, word))
                best = int(logs.argmax())
                yield languages[best], float(logs[best]), float(logs[best] + np.log(np.exp(logs - logs[best]).sum()))

        for batch in batches:
            found, held, size = [], [], 0
            for text in batch:
                value = text.as_py()
                held.append(word_pieces(value) if has_letter(value) else None)
                size += len(value or "")
                if size > 4 << 20:
                    found += judged(held)
                    held, size = [], 0
            found += judged(held)
            columns = zip(*found) if found else ((), (), ())
            kinds = (pa.string(), pa.float64(), pa.float64())
            yield pa.StructArray.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds)], names=["lang", "best", "total"]
            )

    return of(text)


def predict(found: DataFrame, model: Model, text: str, to: str = "found") -> DataFrame:
    """Rows with the struct `to`: the most probable language of a text and its posterior probability.

    `und` with score 0 for null, for a text without any letter, and if the model
    has no language. Of equally probable languages the first by name. Every block of
    languages scores the whole text; the best of all is compared with their sum.
    """
    if not model.blocks:
        return found.withColumn(to, F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score")))
    names = [f"_{to}_{i}" for i in range(len(model.blocks))]
    scored = found.withColumns(
        {n: _best_of_block(b, model.trie, F.col(text)) for n, b in zip(names, model.blocks)}
    )
    best = F.col(names[0])
    for n in names[1:]:
        best = F.when(F.col(n)["best"] > best["best"], F.col(n)).otherwise(best)
    most = F.greatest(*(F.col(n)["total"] for n in names)) if len(names) > 1 else F.col(names[0])["total"]
    total = most + F.log(sum((F.exp(F.col(n)["total"] - most) for n in names[1:]), F.exp(F.col(names[0])["total"] - most)))
    return scored.withColumn(
        to,
        F.struct(
            F.coalesce(best["lang"], F.lit("und")).alias("lang_pred"),
            F.coalesce(F.least(F.exp(best["best"] - total), F.lit(1.0)), F.lit(0.0)).alias("score"),
        ),
    ).drop(*names)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the rows that no model learns from: CRC-32 of the id as text, 0 modulo `folds`."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def identify(spark: SparkSession, docs: DataFrame, path: str, **options) -> DataFrame:
    """All columns of `docs` in the struct `row`, with held_out, lang_pred and score.

    The model is fitted on the rows that are not held out. A null id counts as the
    empty text, and null texts have no words; repeated rows are predicted alike;
    an empty table gives none.
    """
    out = held_out(F.col("doc_id"))
    model = fit(spark, docs.select("doc_id", "text", "lang").where(~out), path, **options)
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), out.alias("held_out"), "text"
    )
    return predict(rows, model, "text").select("row", "held_out", "found.*")
