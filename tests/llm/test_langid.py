from __future__ import annotations

import math
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from llm.conftest import docs_of

from repopulse.llm import langid

PIECES = [b" a", b"ab", b"b", b" ab", b"abb", b"a"]


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def segmentations(word, pieces):
    """All lists of piece numbers that make up the word."""
    if not word:
        return [[]]
    return [
        [i, *rest] for i, p in enumerate(pieces) if word.startswith(p) for rest in segmentations(word[len(p) :], pieces)
    ]


def test_forward_sums_all_segmentations_and_expectations_weigh_them():
    trie = langid.make_trie(PIECES)
    single = [bytes([c]) for c in (32, *range(97, 123), *range(128, 256))]
    pieces = list(dict.fromkeys([*PIECES, *single]))
    shares = np.random.default_rng(0).random((trie.pieces, 2))
    words = [b"abb", b"a", b"bbabab", b"xyz", "é".encode(), b""]
    found = np.exp(langid.log_probabilities(trie, shares, words))
    times = np.arange(1, len(words) + 1)
    counts = np.zeros(trie.pieces)
    for k, word in enumerate(words):
        ways = segmentations(b" " + word, pieces)
        odds = np.array([shares[w].prod(axis=0) for w in ways])
        assert np.allclose(found[k], odds.sum(axis=0))
        for way, p in zip(ways, odds[:, 0] / odds[:, 0].sum()):
            np.add.at(counts, way, p * times[k])
    assert np.allclose(langid.expected_counts(trie, shares[:, 0], words, times), counts)


def test_long_words_are_whole():
    word = "ab" * 100
    assert langid.word_pieces(f"1{word.upper()}2 É") == [word.encode(), "é".encode()]
    assert langid.word_pieces("中" * 500) == [("中" * 500).encode()]


@pytest.mark.parametrize("part", [1 << 14, 7])
def test_long_words_equal_the_sum_over_all_segmentations(monkeypatch, part):
    """Against sums of exact fractions, which neither overflow nor underflow."""
    monkeypatch.setattr(langid, "PART", part)
    pieces = [b" a", b"ab", b"b", b" ab", b"abb", b"a", "中".encode(), "中文".encode(), "文".encode()]
    trie = langid.make_trie(pieces)
    pieces = list(dict.fromkeys([*pieces, *(bytes([c]) for c in (32, *range(97, 123), *range(128, 256)))]))
    shares = np.random.default_rng(0).random((trie.pieces, 2)) / 1000
    words = [b"abbab" * 30, ("中文" * 125 + "文中" * 125).encode(), b"x" * 33]
    found = langid.log_probabilities(trie, shares, words)
    for k, word in enumerate(words):
        octets = b" " + word
        arcs = [
            (i, i + len(p), n) for i in range(len(octets)) for n, p in enumerate(pieces) if octets.startswith(p, i)
        ]
        for column in range(2):
            share = [Fraction(float(x)) for x in shares[:, column]]
            forward, backward = ([Fraction(0)] * (len(octets) + 1) for _ in range(2))
            forward[0] = backward[-1] = Fraction(1)
            for a, b, n in arcs:
                forward[b] += forward[a] * share[n]
            for a, b, n in reversed(arcs):
                backward[a] += backward[b] * share[n]
            whole = forward[-1]
            log = math.log(whole.numerator) - math.log(whole.denominator)
            assert found[k][column] == pytest.approx(log, rel=1e-9)
            if column == 0:
                wanted = np.zeros(trie.pieces)
                for a, b, n in arcs:
                    wanted[n] += float(3 * forward[a] * share[n] * backward[b] / whole)
                counts = langid.expected_counts(trie, shares[:, 0], [word], np.array([3]))
                assert np.allclose(counts, wanted, rtol=1e-8)


def test_three_hundred_languages_can_all_be_predicted(spark, path):
    """Each has words of its own; with blocks of any size the same is found."""
    letters = "bcdfghjklmnpqrstvwxz"
    name = lambda k: f"l{k:03d}"
    word = lambda k, j: f"{letters[k % 20]}{letters[k // 20]}{'aeiou'[j % 5]}{letters[k % 20]}{letters[(k + j) % 20]}"
    rows = [
        (300 * c + k, " ".join(word(k, j) for j in range(12)), name(k)) for k in range(300) for c in range(3)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = langid.identify(spark, docs, path, rounds=2).collect()
    learned = {r["row"]["lang"] for r in found if not r["held_out"]}
    assert len(learned) > 280
    right = [r["lang_pred"] == r["row"]["lang"] for r in found if r["row"]["lang"] in learned]
    assert np.mean(right) > 0.9
    assert len({r["lang_pred"] for r in found}) > 270


def test_blocks_of_languages_change_nothing(spark, path, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    predicted = lambda: {
        r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(spark, docs, path).collect()
    }
    whole = predicted()
    monkeypatch.setattr(langid, "LANGUAGE_BLOCK", 1)
    parted = predicted()
    assert {k: v[0] for k, v in whole.items()} == {k: v[0] for k, v in parted.items()}
    assert all(abs(v[1] - parted[k][1]) < 1e-9 for k, v in whole.items())


def test_text_without_spaces(spark, path):
    rows = [(i, "中文字" * (150 + i) if i % 2 else "ひらがな" * (120 + i), "zh" if i % 2 else "ja") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.identify(spark, docs, path, rounds=1).collect()
    assert all(r["lang_pred"] == r["row"]["lang"] for r in found)


def test_held_out_accuracy(spark, path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = langid.identify(spark, docs, path).collect()
    assert len(found) == docs.count()
    out = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["row"]["doc_id"]).encode()) % 5 == 0) for r in found)
    assert np.mean([r["lang_pred"] == r["row"]["lang"] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_held_out_rows_and_ids_teach_nothing(spark, path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = langid.held_out(docs["doc_id"])
    wrong = docs.withColumn("lang", langid.F.when(out, "xx").otherwise(docs["lang"]))
    predicted = lambda df: {
        r["row"]["doc_id"]: r["lang_pred"] for r in langid.identify(spark, df, path).collect()
    }
    assert predicted(wrong) == predicted(docs)


def test_odd_rows(spark, odd_docs, no_docs, path):
    found = langid.identify(spark, odd_docs, path).collect()
    assert len(found) == 9
    und = sorted(r["row"]["doc_id"] or 0 for r in found if r["lang_pred"] == "und")
    assert und == [0, 2, 3, 4]
    assert langid.identify(spark, no_docs, path).count() == 0
    unlabelled = docs_of(spark, ["some text", None]).withColumn("lang", langid.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(spark, unlabelled, path).collect()} == {"und"}
