from __future__ import annotations

import hashlib
import random

import numpy as np
from llm.conftest import DOCS, docs_of

from repopulse.llm import rolling, substrings


def removed(docs, window):
    """Kept words of each (id, text) by comparing all windows."""
    words = [(i, (t or "").encode().split()) for i, t in docs]
    owner = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                owner[key] = min(i, owner.get(key, i))
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if owner[tuple(w[k : k + window])] < i:
                    gone |= set(range(k, k + window))
        out.append([x for k, x in enumerate(w) if k not in gone])
    return out


def random_docs(seed, n=60):
    rng = random.Random(seed)
    passages = [[f"p{p}w{rng.randrange(30)}" for _ in range(rng.randrange(5, 40))] for p in range(6)]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(6)):
            words += rng.choice(passages) if rng.random() < 0.5 else [f"u{rng.randrange(3)}" for _ in range(rng.randrange(20))]
        docs.append(" ".join(words))
    return docs + docs[:5]


def test_window_hashes_differ_exactly_if_the_windows_do():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 3, 500).astype(np.uint64) * np.uint64(0x1234567)
    for length in (1, 2, 3, 6, 7, 25, 50):
        found = rolling.windows(words, length)
        exact = [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]
        assert len(found) == len(exact)
        assert len(set(zip(found.tolist(), exact))) == len(set(exact)) == len(set(found.tolist()))
    assert len(rolling.windows(words[:3], 4)) == 0


def test_equals_all_pairs_of_windows(spark):
    for seed, window in ((1, 8), (2, 9), (3, 12)):
        texts = random_docs(seed)
        found = substrings.repeated_passages(spark, docs_of(spark, texts), window).collect()
        want = removed(list(enumerate(texts)), window)
        digest = lambda w: hashlib.sha256(b" ".join(w)).digest()
        assert {r["doc_id"]: (r["n_removed"], bytes(r["kept_digest"])) for r in found} == {
            i: (len(t.split()) - len(w), digest(w)) for i, (t, w) in enumerate(zip(texts, want))
        }
        assert any(r["n_removed"] for r in found)


def test_texts_that_lose_nothing_keep_their_white_space(spark, odd_docs, no_docs):
    found = substrings.without_repeats(spark, odd_docs, 50)
    assert found.columns == odd_docs.columns
    as_rows = lambda df: sorted(map(str, df.collect()))
    assert as_rows(found) == as_rows(odd_docs)
    assert substrings.without_repeats(spark, no_docs).count() == 0


def test_rows_without_id_or_of_one_id_take_nothing_from_each_other(spark, prose):
    other = prose + " and one more"
    rows = [(7, prose), (7, other), (None, prose), (8, prose), (8, prose), (9, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    found = substrings.repeated_passages(spark, docs, 50).collect()
    assert len(found) == len(rows)
    lost = sorted((r["doc_id"] or 0, r["n_removed"]) for r in found)
    n = len(prose.split())
    assert lost == [(0, 0), (7, 0), (7, 0), (8, n), (8, n), (9, 0), (9, 0)]
