from __future__ import annotations

import random
import re

import xxhash
from llm.conftest import docs_of

from repopulse.llm import simhash
from repopulse.llm.components import connected_components


def plain_print(text, k=3):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(nodes, near):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {n: top(n) for n in nodes}


def unsigned(n):
    return n % (1 << 64)


def test_fingerprints_equal_those_of_a_plain_program(spark):
    texts = ["A b C d", "a B c D e f", "one", "one two", "", None, " \t", "ÄÖ ä ö ü", "x " * 40_000]
    found = simhash.near_duplicates(spark, docs_of(spark, texts)).collect()
    assert {r["doc_id"]: unsigned(r["print"]) for r in found} == {i: plain_print(t) for i, t in enumerate(texts)}


def test_links_are_all_pairs_within_the_distance(spark):
    rng = random.Random(1)
    prints = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(60):
            x = base
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints |= {0, 1, 3, (1 << 64) - 1, 1 << 63}
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    for most in (1, 2, 3):
        found = {(r["u"], r["v"]) for r in simhash.links(spark, frame, most).collect()}
        want = {(a, b) for a in signed for b in signed if a < b and unsigned(a ^ b).bit_count() <= most}
        assert found == want
    assert simhash.links(spark, frame, 0).count() == 0


def test_components_of_random_graphs_and_long_paths(spark):
    rng = random.Random(2)
    edges = {(rng.randrange(300), rng.randrange(300)) for _ in range(170)}
    edges |= {(1000 + i, 1001 + i) for i in range(64)} | {(2000, 2001 + i) for i in range(50)} | {(5, 5)}
    found = connected_components(spark, spark.createDataFrame(list(edges), "u long, v long"))
    named = {n for e in edges if e[0] != e[1] for n in e}
    pairs = {tuple(sorted(e)) for e in edges}
    want = groups_of(sorted(named), lambda a, b: (a, b) in pairs)
    assert {r["node"]: r["root"] for r in found.collect()} == want


def test_odd_rows(spark, odd_docs, no_docs):
    found = simhash.near_duplicates(spark, odd_docs).collect()
    assert len(found) == 9
    # Null and empty texts are one group; the texts without id follow a row that has one.
    assert {r["component_id"] for r in found if r["print"] == 0} == {2}
    assert {r["component_id"] for r in found if r["doc_id"] == 1 or r["print"] == found[0]["print"]}
    kept = simhash.keep_one(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5, 6]
    assert simhash.near_duplicates(spark, no_docs).count() == 0
    assert simhash.keep_one(spark, no_docs).count() == 0


def test_groups_are_those_of_all_pairs(spark):
    rng = random.Random(3)
    base = [f"word{i}" for i in range(400)]
    texts = []
    for copy in range(40):
        words = list(base)
        for _ in range(copy % 4):
            words[rng.randrange(400)] = f"new{copy}"
        texts.append(" ".join(words))
    texts += [" ".join(rng.choice(base) for _ in range(50)) for _ in range(20)]
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(spark, docs_of(spark, texts)).collect()}
    prints = [plain_print(t) for t in texts]
    want = groups_of(range(len(texts)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert found == want
