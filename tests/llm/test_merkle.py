from __future__ import annotations

import hashlib
import zlib

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from repopulse.llm import merkle
from repopulse.llm.queries import LEAF_FIELDS, op11_merkle_manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(fields):
    texts = [None if f is None else str(f) for f in fields]
    return digest(*("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def tree(nodes, fanout):
    """The levels of a tree, from the leaves to its root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([digest(*now[i : i + fanout]) for i in range(0, len(now), fanout)])
    return levels


def path(levels, at, fanout):
    found = []
    for level in levels[:-1]:
        run = at // fanout * fanout
        found.append(("".join(level[run:at]), "".join(level[at + 1 : run + fanout])))
        at //= fanout
    return found


def plainly(rows, fanout=2):
    """(doc_id, leaf, subroot, root, path) per row (doc_id, source, lang, n_chars, text), sorted."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], leaf_of(row)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    first = lambda x: (x[0] is not None, x[0] or 0, x[1])
    trees = [tree([h for _, h in sorted(groups[lang], key=first)], fanout) for lang in langs]
    top = tree([t[-1][0] for t in trees], fanout)
    found = []
    for at, (lang, levels) in enumerate(zip(langs, trees)):
        above = path(top, at, fanout)
        for place, (key, leaf) in enumerate(sorted(groups[lang], key=first)):
            found.append((key, leaf, levels[-1][0], top[-1][0], path(levels, place, fanout) + above))
    return sorted(found, key=repr)


def manifest(spark, docs, fanout=2):
    leaf = merkle.leaf_hash(*(F.col(c) for c in LEAF_FIELDS))
    rows = merkle.manifest(spark, docs, leaf, carry=["doc_id"], fanout=fanout).collect()
    return sorted(
        ((r["row"]["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(x) for x in r["path"]]) for r in rows),
        key=repr,
    )


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_equals_a_plain_tree(spark, fanout):
    docs = documents(spark).repartition(3)
    rows = [tuple(r) for r in docs.select(*LEAF_FIELDS).collect()]
    assert manifest(spark, docs, fanout) == plainly(rows, fanout)


def test_trees_of_every_small_size(spark):
    rows = [(i, "s", f"l{n}", 1, f"text {i}") for n in range(1, 19) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest(spark, docs) == plainly(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select(*LEAF_FIELDS).collect()]
    found = manifest(spark, odd_docs)
    assert len(found) == 9 and found == plainly(rows)
    assert manifest(spark, no_docs) == []
    one = odd_docs.where("doc_id = 6")
    ((_, leaf, subroot, root, steps),) = manifest(spark, one)
    assert leaf == subroot == root and steps == []


def test_query_finds_the_rows_that_were_tampered_with(spark, sf_dir):
    found = {r["doc_id"]: r for r in op11_merkle_manifest(spark, sf_dir).collect()}
    changed = {i for i in found if zlib.crc32(str(i).encode()) % 7 == 0}
    assert changed and {i for i, r in found.items() if not r["verified"]} == changed
    for key, leaf, subroot, root, steps in plainly([tuple(r) for r in documents(spark).select(*LEAF_FIELDS).collect()]):
        r = found[key]
        assert (r["leaf"], r["subroot"], r["root"]) == (leaf, subroot, root)
        assert r["proof_sha256"] == digest(*(left + right for left, right in steps))


def test_a_null_count_cannot_be_tampered_with(spark, folder):
    rows = [(i, "s", "en", None, f"text {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs.write.parquet(f"{folder}/documents.parquet")
    assert {r["verified"] for r in op11_merkle_manifest(spark, folder).collect()} == {True}


def test_nothing_but_hashes_is_shuffled(spark, sf_dir):
    plan = op11_merkle_manifest(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "text" not in plan
