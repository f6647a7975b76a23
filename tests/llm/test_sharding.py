from __future__ import annotations

import zlib

import pytest
from conftest import SF_DIR
from llm.conftest import docs_of

from repopulse.llm import sharding


def check(rows, count):
    """Slots without gaps, shards in order, bytes within half a document at either end."""
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    for own in by_shard.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    target = sum(r["size"] for r in rows) / count
    most = max((r["size"] for r in rows), default=0)
    for s in range(count):
        assert abs(sum(r["size"] for r in by_shard.get(s, [])) - target) <= most
    return by_shard


@pytest.mark.parametrize("count", [1, 7, 24])
def test_shards_are_contiguous_and_balanced(spark, count):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5)
    rows = sharding.shards(spark, docs, count).collect()
    by_shard = check(rows, count)
    assert sum(map(len, by_shard.values())) == docs.count()
    in_order = [r["row"]["doc_id"] for s in sorted(by_shard) for r in sorted(by_shard[s], key=lambda r: r["slot"])]
    assert in_order == sorted(in_order)
    for r in rows:
        text = r["row"]["text"].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))


def test_one_repeated_row_is_spread_over_the_shards(spark):
    docs = docs_of(spark, ["same text"]).crossJoin(spark.range(400).drop("id"))
    by_shard = check(sharding.shards(spark, docs, 8).collect(), 8)
    assert {s: len(own) for s, own in by_shard.items()} == {s: 50 for s in range(8)}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = sharding.shards(spark, odd_docs, 3).collect()
    assert len(rows) == 9
    check(rows, 3)
    assert sorted(r["size"] for r in rows)[0] == 8
    assert sharding.shards(spark, no_docs, 3).count() == 0


def test_written_shards_hold_all_rows(spark, odd_docs, folder):
    sharding.write_shards(spark, odd_docs, folder, 3)
    found = spark.read.parquet(folder)
    assert found.count() == 9 and set(found.columns) == {"document", "slot", "shard"}
    assert found.select("document.*").columns == odd_docs.columns
