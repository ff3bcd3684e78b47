"""Counts, slots and mixture of shards."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import awkward

from lossline.llm import shards


def test_law_and_mixture(spark, data):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = shards.interleave(docs, 7).collect()
    assert len(rows) == docs.count()
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    slots, mixture = defaultdict(list), defaultdict(Counter)
    for r in rows:
        slots[r.shard].append(r.slot)
        mixture[r.source][r.shard] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for counts in mixture.values():
        assert max(counts[s] for s in range(7)) - min(counts[s] for s in range(7)) <= 2
    texts = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    assert all(r["size"] == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)


def test_seed_and_repetition(spark):
    docs = awkward.documents(spark)
    one, again, other = (sorted(map(tuple, shards.interleave(docs, 3, seed).collect()), key=str) for seed in (0, 0, 5))
    assert one == again and one != other and len(one) == len(awkward.rows())
    assert sorted(Counter(r[5] for r in one).values())[-1] - sorted(Counter(r[5] for r in one).values())[0] <= 1
    assert sorted(str(r[1]) for r in one) == sorted(str(r[3]) for r in awkward.rows())


def test_few_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert {(r.shard, r.slot) for r in shards.interleave(docs, 5).collect()} == {(0, 0), (2, 0)}
    assert shards.interleave(awkward.empty(spark), 5).count() == 0


def test_hot_source_and_hot_text(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"t{i}", "big" if i % 4 else f"s{i % 3}") for i in range(1000)]
    found = shards.interleave(spark.createDataFrame(rows, "doc_id long, text string, source string"), 8).collect()
    assert set(Counter(r.shard for r in found).values()) == {125}
    for source in ("big", "s0", "s1", "s2"):
        counts = Counter(r.shard for r in found if r.source == source)
        assert max(counts.values()) - min(counts.values()) <= 2
