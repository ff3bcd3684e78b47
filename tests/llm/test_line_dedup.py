"""Line dedup against plain Python, and an index that goes back and forth."""

from __future__ import annotations

from collections import Counter

import awkward
import numpy as np
from pyspark.sql import functions as F

from lossline.llm import line_dedup
from lossline.llm.line_dedup import CuckooFilter, LineIndex, line_key


def expected(rows, threshold):
    keys = [[line_key(x.encode()) for x in (t or "").split("\n")] for _, t in rows]
    counts = Counter(k for some in keys for k in set(some) if k)
    out = []
    for (i, t), some in zip(rows, keys):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, some) if not (k and counts[k] >= threshold)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    found = line_dedup.dedup_lines(docs, threshold=2)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = sorted(((r[0], r[1], r["n_lines"], r["n_dropped"]) for r in found.collect()), key=str)
    assert got == expected([(r[0], r[1]) for r in awkward.rows()], 2)
    assert line_dedup.dedup_lines(awkward.empty(spark)).count() == 0


def test_real_rows(spark, data):
    docs = awkward.sample(spark, data).select("doc_id", "text")
    got = sorted(((r[0], r[1], r[2], r[3]) for r in line_dedup.dedup_lines(docs, threshold=3).collect()), key=str)
    assert got == expected([tuple(r) for r in docs.collect()], 3)


def test_deletion_undoes_insertion(spark):
    one = spark.createDataFrame([(i, "common\nonly %d" % i) for i in range(4)], "doc_id long, text string")
    two = spark.createDataFrame([(i, "Common \nonly 1\nrare") for i in range(10, 13)], "doc_id long, text string")
    index = LineIndex.build(one, threshold=5)
    assert index.hot.count() == 0
    grown = index.insert(two)
    assert grown.hot.count() == 1
    assert {r[0]: r[1] for r in grown.drop_lines(one).select("doc_id", "text").collect()} == {i: "only %d" % i for i in range(4)}
    back = grown.delete(two)
    assert back.hot.count() == 0
    assert sorted(map(tuple, back.counts.select("h1", "h2", "n").collect())) == sorted(map(tuple, index.counts.select("h1", "h2", "n").collect()))
    lines = line_dedup.line_digests(one)
    assert back.suspects(lines).count() == 0 and grown.suspects(lines).count() >= 4


def test_deleting_what_is_not_there(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    index = LineIndex.build(docs)
    try:
        index.delete(docs.withColumn("text", F.lit("b")))
    except ValueError:
        return
    raise AssertionError("no error")


def test_filter():
    draw = np.random.default_rng(2)
    a, b = draw.integers(-(2**62), 2**62, (2, 3000)), draw.integers(-(2**62), 2**62, (2, 3000))
    made = CuckooFilter.sized(100)  # far too small: the rest goes to the spare list
    made.insert(*a)
    assert made.contains(*a).all() and len(made.spare)
    made = CuckooFilter.sized(3000)
    made.insert(*a)
    made.insert(*b)
    made = CuckooFilter.load(made.dump())
    assert made.contains(*a).all() and made.contains(*b).all()
    made.delete(*b)
    assert made.contains(*a).all() and made.contains(*b).mean() < 0.01


def test_rows_count_as_documents(spark):
    """Ten rows of one doc_id, or without one, are ten documents."""
    for doc_id in (5, None):
        rows = [(doc_id, f"shared\nline {i}") for i in range(10)] + [(6, "shared")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = sorted((str(r.doc_id), r.text, r.n_dropped) for r in line_dedup.dedup_lines(docs, 10, 1).collect())
        assert got == sorted([(str(doc_id), f"line {i}", 1) for i in range(10)] + [("6", "", 1)])
