"""Near-copies against all pairs in plain Python."""

from __future__ import annotations

import random

import awkward
import numpy as np

from lossline.llm import near_dup


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def expected(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = min(members) if sets[i] and members else (None if sets[i] else doc_id)
        out.append((doc_id, len(sets[i]), least, least == doc_id))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in near_dup.near_duplicates(docs).collect()), key=str) == expected(rows)


def test_awkward_rows(spark):
    got = near_dup.near_duplicates(awkward.documents(spark)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected([(r[0], r[1]) for r in awkward.rows()])
    assert near_dup.near_duplicates(awkward.empty(spark)).count() == 0


def test_many_near_copies(spark):
    """Copies with few to many changed words: chains of links, loners, and buckets that pivots decide in several rounds."""
    draw = random.Random(9)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(150)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 2, 3, 5])):
            words[draw.randrange(150)] = f"c{i}x{draw.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    # Without a middle: every copy has three changes of its own, so few are linked.
    other = [f"v{draw.randint(0, 10**6)}" for _ in range(150)]
    for i in range(200, 260):
        words = list(other)
        for k in range(2):
            words[(i * 7 + k * 61) % 150] = f"d{i}x{k}"
        rows.append((i, " ".join(words)))
    draw.shuffle(rows)
    check(spark, rows)


def test_signatures():
    draw = np.random.default_rng(1)
    pool = draw.integers(1, 2**63, 3000, dtype=np.uint64)
    sets = [pool[:2000], pool[200:2200], pool[:3], pool[:1], pool[:0], pool[:40], pool[4:44]]
    first = np.cumsum([0, *map(len, sets)])
    signature = near_dup.super_minhash(np.concatenate(sets), first)
    assert np.isinf(signature[4]).all() and np.isfinite(signature[[0, 1, 2, 3, 5, 6]]).all()
    alike = lambda a, b: (signature[a] == signature[b]).mean()
    assert abs(alike(0, 1) - 1800 / 2200) < 0.15 and abs(alike(5, 6) - 36 / 44) < 0.15 and alike(0, 5) < 0.2
    again = near_dup.super_minhash(np.concatenate(sets[::-1]), np.cumsum([0, *map(len, sets[::-1])]))
    assert (again[::-1] == signature).all()


def test_components(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(draw.randint(200, 260), draw.randint(200, 260)) for _ in range(40)]
    found = {r.node: r.label for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        assert found.get(node, node) == min(seen)


def test_one_doc_id_with_several_texts(spark):
    """Linked texts of one doc_id, and two groups that share their smallest doc_id but nothing else."""
    draw = random.Random(8)
    rows = []
    for g in range(6):
        base = [f"g{g}w{draw.randint(0, 10**6)}" for _ in range(150)]
        for i in range(5):
            words = list(base)
            words[20 + 25 * i] = f"g{g}c{i}"
            rows.append((1 if i == 0 else 10 * g + 10 + i, " ".join(words)))
    rows += [(1, rows[0][1].replace("c0", "d0")), rows[3], (1, "nothing like the others at all")]
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in near_dup.near_duplicates(docs).collect()), key=str) == expected(rows)
    found = near_dup.groups(docs).filter("n_shingles > 0").select("component").distinct()
    assert found.count() == 7  # six groups and the one text that is like no other


def test_rows_without_doc_id(spark):
    """They are linked by near copies too, and a chain of links goes through them."""
    base = [f"w{i}" for i in range(150)]
    changed = lambda *places: " ".join("new" + w if i in places else w for i, w in enumerate(base))
    rows = [(7, changed(20, 60)), (None, changed(60, 100)), (8, changed(100, 140)), (None, "alone among all these rows here")]
    rows += [(None, changed(60, 100)), (9, "also on its own here today")]
    assert 100 * len(shingles(rows[0][1]) & shingles(rows[2][1])) < 85 * len(shingles(rows[0][1]) | shingles(rows[2][1]))
    check(spark, rows)
    assert {r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {7, 9, None}
