"""Benchmark windows against plain Python."""

from __future__ import annotations

import random
import re

import awkward

from lossline.llm import decontaminate

SPLIT = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return [w for w in SPLIT.split((text or "").encode().lower()) if w]


def expected(rows, items, window=10):
    wanted = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wanted.setdefault(tuple(w[i : i + window]), set()).add(item)
    sizes = {len(k) for k in wanted}
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[tuple(w[i : i + n])]
        out.append((doc_id, len(w), len(hit), len(found), sorted(map(str, found)), bool(hit)))
    return sorted(out, key=str)


def check(spark, rows, items, window=10):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.decontaminate(docs, bench, window)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows, items, window)


def test_random_texts(spark):
    draw = random.Random(3)
    vocabulary = ["The", "cat", "SAT", "été", "Σας", "K2", "don't", "a_b", "İx"] + [f"w{i}" for i in range(12)]
    text = lambda n: draw.choice([" ", ", ", "\n"]).join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, text(draw.choice([1, 2, 3, 5, 8, 20, 30]))) for i in range(25)] + [(99, None), (98, ""), (97, "?!"), (5, text(12)), (0, text(40))]
    rows = []
    for i in range(150):
        body = text(draw.randint(0, 40))
        if i % 3 == 0:
            body += " " + (draw.choice(items)[1] or "").swapcase() + " " + text(5)
        rows.append((i, body))
    check(spark, rows, items, window=4)
    check(spark, rows, items)


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    rows = [(r[0], r[1]) for r in awkward.rows()]
    items = [(1, rows[0][1]), (2, "Lorem ipsum DOLOR"), (3, "nothing of this kind")]
    bench = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, TEXT string, doc_id int")
    found = decontaminate.decontaminate(docs, bench).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected(rows, items)
    assert any(r.doc_id is None and r.contaminated for r in found)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((str(r[0]) for r in kept.collect())) == sorted(str(w[0]) for w in expected(rows, items) if not w[-1])
    assert decontaminate.decontaminate(awkward.empty(spark), bench).count() == 0
    nothing = decontaminate.decontaminate(docs, bench.limit(0))
    assert nothing.count() == len(rows) and nothing.filter("contaminated OR n_hit > 0").count() == 0


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = decontaminate.decontaminate(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def test_clean_judges_rows_without_doc_id(spark):
    passage = " ".join(f"b{i}" for i in range(10))
    docs = spark.createDataFrame(
        [(None, f"x {passage} y"), (None, f"x {passage} y"), (None, "clean"), (1, passage), (2, "clean"), (None, None), (None, f"{passage} z")],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = sorted((tuple(r) for r in decontaminate.clean(docs, bench).collect()), key=str)
    assert kept == sorted([(None, "clean"), (2, "clean"), (None, None)], key=str)


def test_rows_of_one_doc_id(spark):
    """Each row has the hits of its own text, never more than its words; equal rows have the same."""
    passage = " ".join(f"b{i}" for i in range(10))
    rows = [(7, "three short words"), (7, f"x {passage} y"), (7, f"x {passage} y"), (None, passage), (None, "a b"), (8, None)]
    check(spark, rows, [(1, passage)])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert sorted((tuple(r) for r in decontaminate.clean(docs, bench).collect()), key=str) == sorted(
        [(7, "three short words"), (None, "a b"), (8, None)], key=str
    )
