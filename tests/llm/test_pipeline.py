"""The pipeline against plain Python, stage by stage on the rows that the stage before kept."""

from __future__ import annotations

import random

import awkward
import numpy as np
import pytest
from test_decontaminate import expected as windows
from test_line_dedup import expected as line_rows
from test_near_dup import expected as groups, shingles

import corpus_pipeline
from lossline.llm import bpe
from lossline.llm.queries import vocabulary_path



@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labelled documents of two invented languages with copies, shared lines, benchmark passages and odd rows."""
    draw = random.Random(6)
    speech = {"aa": "the of and to in that is was for", "bb": "der die und das ist von zu den mit"}
    word = lambda lang: draw.choice(speech[lang].split()) + draw.choice(["", "", "ing" if lang == "aa" else "ung", str(draw.randint(0, 999))])
    text = lambda lang, n=60: " ".join(word(lang) for _ in range(n))
    items = [(i, text("aa", 25)) for i in range(4)]
    rows = []
    for i in range(90):
        lang = draw.choice(["aa", "bb"])
        body = text(lang)
        if i % 6 == 0:
            body = "a common line\n" + body
        if i % 15 == 1:
            body += " " + items[i % 4][1]
        rows.append((i, body, lang, "s", len(body), "other", "c"))
    rows += [(100 + i, rows[i][1].replace("the", "THE"), None, None, None, None, None) for i in range(0, 20, 2)]
    rows += [(200, None, "aa", "s", 0, "", ""), (201, "", None, "s", 0, "", ""), (202, "12 34 !?", "bb", "s", 0, "", ""), (None, text("aa"), None, None, 1, "", "")]
    rows += [rows[3]]
    at = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, other string, c0 string").write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(at / "benchmark.parquet"))
    return str(at)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    state = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = spark.createDataFrame(stage(spark, state, folder).collect(), docs.schema)
        assert state.columns == docs.columns
        kept[name] = [(r.doc_id, r.text) for r in state.collect()]
    raw = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r[0] for r in raw} - {r[0] for r in kept["language"]} == {200, 201, 202}
    assert len(kept["language"]) == len(raw) - 3
    assert sorted(kept["lines"], key=str) == sorted(((i, t) for i, t, _, _ in line_rows(kept["language"], 10)), key=str)
    alone = {i for i, _, _, own in groups(kept["lines"]) if own} | {None}
    assert sorted(kept["near_copies"], key=str) == sorted({r for r in kept["lines"] if r[0] in alone}, key=str)
    assert len(kept["lines"]) > len(set(kept["lines"]))  # one row is there twice
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = {w[0] for w in windows(kept["near_copies"], items) if w[-1]} - {None}
    assert hit and sorted(kept["benchmark"], key=str) == sorted((r for r in kept["near_copies"] if r[0] not in hit), key=str)

    library = bpe.encoder(bpe.vocabulary_source(vocabulary_path())).vocabulary.library
    want = sorted(((i, library.encode(t, add_special_tokens=False).ids) for i, t in kept["benchmark"]), key=str)
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found), key=str) == want
    assert all(r.decoded == library.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False) for r in found)


def test_lengths_follow_the_text(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    shorter = corpus_pipeline.lines(spark, docs, folder)
    assert shorter.filter("n_chars <> length(text)").count() == 0 and shorter.count() == docs.count()


def test_odd_and_empty_tables(spark, folder):
    for docs in (awkward.documents(spark), awkward.empty(spark)):
        state = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            state = stage(spark, state, folder)
            assert state.columns == docs.columns
        assert corpus_pipeline.tokens(spark, state, folder).count() == state.count()


def test_near_copies_from_a_similarity_of_080(spark, folder):
    """Of pairs on both sides of 0.8, and of one beyond 0.85, those from 0.8 on lose a document."""
    rows = []
    for n, changes in enumerate((3, 4, 5)):
        one = [f"p{n}w{i}" for i in range(204)]
        other = list(one)
        for k in range(changes):
            other[20 + 40 * k if k < 4 else 190] = f"p{n}c{k}"
        rows += [(2 * n, " ".join(one)), (2 * n + 1, " ".join(other))]
    sets = [shingles(t) for _, t in rows]
    alike = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    assert alike[0] >= 0.85 and 0.8 < alike[1] < 0.85 and alike[2] < 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_copies(spark, docs, folder)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 4, 5]


def test_near_copies_go_by_row(spark, folder):
    """A doc_id with two texts loses only the one that is a copy; two texts of the smallest doc_id leave one."""
    base = [[f"t{n}w{i}" for i in range(150)] for n in range(4)]
    near = lambda n, i: " ".join([*base[n][:i], "changed", *base[n][i + 1 :]])
    text = lambda n: " ".join(base[n])
    rows = [(1, text(0)), (2, near(0, 40)), (2, text(1)), (3, text(2)), (3, near(2, 30)), (4, near(2, 90)), (5, text(3)), (5, text(3)), (6, near(3, 9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, folder).collect())
    assert [r for r in kept if r[0] != 3] == [(1, text(0)), (2, text(1)), (5, text(3))]
    assert [r for r in kept if r[0] == 3] in ([(3, text(2))], [(3, near(2, 30))])


def test_copies_without_doc_id(spark, folder):
    """One row stays of equal and of near copies, that with a doc_id if there is one; texts without words all stay."""
    base = [[f"t{n}w{i}" for i in range(150)] for n in range(3)]
    near = lambda n, i: " ".join([*base[n][:i], "changed", *base[n][i + 1 :]])
    text = lambda n: " ".join(base[n])
    rows = [(None, text(0))] * 3 + [(None, text(1)), (None, near(1, 50)), (None, text(2)), (None, text(2)), (4, near(2, 70)), (None, "..."), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, folder).collect()]
    group = lambda t: next((n for n in range(3) if t and t.startswith(f"t{n}")), None)
    assert sorted(((i, group(t)) for i, t in kept), key=str) == sorted([(None, 0), (None, 1), (4, 2), (None, None), (None, None), (None, None)], key=str)


def test_no_labels(spark, tmp_path):
    """Without any labelled row the stage keeps every document."""
    docs = spark.createDataFrame([(1, "a text", None), (2, None, None)], "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.language(spark, docs, str(tmp_path)).count() == 2
