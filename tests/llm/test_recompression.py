"""Repeated windows against plain Python, with few words and short windows so that much repeats."""

from __future__ import annotations

import random
from collections import Counter

import awkward
import numpy as np
import pytest

from lossline.llm import recompression
from lossline.llm.words import split_words


def expected(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, b" ".join(x for i, x in enumerate(w) if i not in gone).decode(), len(w), len(gone)))
    return sorted(out, key=str)


def check(spark, rows, window):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in recompression.remove_repeats(docs, window).collect()), key=str)
    assert got == expected(rows, window)


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    found = recompression.remove_repeats(docs, 35)
    assert found.columns[:-2] == docs.columns
    got = sorted(((r[0], r[1], r[-2], r[-1]) for r in found.collect()), key=str)
    assert got == expected([(r[0], r[1]) for r in awkward.rows()], 35)
    assert recompression.remove_repeats(awkward.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(spark, seed):
    """From one word (long runs) to few words, with passages copied between and within texts."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range([1, 2, 3, 400][seed])]
    passage = [draw.choice(words) for _ in range(90)]
    rows = []
    for i in range(40):
        text = [draw.choice(words) for _ in range(draw.randint(0, 120))]
        for _ in range(draw.randint(0, 2)):
            a = draw.randint(0, 60)
            at = draw.randint(0, len(text))
            text[at:at] = passage[a : a + draw.randint(1, 40)]
        rows.append((i, " ".join(text)))
    check(spark, rows, [35, 14, 20, 20][seed])


def test_anchors_depend_on_the_window_alone():
    draw = random.Random(5)
    for words in (2, 3, 50):
        passage = [f"w{draw.randrange(words)}" for _ in range(60)]
        a = passage[:50]
        b = [f"x{draw.randrange(5)}" for _ in range(33)] + passage + ["z"] * 7
        found = []
        for text, shift in ((a, 0), (b, 33)):
            of, anchor, _, first, more = recompression.records(split_words([" ".join(text).encode()]), 35)
            each = {int(f) + i - shift: int(n) for n, f, m in zip(anchor, first, more) for i in range(int(m) + 1)}
            found.append(each)
        assert all(found[0][i] == found[1][i] for i in range(16))


def test_words_of_texts():
    texts = [b" a bb\tccc\x0b", b"", b"bb", b"\xc2\xa0x \x1c"]
    words = split_words(texts)
    got = [words.buffer[a:b] for a, b in zip(words.start, words.end)]
    assert got == [w for t in texts for w in t.split()]
    assert np.diff(words.first).tolist() == [len(t.split()) for t in texts]
    assert words.hash[1] == words.hash[3] and len(set(words.hash.tolist())) == len(words.hash) - 1


def test_rows_without_doc_id_are_told_apart(spark, monkeypatch):
    """Many rows without doc_id, some repeating a passage, and ids that are text."""
    draw = random.Random(8)
    passage = [f"p{i}" for i in range(50)]
    rows = [(None, " ".join([f"r{n}w{i}" for i in range(40)] + (passage if n % 50 == 0 else []))) for n in range(300)]
    rows += [(None, rows[0][1]), (None, None)]
    check(spark, rows, 35)
    named = spark.createDataFrame([(f"id{draw.randrange(9)}", t) for _, t in rows], "doc_id string, text string")
    got = Counter((r.text, r.n_removed) for r in recompression.remove_repeats(named, 35).collect())
    assert got == Counter((t, n) for _, t, _, n in expected(rows, 35))


@pytest.mark.parametrize("window", [recompression.LEAST, 11, 200, recompression.MOST])
def test_least_and_longest_windows(spark, window):
    draw = random.Random(window)
    passage = [f"w{draw.randrange(50)}" for _ in range(window + 30)]
    rows = [(i, " ".join([f"w{draw.randrange(50)}" for _ in range(draw.randint(0, 40))] + passage[draw.randint(0, 30) :])) for i in range(6)]
    check(spark, rows, window)


@pytest.mark.parametrize("window", [recompression.LEAST - 1, recompression.MOST + 1])
def test_other_windows_are_refused(spark, window):
    with pytest.raises(ValueError, match="words"):
        recompression.remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), window)
