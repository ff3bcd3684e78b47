"""Periodic runs against plain Python that compares every word with the one a period later."""

from __future__ import annotations

import random

import awkward
import numpy as np
import pytest

from lossline.llm import periodic_runs


def brute(words, least):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def check(rows, least):
    for r in rows:
        words = (r.text or "").encode().split()
        want = brute(words, least)
        assert [tuple(x) for x in r.runs] == want
        assert r.n_words == len(words) and r.collapsed == collapse(words, want)


def drawn(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(12):
        words = [f"w{draw.randrange(draw.choice([1, 2, 3, 9]))}" for _ in range(draw.randint(0, 70))]
        if words and draw.random() < 0.6:
            a, p = draw.randrange(len(words)), draw.randint(1, 9)
            words = words[:a] + (words[a : a + p] * 30)[: draw.randint(1, 80)] + words[: draw.randint(0, 9)]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(spark, seed):
    least = (12, 12, 2, 5)[seed]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(drawn(seed))], "doc_id long, text string")
    rows = periodic_runs.runs(docs, least).collect()
    check(rows, least)
    assert seed or any(r.runs for r in rows)


@pytest.mark.parametrize("words", [1, 2, 4])
def test_many_random_texts(words):
    draw = random.Random(words)
    for least in (2, 7, 12):
        texts = [[b"%d" % draw.randrange(words) for _ in range(draw.randint(0, 50))] for _ in range(200)]
        of, start, length, period = periodic_runs.find_runs(texts, least)
        for n, text in enumerate(texts):
            at = of == n
            assert list(zip(start[at].tolist(), length[at].tolist(), period[at].tolist())) == brute(text, least)


def test_agreement_of_two_places():
    """Both directions, for every two places of texts with long runs."""
    draw = random.Random(3)
    text = [draw.randrange(2) for _ in range(60)] + [1] * 40 + [0, 1] * 20
    symbol = np.array([2, *text, 3])
    rounds = periodic_runs.grammar(symbol, symbol > 1)
    a, b = (x.ravel() + 1 for x in np.triu_indices(len(text), 1))
    ahead, back = periodic_runs.agreement(rounds, a, b, 1), periodic_runs.agreement(rounds, a, b, -1)
    for i, j, f, g in zip(a.tolist(), b.tolist(), ahead.tolist(), back.tolist()):
        k = 0
        while symbol[i + k] == symbol[j + k]:
            k += 1
        assert f == k
        k = 0
        while symbol[i - k] == symbol[j - k]:
            k += 1
        assert g == k


def test_awkward_rows(spark):
    docs = awkward.documents(spark)
    found = periodic_runs.runs(docs)
    assert found.columns == [*docs.columns, "n_words", "runs", "collapsed"]
    renamed = found.toDF("doc_id", "text", *[f"x{i}" for i in range(len(docs.columns) - 2)], "n_words", "runs", "collapsed")
    rows = renamed.collect()
    assert len(rows) == docs.count()
    check([r for r in rows if len(r.text or "") < 100_000], 12)
    (long,) = [r for r in rows if len(r.text or "") >= 100_000]
    assert [tuple(x) for x in long.runs] == [(0, 32_000, 8)] and len(long.collapsed.split()) == 8
    assert periodic_runs.runs(awkward.empty(spark)).count() == 0


def test_few_candidates_at_once(monkeypatch):
    texts = [[b"a", b"b", b"b"] * 40, [b"c"] * 30, []]
    whole = [x.tolist() for x in periodic_runs.find_runs(texts, 12)]
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 10)
    assert [x.tolist() for x in periodic_runs.find_runs(texts, 12)] == whole == [[0, 1], [0, 0], [120, 30], [3, 1]]


def test_planted_periods(spark):
    """The periods that the registered query plants, word by word."""
    import zlib

    from lossline.llm.queries import with_periods

    texts = [(i, " ".join(f"w{j}" for j in range(i % 37))) for i in range(300)] + [(None, "a b c"), (20, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in with_periods(docs).collect()), key=str)
    want, planted = [], 0
    for doc_id, text in texts:
        words = (text or "").split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text, planted = " ".join(words[i if i < a else a + (i - a) % p] for i in range(n)), planted + 1
        want.append((doc_id, text))
    assert planted > 10 and got == sorted(want, key=str)
