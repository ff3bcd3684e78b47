"""Encoding and decoding against the tokenizers library."""

from __future__ import annotations

import random

import awkward
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lossline.llm import bpe
from lossline.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def made():
    return bpe.encoder(bpe.vocabulary_source(vocabulary_path()))


def same(made, texts):
    library = made.vocabulary.library
    for text, ids in zip(texts, made.encode([t.encode() for t in texts])):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:80]
        assert made.vocabulary.decode(ids) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(made, texts):
    same(made, texts)


def test_odd_pieces(made):
    draw = random.Random(3)
    odd = "<|endoftext|> é é ß ΑΣ İ ǅ \x1c \x85 你好 🙂 's 'LL _ ½ ​ 　 ﬁ < <|startoftext|>x don't Å 힣 ᄀ ᅡ".split(" ")
    same(made, ["".join(draw.choice([*odd, " ", "\n"]) for _ in range(draw.randint(1, 30))) for _ in range(500)])


def test_long_word_and_forgetting(made, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 3)
    monkeypatch.setattr(bpe, "PIECES_KEPT", 3)
    draw = random.Random(1)
    same(made, ["".join(draw.choice("thein") for _ in range(5000)), "a b c d e f g", "a b h i", "b" * 64 + " " + "b" * 65])


def test_trees_agree_on_ties(made):
    words = [b"aaaaaaaaaaaaaaaaa", b"abababababababab", b"a", b"ab", b"\xff\xfe"]
    assert made.vocabulary.merge(words) == [made.vocabulary.merge_long(w) for w in words]


def test_table(spark, made):
    found = bpe.encode_documents(awkward.documents(spark), vocabulary_path()).toPandas()
    rows = awkward.rows()
    assert len(found) == len(rows)
    library = made.vocabulary.library
    want = sorted((-99 if r[0] is None else r[0], tuple(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    got = sorted((-99 if np.isnan(i) else int(i), tuple(np.frombuffer(b, "<u4").tolist())) for i, b in zip(found.doc_id, found.ids))
    assert got == want
    assert bpe.encode_documents(awkward.empty(spark), vocabulary_path()).count() == 0
