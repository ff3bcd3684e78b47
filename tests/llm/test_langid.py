"""Held-out accuracy, table lookups against the plain network, and awkward texts."""

from __future__ import annotations

import zlib

import awkward
import numpy as np
import pytest

from lossline.llm import langid
from lossline.llm.common import pick


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    found = langid.identify(docs, model).filter(langid.held_out("doc_id")).collect()
    assert len(found) > 200 and np.mean([r.lang == r.lang_pred for r in found]) > 0.95
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and 0 <= r.lang_score <= 1 for r in found)


def test_tables_give_what_the_network_gives(model):
    draw = np.random.default_rng(1)
    x = draw.integers(0, 256, (300, langid.WINDOW), dtype=np.uint8)
    assert np.allclose(langid.window_probabilities(model, model.responses(), x), langid._forward(model, x)[0], atol=1e-4)


def test_whole_text_counts(model):
    tables = model.responses()
    head, tail = "the and that with " * 40, "und der die das schen ung heit " * 900
    names, scores = langid.predict(model, tables, [head, head + tail, None, "", "12 !?", "\n", "a"])
    assert names[:2] == ["en", "de"] and names[2:6] == ["und"] * 4 and names[6] in model.languages
    assert scores[2:6] == [0.0] * 4 and all(0 < s <= 1 for s in scores[:2])


def test_awkward_rows(spark, model):
    docs = awkward.documents(spark)
    found = langid.identify(docs, model)
    assert found.columns == [*docs.columns, "lang_pred", "lang_score"]
    rows = found.collect()
    assert len(rows) == len(awkward.rows()) and {r[0]: r[-2] for r in rows}[12] == "und"
    assert [tuple(r)[:-2] for r in sorted(rows, key=str)] == sorted(awkward.rows(), key=str)
    assert langid.identify(awkward.empty(spark), model).count() == 0


def test_learns_from_allowed_rows_only(spark):
    rows = [(i, f"text of number {i} " * 5, "aa" if zlib.crc32(str(i).encode()) % 3 == 1 else "bb") for i in range(60)]
    docs = spark.createDataFrame([*rows, (99, None, "cc"), (100, "no label", None)], "doc_id long, text string, lang string")
    texts, labels = langid.sample(pick(docs, "doc_id", "text", "lang"))
    assert set(labels) == {"bb"} and 25 < len(texts) == len(set(texts)) <= sum(r[2] == "bb" for r in rows)  # one a bucket
    assert langid.fit(docs.limit(0)) is None
    assert langid.identify(docs, None).filter("lang_pred <> 'und' OR lang_score <> 0").count() == 0
