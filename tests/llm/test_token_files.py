"""The file format, and tokens against the tokenizers library."""

from __future__ import annotations

import io

import awkward
import numpy as np
import pytest
import zstandard
from hypothesis import given, settings, strategies as st

from lossline.llm import bpe, token_files
from lossline.llm.queries import vocabulary_path
from lossline.llm.token_files import Reader, Writer


def written(documents):
    out = io.BytesIO()
    writer = Writer(out)
    for doc_id, ids in documents:
        writer.add(doc_id, np.array(ids, "<u4").tobytes())
    writer.close()
    return out.getvalue()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.none() | st.integers(-(2**62), 2**62), st.lists(st.integers(0, 2**32 - 1), max_size=50)), max_size=12), st.integers(1, 40))
def test_round_trip(documents, frame):
    kept, token_files.FRAME_BYTES = token_files.FRAME_BYTES, frame * 4
    try:
        data = written(documents)
    finally:
        token_files.FRAME_BYTES = kept
    reader = Reader(io.BytesIO(data), len(data))
    assert [np.frombuffer(reader.ids(i), "<u4").tolist() for i in range(len(documents))] == [d[1] for d in documents]
    assert [None if i == token_files.NO_ID else i for i in reader.documents["doc_id"].tolist()] == [d[0] for d in documents]
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()  # the table is skipped
    assert plain == b"".join(np.array(d[1], "<u4").tobytes() for d in documents)


def test_damage_is_seen():
    data = bytearray(written([(1, range(1000)), (2, range(50))]))
    data[20] ^= 1
    with pytest.raises(ValueError):
        Reader(io.BytesIO(bytes(data)), len(data)).ids(0)
    data = bytearray(written([(1, range(1000))]))
    data[-30] ^= 1
    with pytest.raises(ValueError):
        Reader(io.BytesIO(bytes(data)), len(data))


def test_only_asked_frames_are_read(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_BYTES", 400)
    draw = np.random.default_rng(1)
    data = written([(i, draw.integers(0, 50_000, 100)) for i in range(50)])
    file = io.BytesIO(data)
    reader = Reader(file, len(data))
    frames, plain = [], reader.expand
    reader.expand = lambda body, **more: frames.append(len(body)) or plain(body, **more)
    reader.ids(30)
    assert len(frames) == 1 and len(reader.frames) == 50


def test_table(spark, tmp_path, monkeypatch):
    docs, rows = awkward.documents(spark), awkward.rows()
    files = token_files.write_tokens(docs, vocabulary_path(), 1, str(tmp_path / "out"))
    library = bpe.encoder(bpe.vocabulary_source(vocabulary_path())).vocabulary.library
    found = sorted(token_files.read_tokens(files).collect(), key=lambda r: r.start)
    want = sorted((-(10**9) if r[0] is None else r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows)
    assert [-(10**9) if r.doc_id is None else r.doc_id for r in found] == [w[0] for w in want]
    assert sorted((-(10**9) if r.doc_id is None else r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found) == want
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    some = spark.createDataFrame([(9,), (-5,), (777,)], "doc_id long")
    chosen = token_files.read_tokens(files, some).collect()
    assert {r.doc_id: (r.start, r.ids) for r in chosen} == {r.doc_id: (r.start, r.ids) for r in found if r.doc_id in (9, -5)}
    none = token_files.write_tokens(awkward.empty(spark), vocabulary_path())
    assert none.count() == 0 and token_files.read_tokens(none).count() == 0
