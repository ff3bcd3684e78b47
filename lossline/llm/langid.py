"""Language of a text by a byte convolutional network: filters of several widths, max pooling, softmax; trained in numpy.

A text is cut into windows of WINDOW bytes (A-Z lower-cased, the last one padded with zeros); the network gives each
window a probability per language, and the text has the mean over all its windows, weighted by their bytes. Since a
filter is linear in the bytes it sees, inference reads its response from tables: one row per byte pair or byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lossline.llm.common import hidden, pick, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
EPOCHS = 8
#: The training sample: at most one row for each of so many hash buckets of each language, and so many languages.
SAMPLE_PER_LANGUAGE, LANGUAGES = 400, 64
SAMPLE_CHARACTERS = 600
#: Windows that inference handles at once.
BLOCK = 128
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # width x EMBEDDING x FILTERS
    biases: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def responses(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per width the table of a byte pair and that of what follows it: nothing, a byte or a pair."""
        tables = []
        for kernel, bias in zip(self.filters, self.biases):
            one = [(self.embedding @ k).astype(np.float32) for k in kernel]
            pairs = [(a[:, None] + b[None]).reshape(65536, FILTERS) for a, b in zip(one[::2], one[1::2])]
            rest = pairs[1:] + one[len(pairs) * 2 :]
            tables.append((np.ascontiguousarray(pairs[0] + bias), rest[0] if rest else None))
        return tables


def windows(data: bytes) -> np.ndarray:
    """All windows of a text, one a row."""
    rows = max(1, -(-len(data) // WINDOW))
    out = np.zeros(rows * WINDOW, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(rows, WINDOW)


# --- training ----------------------------------------------------------------------------


def _forward(m: Model, x: np.ndarray):
    seen = m.embedding[x]
    pooled, keep = [], []
    for kernel, bias in zip(m.filters, m.biases):
        width, steps = len(kernel), WINDOW - len(kernel) + 1
        columns = np.concatenate([seen[:, i : i + steps] for i in range(width)], axis=2)
        found = columns @ kernel.reshape(width * EMBEDDING, FILTERS)
        best = found.argmax(axis=1)
        pooled.append(np.take_along_axis(found, best[:, None], 1)[:, 0] + bias)
        keep.append((columns, best))
    flat = np.concatenate(pooled, axis=1)
    active = np.maximum(flat, 0)
    logits = active @ m.dense + m.offset
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True), active, keep


def _gradients(m: Model, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    p, active, keep = _forward(m, x)
    p[np.arange(len(y)), y] -= 1
    delta = p * weight[:, None] / len(y)
    back = (delta @ m.dense.T) * (active > 0)
    embedding, filters, biases = np.zeros_like(m.embedding), [], []
    rows = np.arange(len(y))[:, None]
    for n, (kernel, (columns, best)) in enumerate(zip(m.filters, keep)):
        d = back[:, n * FILTERS : (n + 1) * FILTERS]
        chosen = columns[rows, best]  # window, filter, width * EMBEDDING
        filters.append(np.einsum("bf,bfk->kf", d, chosen).reshape(kernel.shape))
        biases.append(d.sum(axis=0))
        for i, k in enumerate(kernel):
            np.add.at(embedding, x[rows, best + i], d[:, :, None] * k.T[None])
    return [embedding, *filters, *biases, active.T @ delta, delta.sum(axis=0)]


def train(texts: list[str], labels: list[str], seed: int = 7, epochs: int = EPOCHS) -> Model | None:
    """Fit on labelled pieces of text; rare languages weigh as much as frequent ones. None without any label."""
    languages = sorted(set(labels))
    if not languages:
        return None
    draw = np.random.default_rng(seed)
    rows, target = [], []
    for text, label in zip(texts, labels):
        data = text.encode("utf-8", "replace").lower()
        cut = [data[:WINDOW], data[WINDOW : 2 * WINDOW], data[: int(draw.integers(4, 80))]]  # short ones too
        for piece in cut:
            if piece:
                rows.append(windows(piece)[0])
                target.append(languages.index(label))
    if not rows:
        return None
    x, y = np.stack(rows), np.array(target)
    counts = np.bincount(y, minlength=len(languages))
    weight = (len(y) / (np.maximum(counts, 1) * len(languages)))[y].astype(np.float32)
    scale = lambda *shape: (draw.standard_normal(shape) / np.sqrt(np.prod(shape[:-1]))).astype(np.float32)
    model = Model(
        languages,
        draw.standard_normal((256, EMBEDDING)).astype(np.float32),
        [scale(w, EMBEDDING, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        scale(FILTERS * len(WIDTHS), len(languages)),
        np.zeros(len(languages), np.float32),
    )
    values = [model.embedding, *model.filters, *model.biases, model.dense, model.offset]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(epochs):
        order = draw.permutation(len(y))
        for at in range(0, len(y), 64):
            some, step = order[at : at + 64], step + 1
            for v, g, a, b in zip(values, _gradients(model, x[some], y[some], weight[some]), first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                v -= 0.004 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return model


def sample(docs: DataFrame) -> tuple[list[str], list[str]]:
    """Labelled pieces of text, at most SAMPLE_PER_LANGUAGE of each of LANGUAGES languages.

    The smallest hash of each (language, hash bucket) names a row; that choice reduces before any shuffle and reads no
    text. Rows with a remainder of 1 are never looked at.
    """
    rows = docs.filter(F.col("lang").isNotNull() & ~held_out("doc_id")).withColumn("h", F.xxhash64(F.lit(11), "doc_id"))
    chosen = (
        rows.groupBy("lang", F.pmod("h", F.lit(SAMPLE_PER_LANGUAGE)).alias("bucket"))
        .agg(F.min("h").alias("h"))
        .select("lang", "h")
        .orderBy("bucket", "lang")
        .limit(SAMPLE_PER_LANGUAGE * LANGUAGES)
    )
    start = F.pmod(F.col("h"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARACTERS)).cast("int") + 1
    # At most SAMPLE_PER_LANGUAGE * LANGUAGES rows of two short values.
    found = (
        rows.filter(F.length("text") > 0)
        .join(F.broadcast(chosen), ["lang", "h"])
        .groupBy("lang", "h")
        .agg(F.min(F.substr("text", start, F.lit(SAMPLE_CHARACTERS))).alias("text"))
        .orderBy("h", "lang")
        .toPandas()
    )
    return found["text"].tolist(), found["lang"].tolist()


def held_out(doc_id: str) -> F.Column:
    """Rows that no training may see. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


# --- prediction --------------------------------------------------------------------------


def window_probabilities(model: Model, tables: list, x: np.ndarray) -> np.ndarray:
    """A row of probabilities for each window."""
    out = np.empty((len(x), len(model.languages)), np.float32)
    for at in range(0, len(x), BLOCK):
        block = x[at : at + BLOCK]
        pairs = (block[:, :-1].astype(np.uint16) << 8) | block[:, 1:]
        pooled = []
        for width, (head, tail) in zip(WIDTHS, tables):
            steps = WINDOW - width + 1
            found = head.take(pairs[:, :steps], axis=0)
            if tail is not None:
                found += tail.take(block[:, 2:] if width == 3 else pairs[:, 2 : 2 + steps], axis=0)
            pooled.append(found.max(axis=1))
        logits = np.maximum(np.concatenate(pooled, axis=1), 0) @ model.dense + model.offset
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        out[at : at + BLOCK] = p / p.sum(axis=1, keepdims=True)
    return out


def predict(model: Model | None, tables: list, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """A language and its probability for each whole text; UNDETERMINED and 0 for a text without letters."""
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if model and t and LETTER.search(t)]
    if not known:
        return names, scores
    data = [texts[i].encode("utf-8", "replace").lower() for i in known]
    cut = [windows(d) for d in data]
    ends = np.cumsum([len(w) for w in cut])
    weights = np.full(ends[-1], WINDOW, np.float32)
    weights[ends - 1] = [len(d) - WINDOW * (len(w) - 1) for d, w in zip(data, cut)]
    p = window_probabilities(model, tables, np.concatenate(cut)) * weights[:, None]
    mean = np.add.reduceat(p, ends - np.array([len(w) for w in cut]), axis=0)
    mean /= mean.sum(axis=1, keepdims=True)
    best = mean.argmax(axis=1)
    for i, b, row in zip(known, best.tolist(), mean):
        names[i], scores[i] = model.languages[b], min(1.0, float(row[b]))
    return names, scores


def fit(docs: DataFrame) -> Model | None:
    """The network for a table with doc_id, text and lang (nulls allowed anywhere)."""
    return train(*sample(pick(docs, "doc_id", "text", "lang")))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every row and column of docs, with lang_pred and lang_score appended.

    Only the text is looked at, all of it. Null and empty texts and texts without a letter are UNDETERMINED with score
    0; so is every text where the training table had no labels. Repeated rows each get the same answer.
    """
    inner, names, (text,) = hidden(docs, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema) + ", lang_pred string, lang_score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.responses() if model else []
        for batch in slices(batches, text):
            found = predict(model, tables, batch.column(batch.schema.names.index(text)).to_pylist())
            columns = [*batch.columns, pa.array(found[0], pa.string()), pa.array(found[1], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "lang_score"])

    return inner.mapInArrow(run, schema).toDF(*names, "lang_pred", "lang_score")
