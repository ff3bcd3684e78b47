"""Byte pair encoding and decoding with a given vocabulary file.

The pairs of neighbouring symbols of a word are the leaves of a segment tree that holds (merge rank, position). Its root
is the leftmost pair of the lowest rank; a merge changes at most three leaves and the path above each, until the root
holds no rank. Words of a batch are merged side by side, one tree a row; long words have a tree of their own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lossline.llm.common import pick, slices

#: Words and space-separated pieces a worker remembers; beyond, those of a batch are forgotten after it.
WORDS_KEPT, PIECES_KEPT = 300_000, 120_000
#: Bytes of text encoded together: many, so that many new words share a matrix.
SLICE_BYTES = 3 << 20
#: Longest word, in bytes, whose tree shares a matrix with other words.
SHARED_TREE = 64
NO_PAIR = np.int64(1) << 60

# The characters for which the word pattern of the vocabulary needs no Unicode tables, and that pattern.
SIMPLE = re.compile(r"[\n!-~À-ÖØ-öø-ÿ]*")
SIMPLE_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+|\n")
#: Between the ids of two pieces; no ids hold it, since they are far below 2**32.
STOP = b"\xff\xff\xff\xff"


def byte_signs() -> list[str]:
    """The visible character that stands for each byte: itself where Latin-1 prints it, else the next one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


class Vocabulary:
    """Merges and tokens of a `tokenizers` file with byte-level words and an end-of-word mark."""

    def __init__(self, source: str):
        file = json.loads(source)
        model = file["model"]
        self.source, self.end = source, model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")" if self.special else "($^)")
        ids = model["vocab"]
        self.texts = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in [*ids.items(), *self.special.items()]:
            self.texts[i] = token
        self.signs = byte_signs()
        self.inner = np.array([ids[s] for s in self.signs], np.int64)
        self.last = np.array([ids[s + self.end] for s in self.signs], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.width = np.int64(len(self.texts))
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(merges)}
        pairs = np.array([a * int(self.width) + b for a, b in self.merges], np.int64)
        order = np.argsort(pairs)
        self.pairs = np.append(pairs[order], NO_PAIR)
        self.ranks = np.append(np.array([r for r, _ in self.merges.values()], np.int64)[order], NO_PAIR)
        self.made = np.zeros(len(merges) + 1, np.int64)
        for rank, new in self.merges.values():
            self.made[rank] = new

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.source)

    @cached_property
    def bytes_of(self) -> dict[str, int]:
        return {s: b for b, s in enumerate(self.signs)}

    def unusual(self, piece: bytes) -> list[str]:
        """The words of a piece with characters outside SIMPLE, by the file's own rules; special tokens stay whole."""
        words = []
        for part in self.cut.split(piece.decode("utf-8", "replace")):
            if part in self.special:
                words.append(part)
            elif part:
                normal = self.library.normalizer.normalize_str(part)
                words += [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return words

    def rank(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaves: rank and position of a pair, or NO_PAIR."""
        code = left * self.width + right
        found = np.searchsorted(self.pairs, code)
        return np.where(self.pairs[found] == code, self.ranks[found] << 8 | at, NO_PAIR)

    # --- merging -------------------------------------------------------------------------

    def merge_long(self, word: bytes) -> bytes:
        """One word, one tree."""
        n = len(word)
        symbols = [*self.inner[np.frombuffer(word[:-1], np.uint8)].tolist(), int(self.last[word[-1]])]
        size = 1 << max(0, (n - 2).bit_length())
        none, shift = (1 << 62), n.bit_length()
        merges, following, previous = self.merges, list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * size)
        for i in range(n - 1):
            if found := merges.get((symbols[i], symbols[i + 1])):
                tree[size + i] = found[0] << shift | i
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(at: int) -> None:
            after = following[at]
            found = merges.get((symbols[at], symbols[after])) if symbols[at] >= 0 and after < n else None
            tree[i := size + at] = found[0] << shift | at if found else none
            while i := i >> 1:
                tree[i] = min(tree[2 * i], tree[2 * i + 1])

        while n > 1 and tree[1] != none:
            at = tree[1] & ((1 << shift) - 1)
            right = following[at]
            symbols[at] = merges[symbols[at], symbols[right]][1]
            symbols[right] = -1
            following[at] = following[right]
            if following[at] < n:
                previous[following[at]] = at
            put(right) if right < n - 1 else None
            put(at)
            if previous[at] >= 0:
                put(previous[at])
        return np.array([s for s in symbols if s >= 0], "<u4").tobytes()

    def merge_block(self, words: list[bytes], leaves: int) -> list[bytes]:
        """Words of at most leaves + 1 bytes (leaves: a power of two), a tree each."""
        w, n = len(words), np.array([len(x) for x in words], np.int64)
        row, flat = np.repeat(np.arange(w), n), np.frombuffer(b"".join(words), np.uint8)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        symbols = np.full((w, leaves + 2), -1, np.int64)
        symbols[row, column] = np.where(column == n[row] - 1, self.last[flat], self.inner[flat])
        following = np.minimum(np.arange(1, leaves + 3), n[:, None])
        previous = np.broadcast_to(np.arange(-1, leaves + 1), following.shape).copy()
        tree = np.full((w, 2 * leaves), NO_PAIR)
        pair = (np.arange(leaves) < n[:, None] - 1).nonzero()
        tree[pair[0], leaves + pair[1]] = self.rank(symbols[pair], symbols[pair[0], pair[1] + 1], pair[1])
        size = leaves
        while size > 1:
            size >>= 1
            tree[:, size : 2 * size] = np.minimum(tree[:, 2 * size : 4 * size : 2], tree[:, 2 * size + 1 : 4 * size : 2])

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = leaves + at
            tree[rows, node] = value
            for _ in range(leaves.bit_length() - 1):
                node >>= 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = (tree[:, 1] < NO_PAIR).nonzero()[0]
        while len(rows):
            root = tree[rows, 1]
            at = root & 255
            right = following[rows, at]
            after = following[rows, right]
            symbols[rows, at] = self.made[root >> 8]
            symbols[rows, right] = -1
            following[rows, at] = after
            inside = (after < n[rows]).nonzero()[0]
            previous[rows[inside], after[inside]] = at[inside]
            gone = (right < leaves).nonzero()[0]
            put(rows[gone], right[gone], NO_PAIR)
            put(rows, at, np.where(after < n[rows], self.rank(symbols[rows, at], symbols[rows, after], at), NO_PAIR))
            has = (previous[rows, at] >= 0).nonzero()[0]
            some, before = rows[has], previous[rows[has], at[has]]
            put(some, before, self.rank(symbols[some, before], symbols[some, at[has]], before))
            rows = rows[tree[rows, 1] < NO_PAIR]
        kept = symbols >= 0
        ids, ends = symbols[kept].astype("<u4").tobytes(), (np.cumsum(kept.sum(axis=1)) * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each word."""
        out: list[bytes] = [b""] * len(words)
        blocks: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) > SHARED_TREE:
                out[i] = self.merge_long(word)
            else:
                blocks.setdefault(1 << max(0, (len(word) - 2).bit_length()), []).append(i)
        for leaves, members in blocks.items():
            for i, ids in zip(members, self.merge_block([words[i] for i in members], leaves)):
                out[i] = ids
        return out

    def decode(self, ids: bytes) -> str:
        """Tokens side by side with one space between, special ones too: what a file without decoder gives."""
        return " ".join(map(self.texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Encoder:
    """Whole texts to ids. What it has met stays known to it as long as there is room."""

    def __init__(self, vocabulary: Vocabulary, merge: Callable[[list[bytes]], list[bytes]] | None = None):
        self.vocabulary, self.merge = vocabulary, merge or vocabulary.merge
        #: Ids of words of simple pieces (in plain text) and of unusual pieces (in byte signs).
        self.plain: dict[str, bytes] = {"\n": STOP}
        self.signed: dict[str, bytes] = {s: np.array([i], "<u4").tobytes() for s, i in vocabulary.special.items()}
        self.pieces: dict[bytes, bytes] = {}

    def _learn(self, known: dict[str, bytes], words: set[str], raw: Callable[[str], bytes]) -> list[str]:
        new = list(words.difference(known))
        known.update(zip(new, self.merge(list(map(raw, new)))))
        return new

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces, none of which has ASCII white space."""
        text = b"\n".join(pieces).decode("utf-8", "replace")
        if not SIMPLE.fullmatch(text) or any(s in text for s in self.vocabulary.special):
            good = [p for p in pieces if SIMPLE.fullmatch(t := p.decode("utf-8", "replace")) and not self.vocabulary.cut.search(t)]
            odd = {p: self.vocabulary.unusual(p) for p in set(pieces).difference(good)}
            sign = self.vocabulary.bytes_of.__getitem__
            new = self._learn(self.signed, {w for words in odd.values() for w in words}, lambda w: bytes(map(sign, w)))
            done = dict(zip(good, self._encode_pieces(good) if good else []))
            done |= {p: b"".join(map(self.signed.__getitem__, words)) for p, words in odd.items()}
            self._forget(self.signed, new, WORDS_KEPT // 4)
            return list(map(done.__getitem__, pieces))
        words = SIMPLE_WORDS.findall(text.lower())
        new = self._learn(self.plain, set(words), str.encode)
        out = b"".join(map(self.plain.__getitem__, words)).split(STOP)
        self._forget(self.plain, new, WORDS_KEPT)
        return out

    @staticmethod
    def _forget(known: dict, new: list, room: int) -> None:
        if len(known) > room:
            for key in new:
                del known[key]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        cut = [text.split() for text in texts]
        fresh = list(set().union(*cut).difference(self.pieces))
        if fresh:
            self.pieces.update(zip(fresh, self._encode_pieces(fresh)))
        whole = self.pieces.__getitem__
        out = [b"".join(map(whole, pieces)) for pieces in cut]
        self._forget(self.pieces, fresh, PIECES_KEPT)
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def release() -> None:
    """Forget the encoders: a worker lives on for other stages, which need its memory."""
    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()


def by_library(vocabulary: Vocabulary) -> Callable[[list[bytes]], list[bytes]]:
    """Merge words with the `tokenizers` library."""
    model, signs = vocabulary.library.model, vocabulary.signs

    def merge(words: list[bytes]) -> list[bytes]:
        return [np.array([t.id for t in model.tokenize("".join(map(signs.__getitem__, w)))], "<u4").tobytes() for w in words]

    return merge


def encoder(source: str, merge: str = "tree") -> Encoder:
    """The worker's encoder for a vocabulary, kept for later tasks until they are cleared."""
    key = hashlib.sha256(source.encode()).hexdigest(), merge
    if key not in _ENCODERS:
        vocabulary = Vocabulary(source)
        _ENCODERS[key] = Encoder(vocabulary, by_library(vocabulary) if merge == "library" else None)
    return _ENCODERS[key]


def vocabulary_source(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_documents(docs: DataFrame, vocabulary_path: str, decode: bool = True) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded (text of the ids, if asked for).

    Every row gives one row, repeated ones too; null and empty texts have no ids; null doc_ids stay null. Texts of any
    length are encoded whole. Other columns are ignored. An empty table gives an empty one. The vocabulary file (a few
    MB, whatever the rows) is read by the driver and broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_source(vocabulary_path))
    fields = [pa.field("ids", pa.binary())] + [pa.field("decoded", pa.string())] * decode

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(shared.value)
        for batch in slices(batches, "text", SLICE_BYTES):
            ids = made.encode(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array(ids, pa.binary())]
            if decode:
                columns.append(pa.array(list(map(made.vocabulary.decode, ids)), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([batch.schema.field(0), *fields]))
        release()

    read = pick(docs, "doc_id", "text").select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(run, f"doc_id {kind}, ids binary" + ", decoded string" * decode)


def digests(encoded: DataFrame) -> DataFrame:
    """Tokens and digests of each document's ids and decoded text."""
    return encoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
