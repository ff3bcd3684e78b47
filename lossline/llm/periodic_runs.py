"""Periodic runs of words: stretches that repeat a period at least twice and that no neighbouring word continues.

Recompression turns the words of a slice of texts into a run-length grammar. Rounds alternate: a block round names every
stretch of one symbol by the symbol and its count, a pair round splits the symbols into a left and a right half and names
every left symbol followed by a right one. Names are exact (equal names stand for equal words), and equal words are cut
alike but at their ends, until each text is one symbol.

How far two places agree is read from the grammar. Going up, a symbol that may be joined with what lies before the
place is compared on its own, everything else one level higher; at the first difference the way leads down again, past
at most one equal symbol or block a level. Both directions are exact; no suffix array or hash of a passage is needed.

A run of period q and two periods at least holds two places q apart, the first a multiple of q. For every q these places
are the candidates (in all n + n/2 + n/3 + ...); the words that agree before and after them are the run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lossline.llm.common import hidden, slices
from lossline.llm.words import mix

#: Candidates looked at together; bounds the memory of long texts.
CANDIDATES = 1 << 19


@dataclass
class Round:
    """One step of the grammar: the symbols it read and how they went into the next ones."""

    symbol: np.ndarray
    up: np.ndarray  # the symbol of the next level that each went into
    first: np.ndarray  # of each symbol of the next level: the first that went into it, and one more at the end
    right: np.ndarray | None  # pair rounds: whether a symbol is of the right half; None for block rounds


def _named(keys: np.ndarray, after: int) -> tuple[np.ndarray, int]:
    """A new symbol for each distinct key, and the next free one."""
    distinct, name = np.unique(keys, return_inverse=True)
    return after + name, after + len(distinct)


def grammar(symbol: np.ndarray, alone: np.ndarray) -> list[Round]:
    """All rounds over symbols numbered from 0. Those `alone` (each a symbol of its own, first and last ones among them)
    are never joined; between two of them one symbol is left at the end."""
    rounds: list[Round] = []
    free = int(symbol.max()) + 1
    while True:
        new = symbol[1:] != symbol[:-1]
        if not new.all():
            first = np.r_[0, np.flatnonzero(new) + 1, len(symbol)]
            count = np.diff(first)
            made = symbol[first[:-1]]
            long = count > 1
            made[long], free = _named(made[long] * (int(count.max()) + 1) + count[long], free)
            rounds.append(Round(symbol, np.r_[0, np.cumsum(new)], first, None))
            symbol, alone = made, alone[first[:-1]]
        open_ = ~alone[:-1] & ~alone[1:]
        if not open_.any():
            rounds.append(Round(symbol, np.arange(len(symbol)), np.arange(len(symbol) + 1), np.zeros(len(symbol), bool)))
            return rounds
        key = mix(np.array([len(rounds)], np.uint64)) ^ symbol.astype(np.uint64)
        right = (mix(key) & np.uint64(1)).astype(bool)
        pair = np.flatnonzero(~right[:-1] & right[1:] & open_)
        keep = np.ones(len(symbol), bool)
        keep[pair + 1] = False
        made = symbol.copy()
        made[pair], free = _named(symbol[pair] * free + symbol[pair + 1], free)
        rounds.append(Round(symbol, np.cumsum(keep) - 1, np.r_[np.flatnonzero(keep), len(symbol)], right))
        symbol, alone = made[keep], alone[keep]


def _rest(r: Round, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block round: how many equal symbols are left from a place on, and whether the block begins there."""
    block = r.up[at]
    low, high = r.first[block], r.first[block + 1] - 1
    return (high - at + 1, at == low) if step > 0 else (at - low + 1, at == high)


def agreement(rounds: list[Round], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from the places a and b on, to the right (step 1) or to the left (step -1).

    a and b differ and lie in one text, with a symbol that stands alone on both sides of it.
    """
    begin, total = a, len(a)
    depth = np.zeros(total, np.int64)
    last = [np.zeros(total, np.int64), np.zeros(total, np.int64)]
    each, x, y = np.arange(total), a, b

    def stop(which: np.ndarray, level: int) -> None:
        depth[each[which]] = level
        last[0][each[which]], last[1][each[which]] = x[which], y[which]

    for level, r in enumerate(rounds):
        equal = r.symbol[x] == r.symbol[y]
        stop(~equal, level)
        each, x, y = each[equal], x[equal], y[equal]
        if not len(each):
            break
        if r.right is None:
            (rest, edge), (rest_y, edge_y) = _rest(r, x, step), _rest(r, y, step)
            move = np.where(edge & edge_y, 0, np.minimum(rest, rest_y))
            x, y = x + step * move, y + step * move
            differ = (move > 0) & (rest != rest_y)
            stop(differ, level)
            each, x, y = each[~differ], x[~differ], y[~differ]
        else:
            move = step * (r.right[x] if step > 0 else ~r.right[x]).astype(np.int64)
            x, y = x + move, y + move
        x, y = r.up[x], r.up[y]

    order = np.argsort(-depth, kind="stable")
    x, y = last[0][order], last[1][order]
    deep = np.searchsorted(-depth[order], -np.arange(len(rounds) + 1), side="right")  # of so many the depth is k at least
    for level in range(int(depth.max(initial=0)), 0, -1):
        r, n = rounds[level - 1], deep[level]
        if step > 0:
            at, bt = r.first[x[:n]], r.first[y[:n]]
        else:
            at, bt = r.first[x[:n] + 1] - 1, r.first[y[:n] + 1] - 1
        move = (r.symbol[at] == r.symbol[bt]).astype(np.int64)
        if r.right is None:
            move *= np.minimum(_rest(r, at, step)[0], _rest(r, bt, step)[0])
        x[:n], y[:n] = at + step * move, bt + step * move
    out = np.empty(total, np.int64)
    out[order] = (x - begin[order]) * step
    return out


def _candidates(first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Place and period of all candidates of texts that begin at `first` with `size` words, some at a time."""
    half = size // 2
    of = np.repeat(np.arange(len(size)), half)
    period = np.arange(len(of)) - np.repeat(np.cumsum(half) - half, half) + 1
    points = (size[of] - 1) // period
    ends = np.cumsum(points)
    cut = 0
    while cut < len(of):
        end = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + CANDIDATES, side="right")))
        n, q = points[cut:end], period[cut:end]
        each = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        yield first[of[cut:end]][each] + step * q[each], q[each]
        cut = end


def find_runs(texts: list[list[bytes]], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, start, length, period of all runs of at least `least` words, by text, start and period."""
    size = np.array([len(t) for t in texts], np.int64)
    none = np.zeros(0, np.int64)
    if not size.sum():
        return none, none, none, none
    words = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    # Every text stands between two symbols that occur nowhere else.
    total = len(words) + len(texts) + 1
    end = np.r_[0, np.cumsum(size + 1)]
    alone = np.zeros(total, bool)
    alone[end] = True
    symbol = np.empty(total, np.int64)
    symbol[alone] = int(words.max()) + 1 + np.arange(len(end))
    symbol[~alone] = words
    rounds = grammar(symbol, alone)
    begin = end[:-1] + 1
    enough = size >= least
    found = []
    for at, q in _candidates(begin[enough], size[enough]):
        near = symbol[at] == symbol[at + q]
        at, q = at[near], q[near]
        # Where more than one word has to agree, the one before or the one after does.
        near = (symbol[at + 1] == symbol[at + q + 1]) | (symbol[at - 1] == symbol[at + q - 1]) | (np.maximum(q, least - q) < 2)
        at, q = at[near], q[near]
        after, before = agreement(rounds, at, at + q, 1), agreement(rounds, at - 1, at + q - 1, -1)
        run = after + before >= np.maximum(q, least - q)
        found.append((at[run] - before[run], after[run] + before[run] + q[run], q[run]))
    start, length, period = (np.concatenate(x) if found else none for x in (zip(*found) if found else ((), (), ())))
    # A run is found again with multiples of its period; the smallest is its period.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    once = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][: len(start)]
    start, length, period = start[once], length[once], period[once]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(end, start, side="right") - 1
    return text, start - begin[text], length, period


def runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """Every row and column of docs, with n_words, runs (start, length, period; by start, then period) and collapsed.

    Words are runs of characters other than ASCII white space. A run is a stretch of at least `least` words and two of
    its smallest period which no neighbouring word continues; `collapsed` is the text, its words joined by one space,
    without words that lie in any run after its first period. Null and empty texts have no words, no runs and collapse to
    an empty text. Each row is judged by its own text alone, so repeated rows and null ids change nothing; other columns
    pass through, whatever their names. Memory follows the words of one slice of texts or of one long text.
    """
    inner, names, (text,) = hidden(docs, "text")
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            bodies = batch.column(batch.schema.names.index(text)).to_pylist()
            texts = [(body or "").encode().split() for body in bodies]
            of, start, length, period = find_runs(texts, least)
            cut = np.searchsorted(of, np.arange(len(texts) + 1))
            kept = []
            for words, low, high in zip(texts, cut[:-1].tolist(), cut[1:].tolist()):
                if high > low:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, start[low:high] + period[low:high], 1)
                    np.add.at(edge, start[low:high] + length[low:high], -1)
                    words = [word for word, drop in zip(words, (np.cumsum(edge[:-1]) > 0).tolist()) if not drop]
                kept.append(b" ".join(words).decode())
            rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
            made = [
                pa.array([len(t) for t in texts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), rows),
                pa.array(kept, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "n_words", "runs", "collapsed"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema)
    return inner.mapInArrow(run, f"{schema}, n_words long, runs {kind}, collapsed string").toDF(*names, "n_words", "runs", "collapsed")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the longest run (ties: the first, then of the smallest period) and digests."""
    longest = F.expr("element_at(array_sort(transform(runs, r -> struct(-r.length AS l, r.start AS start, r.period AS period))), 1)")
    told = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = found.select("doc_id", "runs", "collapsed", F.when(F.size("runs") > 0, longest).alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-best.l * 1000 div best.period").alias("exponent_milli"),
        F.sha2(told.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
