"""Passages of at least `window` words that occur twice, found by recompression of all texts.

Each round first names runs of equal symbols, then splits the names into two halves by a hash and names the pairs of a
symbol of the first half and a following one of the second. A name is a hash of what it replaces, so all tasks agree on it
without a table that has to be shuffled in every round; equal words get equal names but for a few symbols at their ends.
Every border between symbols knows the words that decided on it, and its level is the last round for which those lie within
REACH words. The level and the two names beside it are thus the same wherever these words occur.

Every window picks the border of the highest level inside it (then the smallest name, then the first one): its anchor.
Equal windows pick equal anchors. Neighbouring windows of one anchor are one record: (anchor, hash of all their words).

1. Anchors that occur once are dropped; what is left is a small part unless the corpus repeats itself.
2. A record that occurs twice is repeated as a whole.
3. Of an anchor with different records, one of each kind tells the 128-bit hashes of its windows; those told twice repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lossline.llm.common import hidden, parts, pick, slices, write
from lossline.llm.words import Words, mix, prefix_sums, range_hash, split_words

REACH = 5
#: Windows of fewer words hold no anchor; the windows of a record are counted in eight bits.
LEAST, MOST = 2 * REACH, 256 + 2 * REACH - 1
ROUNDS = 4
LEFT, RIGHT, COUNT = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
FAR = 1 << 40


def borders(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Level and name of the border before each word (level 0: only the two words beside it are known)."""
    total, texts = len(words.hash), len(words.first) - 1
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    level = np.zeros(total, np.uint64)
    name = mix(np.r_[np.uint64(0), words.hash[:-1]] * LEFT + words.hash * RIGHT)
    # A symbol that never merges stands at the end of each text.
    order = np.argsort(np.r_[words.first[1:] * 2, np.arange(total) * 2 + 1], kind="stable")
    symbol = np.r_[np.zeros(texts, np.uint64), words.hash][order]
    start = np.r_[words.first[1:], np.arange(total)][order]
    end_mark = np.r_[np.ones(texts, bool), np.zeros(total, bool)][order]
    low, high = start.copy(), start.copy()
    for round_ in range(1, ROUNDS + 1):
        run = np.flatnonzero(np.r_[True, (symbol[1:] != symbol[:-1]) | end_mark[1:] | end_mark[:-1]])
        count = np.diff(np.r_[run, len(symbol)]).astype(np.uint64)
        runs = np.where(count > 1, mix(symbol[run] + count * COUNT), symbol[run])
        mark = end_mark[run]
        # What was read to decide on the border before run j: from the symbol before run j - 1 to that after run j.
        before = np.r_[0, run[:-1]] - 1
        read = (before >= 0) & ~end_mark[before] & ~np.r_[True, mark[:-1]]
        low = np.where(read, low[before], -FAR)
        after = np.r_[run[1:], len(symbol) - 1]
        read = ~mark & ~end_mark[after]
        high = np.where(read, high[np.minimum(after + 1, len(symbol) - 1)], FAR)
        side = (mix(runs + COUNT * np.array([round_], np.uint64)) & np.uint64(1)).astype(bool)
        pair = np.flatnonzero(~side[:-1] & side[1:] & ~mark[:-1] & ~mark[1:])
        made = runs.copy()
        made[pair] = mix(runs[pair] * LEFT + runs[pair + 1] * RIGHT + np.uint64(round_))
        keep = np.ones(len(run), bool)
        keep[pair + 1] = False
        beside = mix(np.r_[np.uint64(0), runs[:-1]] * LEFT + runs * RIGHT + np.uint64(round_))[keep]
        symbol, start, end_mark = made[keep], start[run][keep], mark[keep]
        low, high = low[keep], high[keep]
        local = np.flatnonzero((low >= start - REACH) & (high <= start + REACH) & ~end_mark)
        if not len(local):
            break
        level[start[local]], name[start[local]] = round_, beside[local]
    return level, name


def records(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """For each record: its text, what tells its anchor, the hash of its words, its first window, the windows after it.

    An anchor is told by its level, its names and the words within REACH, which every window that picks it holds.
    """
    level, name = borders(words)
    spread = window - 2 * REACH + 1
    sizes = np.diff(words.first)
    of = np.repeat(np.arange(len(sizes)), np.maximum(sizes - window + 1, 0))
    if not len(of):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    begin = np.cumsum(np.maximum(sizes - window + 1, 0)) - np.maximum(sizes - window + 1, 0)
    first = words.first[:-1][of] + np.arange(len(of)) - begin[of]
    # Highest level, then smallest name; the first such border of each stretch of `spread`.
    best = level << np.uint64(60) | (~name >> np.uint64(4))
    at = np.arange(len(best))
    width = 1
    while width < spread:
        step = min(width, spread - width)
        later = best[step:] > best[:-step]
        best, at = np.where(later, best[step:], best[:-step]), np.where(later, at[step:], at[:-step])
        width += step
    anchor = at[first + REACH]
    cut = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])])
    last = np.r_[cut[1:], len(of)] - 1
    sums = prefix_sums(words.hash)
    whole = range_hash(sums, first[cut], first[last] + window)
    inside = first[cut] - words.first[:-1][of[cut]]
    place = anchor[cut]
    near = range_hash(sums, place - REACH, place + REACH)
    return of[cut], mix(name[place] + level[place]) ^ near, whole, inside, last - cut


def window_hashes(words: Words, window: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each window that starts at a word (counted over all texts)."""
    return (
        range_hash(prefix_sums(words.hash), start, start + window),
        range_hash(prefix_sums(mix(words.hash ^ COUNT)), start, start + window),
    )


# --- Spark -------------------------------------------------------------------------------


def _key(doc_id: str, text: str, kind: str) -> tuple:
    """128 bits that tell a row: its doc_id where that is a whole number (else a hash of it, or of the text), and a hash of
    both. Rows of one doc_id and text share them; all their windows repeat anyway."""
    number = F.col(doc_id).cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(F.lit(1), F.col(doc_id))
    d = F.when(F.col(doc_id).isNull(), F.xxhash64(F.lit(2), text)).otherwise(number)
    return d.alias("d"), F.xxhash64(doc_id, text).alias("r")


def _rows(docs: DataFrame) -> DataFrame:
    """d, r, text: what tells a row, in place of a doc_id that may be null or repeated, and the bytes of its text."""
    read = pick(docs, "doc_id", "text")
    return read.select(*_key("doc_id", "text", dict(read.dtypes)["doc_id"]), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))


def _records(rows: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            of, anchor, whole, first, more = records(split_words(batch.column(2).to_pylist()), window)
            of = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)), batch.column(0).take(of), batch.column(1).take(of), pa.array(first << 8 | more)],
                names=["anchor", "whole", "d", "r", "place"],
            )

    return rows.mapInArrow(run, "anchor long, whole long, d long, r long, place long")


def _told(rows: DataFrame, window: int) -> DataFrame:
    """h1, h2, d, r, start, open of the windows of the records in `tell` (place << 1 | open)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split_words(batch.column(2).to_pylist())
            tell = batch.column(3)
            place = tell.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(np.arange(batch.num_rows), tell.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            more = (place >> 1) & 255
            each = np.repeat(np.arange(len(place)), more + 1)
            start = (place >> 9)[each] + np.arange(len(each)) - (np.cumsum(more + 1) - more - 1)[each]
            h1, h2 = window_hashes(words, window, words.first[of[each]] + start)
            at = pa.array(of[each])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), batch.column(0).take(at), batch.column(1).take(at), pa.array(start), pa.array((place & 1)[each] == 1)],
                names=["h1", "h2", "d", "r", "start", "open"],
            )

    return rows.mapInArrow(run, "h1 long, h2 long, d long, r long, start long, open boolean")


def repeated_spans(docs: DataFrame, window: int = 35) -> DataFrame:
    """d, r, spans (start << 8 | windows after it): where the repeated windows of each row start. Rows without have none."""
    rows = _rows(docs)
    found = _records(rows, window)
    # Sums are written before they are joined: Spark splits a join's hot key only where both sides come as they were dealt.
    twice = write(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "twice")
    shared = write(found.join(twice, "anchor", "left_semi"), "shared-anchors")
    own = F.xxhash64("d", "r", "place")
    kinds = write(shared.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(own).alias("teller")), "kinds")
    mixed = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    asked = (F.col("kinds") > 1) & (F.col("least") == 1)
    judged = kinds.join(mixed, "anchor").select("anchor", "whole", "n", "teller", asked.alias("asked")).filter("n > 1 OR asked")
    judged = write(judged, "judged")
    marks = (
        shared.join(judged, ["anchor", "whole"])
        .withColumn("tell", F.when(F.col("asked") & (F.col("teller") == own), F.col("place") * 2 + F.when(F.col("n") == 1, 1).otherwise(0)))
        .groupBy("d", "r")
        .agg(
            # Equal rows give equal places: a list never holds more than one text's.
            F.collect_set(F.when(F.col("n") > 1, F.col("place"))).alias("spans"),
            F.collect_set("tell").alias("tell"),
        )
    )
    return write(marks, "marks")


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """Every row and column of docs with the text rid of words in repeated windows, and n_words, n_removed.

    Words are runs of characters other than ASCII white space; the kept ones are joined by one space. A window repeats if
    its words also start anywhere else, in the same text or another row, as the input has them; every occurrence goes, the
    first one too. Null texts have no words and become empty; texts shorter than a window lose nothing. A repeated row is
    a row of its own, so all its windows repeat. Other columns pass through, whatever their names; doc_id may be of any
    type, null or repeated. window: LEAST to MOST words, others are an error.
    """
    if not LEAST <= window <= MOST:
        raise ValueError(f"a window has {LEAST} to {MOST} words")
    marks = repeated_spans(docs, window)
    inner, names, (doc_id, text) = hidden(docs, "doc_id", "text")
    n = parts(docs)
    # Both uses of the dealt texts are the same exchange, made once.
    dealt = inner.select(*_key(doc_id, text, dict(inner.dtypes)[doc_id]), *inner.columns).repartition(n, "d", "r")
    telling = dealt.join(marks.filter(F.size("tell") > 0).select("d", "r", "tell").repartition(n, "d", "r"), ["d", "r"])
    telling = telling.select("d", "r", F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"), "tell")
    told = _told(telling, window)
    twice = told.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2")
    late = told.filter("open").join(twice, ["h1", "h2"], "left_semi").select("d", "r", (F.col("start") * 256).alias("span"))
    early = marks.select("d", "r", F.explode("spans").alias("span"))
    spans = early.unionByName(late).repartition(n, "d", "r").groupBy("d", "r").agg(F.collect_set("span").alias("spans"))
    joined = dealt.join(spans, ["d", "r"], "left").drop("d", "r")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            at = batch.schema.names.index(text)
            texts, counts, removed = [], [], []
            for body, spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1)):
                words = (body or "").encode().split()
                counts.append(len(words))
                if spans.is_valid:
                    span = spans.values.to_numpy(zero_copy_only=False)
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, span >> 8, 1)
                    np.add.at(edge, (span >> 8) + (span & 255) + window, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    words = [word for word, drop in zip(words, gone.tolist()) if not drop]
                removed.append(counts[-1] - len(words))
                texts.append(b" ".join(words).decode())
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "n_words", "n_removed"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema) + ", n_words long, n_removed long"
    return joined.mapInArrow(run, schema).toDF(*names, "n_words", "n_removed")
