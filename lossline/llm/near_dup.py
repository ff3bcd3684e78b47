"""Groups of near-copies: SuperMinHash signatures, banding, confirmation on full shingle sets, connected components.

Documents of equal shingle sets are one class; only classes are compared. Within a bucket (band, value) no pairs are
enumerated: members are compared with a few pivots at a time, links join labels, and only members whose label still
differs go on, until every pair of a bucket was compared or lies in one component. Members whose own shingles (those no
other undecided member has) rule out any link are left out, which is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lossline.llm.common import parts, pick, slices, write
from lossline.llm.words import mix, split_words

WORDS = 5
#: Bands of ROWS values; at a similarity of 0.85, 1 pair in 2.6 million shares no band; at 0.8, 1 in 38,000.
BANDS, ROWS = 20, 4
SLOTS = BANDS * ROWS
#: Two sets have at most the sum of the smaller counts of each part in common.
PARTS = 128
#: Pivots of a bucket in the first round; each later round has as many times more.
PIVOTS = 64
PLACES = np.random.default_rng(5).integers(1, 1 << 62, WORDS + 1, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the first of each text (one more at the end).

    A text of fewer words, but not none, has its whole sequence as one shingle.
    """
    w = split_words([t.lower() for t in texts])
    total, counts = len(w.hash), np.diff(w.first)
    rolled = np.zeros(total, np.uint64)
    for i in range(words):
        rolled[: max(0, total - i)] += w.hash[i:] * PLACES[i]
    rolled = mix(rolled)
    sets, sizes = [], []
    for a, b, n in zip(w.first[:-1].tolist(), w.first[1:].tolist(), counts.tolist()):
        if n >= words:
            found = np.unique(rolled[a : b - words + 1])
        elif n:
            found = mix(np.sum(w.hash[a:b] * PLACES[:n], keepdims=True) + PLACES[words:] * np.uint64(n))
        else:
            found = rolled[:0]
        sets.append(found)
        sizes.append(len(found))
    return (np.concatenate(sets) if sets else rolled), np.cumsum([0, *sizes])


def super_minhash(values: np.ndarray, first: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signature of each set, one a row (infinite for an empty set).

    In step j each element draws a number in [j, j + 1) for the j-th slot of its own random permutation of the slots.
    The steps of a set end once all its slots are filled, since later numbers are larger.
    """
    sizes = np.diff(first)
    out = np.full((len(sizes), slots), np.inf)
    element, owner = values, np.repeat(np.arange(len(sizes)), sizes)
    order = None
    for j in range(slots):
        drawn = mix(element + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        number = j + (drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53
        target = j + (mix(drawn) % np.uint64(slots - j)).astype(np.int64)
        if order is None:
            slot = target
        else:
            rows = np.arange(len(element))
            slot = order[rows, target].astype(np.int64)
            order[rows, target] = order[:, j]
        np.minimum.at(out, (owner, slot), number)
        open_sets = np.isinf(out).any(axis=1) & (sizes > 0)
        if not open_sets.any():
            break
        keep = open_sets[owner]
        if order is None:
            element, owner = element[keep], owner[keep]
            order = np.broadcast_to(np.arange(slots, dtype=np.uint16), (len(element), slots)).copy()
            order[np.arange(len(element)), slot[keep]] = 0
        elif not keep.all():
            element, owner, order = element[keep], owner[keep], order[keep]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit value for each band of each signature; bands have different values even for equal numbers."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signature), BANDS))
    for i in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return key


def row_keys(doc_id: str, text: str) -> dict[str, F.Column]:
    """k1, k2: 128 bits that tell rows of different doc_id or text apart, null or not; equal rows share them."""
    row = F.col(doc_id).cast("long"), F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return {f"k{salt}": F.xxhash64(F.lit(salt), *row) for salt in (1, 2)}


def _read(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[key.alias(name) for name, key in row_keys("doc_id", "text").items()],
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, n_shingles, s1, s2 (digest of the whole set), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, first = shingle_sets(batch.column(3).to_pylist())
            sizes = np.diff(first)
            sums = [np.r_[np.uint64(0), np.cumsum(mix(values ^ np.uint64(salt)), dtype=np.uint64)] for salt in (0x51, 0xA7)]
            digests = [(s[first[1:]] - s[first[:-1]]).astype(np.uint64).view(np.int64) for s in sums]
            keys = band_keys(super_minhash(values, first)).view(np.int64)
            bands = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes), *map(pa.array, digests), bands],
                names=["doc_id", "k1", "k2", "n_shingles", "s1", "s2", "bands"],
            )

    return _read(docs).mapInArrow(run, "doc_id long, k1 long, k2 long, n_shingles long, s1 long, s2 long, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, shingles, counts: the whole set of each wanted class (wanted: rep, k1, k2 of a row of it, s1), one row each, and how
    many of its shingles fall into each of PARTS parts of all hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, first = shingle_sets(batch.column(1).to_pylist())
            sums = np.r_[np.uint64(0), np.cumsum(mix(values ^ np.uint64(0x51)), dtype=np.uint64)]
            same = (sums[first[1:]] - sums[first[:-1]]).view(np.int64) == batch.column(2).to_numpy()
            sets = pa.ListArray.from_arrays(first.astype(np.int32), pa.array(values.view(np.int64)))
            part = (values >> np.uint64(40)).astype(np.int64) % PARTS + np.repeat(np.arange(len(same)) * PARTS, np.diff(first))
            counts = np.bincount(part, minlength=len(same) * PARTS).astype(np.int32)
            counts = pa.ListArray.from_arrays(np.arange(0, counts.size + 1, PARTS, dtype=np.int32), pa.array(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), sets, counts], names=["rep", "shingles", "counts"]).filter(pa.array(same))

    rows = _read(docs).join(wanted, ["k1", "k2"])
    return rows.select("rep", "text", "s1").mapInArrow(run, "rep long, shingles array<long>, counts array<int>").dropDuplicates(["rep"])


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for every node but that smallest. edges: a, b.

    Alternates large-star and small-star until nothing changes; each step reduces before it shuffles.
    """
    seen = None
    now = write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "star")
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = write(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "star")


class _Links:
    """Which pairs of classes are linked; sets are read once, from a table of those that share a bucket."""

    def __init__(self, sets: DataFrame, percent: int):
        self.sets, self.percent = sets, percent

    def possible(self, x: str, y: str, common: F.Column) -> F.Column:
        """If that many common shingles (at most) can make a link of sets of x and y shingles."""
        return common * (100 + self.percent) >= self.percent * (F.col(x) + F.col(y))

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Of pairs a < b the linked ones, compared on full sets."""
        a = self.sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
        b = self.sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
        compared = pairs.select("a", "b").join(b, "b").join(a, "a")
        common, sizes = F.size(F.array_intersect("sa", "sb")), F.size("sa") + F.size("sb")
        return compared.filter(common * 100 >= self.percent * (sizes - common)).select("a", "b")


def _relabel(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """label of rows after labels were joined to components."""
    named = labels.select(F.col("node").alias("label"), F.col("label").alias("_to"))
    return rows.join(named, "label", "left").withColumn("label", F.coalesce("_to", "label")).drop("_to")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row, as told by groups()."""
    return groups(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def groups(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, k1, k2, n_shingles, component (null without words), component_id, kept for every row.

    Rows are linked if 100 * |A & B| >= percent * |A | B| for their sets of lower-cased (A-Z) five-word shingles.
    component_id is the smallest doc_id of all rows that a chain of links reaches; kept says that it is the row's own.
    A text without words, or null, has an empty set and stays alone. Rows that repeat a doc_id are judged by their own
    text, and both are kept if it is the smallest. Two components may thus have one component_id; component tells them apart. A row without doc_id is linked as any other, but
    leads none: its component_id is null if no row of the component has an id, and all of them count as kept. An empty table gives an empty one.
    """
    rows = write(sketches(docs), "sketches")
    sized = rows.filter(F.col("n_shingles") > 0)
    # Named by their place in the order of their smallest doc_ids: a doc_id may have rows of several classes.
    order = F.col("least").asc_nulls_last(), F.col("s1"), F.col("s2")
    classes = write(
        sized.groupBy("s1", "s2")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct("k1", "k2")).alias("row"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
        .repartitionByRange(parts(docs), *order)
        .sortWithinPartitions(*order)
        .withColumn("rep", F.monotonically_increasing_id()),
        "classes",
    )
    keyed = classes.select("rep", "n", F.explode("bands").alias("key"))
    pivots = keyed.groupBy("key").agg(F.min("rep").alias("pivot"), F.min_by("n", "rep").alias("pn"), F.count(F.lit(1)).alias("members"))
    # Written first: Spark splits the hot keys of a join only where both sides come as they were dealt.
    shared = write(pivots.filter(F.col("members") > 1).drop("members"), "buckets")
    members = write(keyed.join(shared, "key").withColumn("label", F.col("rep")), "members")
    wanted = classes.select("rep", "row.k1", "row.k2", "s1").join(members.select("rep").distinct(), "rep", "left_semi")
    links = _Links(write(full_sets(docs, wanted), "sets"), percent)

    close = F.least("n", "pn") * 100 >= F.greatest("n", "pn") * percent
    pairs = members.filter((F.col("rep") != F.col("pivot")) & close).select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
    pairs = write(pairs.distinct(), "pairs")
    labels = components(links.confirm(pairs))
    live = members.filter(F.col("rep") != F.col("pivot")).select("key", "rep", "n", "label")
    live = _undecided(_relabel(live, labels))
    if live.limit(1).count():
        live = _without_loners(live, links)
    some = PIVOTS
    while live.limit(1).count():
        pivot_of = (
            live.groupBy("key", F.pmod(F.xxhash64("rep", F.lit(some)), F.lit(some)).alias("part"))
            .agg(F.min(F.struct("own", "rep", "n", "label", "counts")).alias("p"))
            .select("key", F.col("p.rep").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.own").alias("pown"), F.col("p.label").alias("plabel"), F.col("p.counts").alias("pcounts"))
        )
        pivot_of = write(pivot_of, "pivots")
        common = F.least(F.col("n") - F.col("own"), F.col("pn") - F.col("pown"))
        smaller = F.aggregate(F.zip_with("counts", "pcounts", lambda a, b: F.least(a, b)), F.lit(0), lambda a, b: a + b)
        apart = F.col("label") != F.col("plabel")
        new = (
            live.join(pivot_of, "key")
            .filter(F.when(apart & links.possible("n", "pn", common), links.possible("n", "pn", smaller)).otherwise(False))
            .select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))
            .distinct()
            .join(pairs, ["a", "b"], "left_anti")
        )
        new = write(new, "pairs")
        pairs = pairs.unionByName(new)
        found = write(links.confirm(new), "links")
        live = live.join(pivot_of.select("key", F.col("pivot").alias("rep")), ["key", "rep"], "left_anti")
        if found.limit(1).count():
            labels = components(found.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))
            live = _relabel(live.withColumn("label", F.col("rep")), labels)
        live = _undecided(live)
        some *= PIVOTS

    named = classes.select("s1", "s2", "least", F.col("rep").alias("label"))
    named = write(_relabel(named, labels), "named")
    ids = write(named.groupBy("label").agg(F.min("least").alias("id")), "components")
    out = rows.join(named.drop("least").join(ids, "label"), ["s1", "s2"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("id"))
    return out.select(
        "doc_id", "k1", "k2", "n_shingles", F.col("label").alias("component"), own.alias("component_id"), own.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def _undecided(live: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one label."""
    mixed = live.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("key")
    return write(live.join(mixed, "key", "left_semi"), "undecided")


def _without_loners(live: DataFrame, links: _Links) -> DataFrame:
    """Count the shingles that only one undecided class has (own), and drop members that too many of them cut off.

    A partner has at least as many shingles as the smallest member of the bucket, and shares at most n - own.
    """
    single = (
        links.sets.join(live.select("rep").distinct(), "rep", "left_semi")
        .select("rep", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("rep"))
        .filter("c = 1")
    )
    own = single.groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    counted = live.join(own, "rep", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    least = counted.groupBy("key").agg(F.min("n").alias("least"))
    able = counted.join(least, "key").filter(links.possible("n", "least", F.col("n") - F.col("own"))).drop("least")
    return _undecided(able.join(links.sets.select("rep", "counts"), "rep"))
