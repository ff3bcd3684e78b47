"""Exact search by inner product: a ball tree per shard of the vectors, best-first branch and bound for each query.

A node's ball (centre c, radius r) bounds the score of all its vectors by q.c + |q| r. Nodes are visited in the order of
that bound until it falls below the k-th score so far. A block of queries carries its k-th scores from tree to tree; a
first pass over one tree each gives every later task of the block a score to start with.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lossline.llm.common import parts, pick, write

LEAF = 64
#: Bytes of vectors in one tree, and queries in one block.
TREE_BYTES, BLOCK = 8 << 20, 1024
EXACT = float(1 << 53)
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def usable(rows: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, v: floor(scale * x) of each component as long, of rows whose id and components are all there and finite."""
    read = pick(rows, "vec_id", "embedding").filter(
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    return read.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


# --- one tree ----------------------------------------------------------------------------


class BallTree:
    """Nodes in an array: centre, radius, range of rows, children (-1: a leaf). Rows are ordered by leaf."""

    def __init__(self, ids, rows, centres, radii, spans, children):
        self.ids, self.rows, self.centres, self.radii, self.spans, self.children = ids, rows, centres, radii, spans, children
        self.plain = rows.astype(np.float64)
        self.most = float(np.abs(self.plain).max(initial=0.0))
        self.reach = np.linalg.norm(centres, axis=1) + radii

    @classmethod
    def build(cls, ids: np.ndarray, rows: np.ndarray) -> BallTree:
        order, plain = np.arange(len(ids)), rows.astype(np.float64)
        centres, radii, spans, children = [], [], [], []
        waiting = [(0, len(ids), -1)]
        while waiting:
            a, b, parent = waiting.pop()
            some = plain[order[a:b]]
            centre = some.mean(axis=0)
            away = np.linalg.norm(some - centre, axis=1)
            node = len(centres)
            centres.append(centre)
            radii.append(away.max() * (1 + 1e-9))
            spans.append((a, b))
            children.append([-1, -1])
            if parent >= 0:
                children[parent][children[parent][0] >= 0] = node
            if b - a > LEAF and radii[-1] > 0:
                # Between the point farthest from the centre and the one farthest from that.
                one = some[away.argmax()]
                other = some[np.linalg.norm(some - one, axis=1).argmax()]
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(some @ (other - one), half)]
                waiting += [(a, a + half, node), (a + half, b, node)]
        return cls(ids[order], rows[order], np.array(centres), np.array(radii), np.array(spans), np.array(children))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, rows=self.rows, centres=self.centres, radii=self.radii, spans=self.spans, children=self.children)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> BallTree:
        with np.load(io.BytesIO(data)) as x:
            return cls(*(x[name] for name in ("ids", "rows", "centres", "radii", "spans", "children")))

    def scores(self, a: int, b: int, q: np.ndarray) -> np.ndarray:
        """Exact integer inner products; beyond 64 bits they stop at the ends of the range."""
        bound = self.most * float(np.abs(q).max(initial=0)) * max(1, len(q))
        if bound < EXACT:
            return (self.plain[a:b] @ q.astype(np.float64)).astype(np.int64)
        if bound < LONG_MAX:
            return self.rows[a:b] @ q
        return np.array([min(max(s, LONG_MIN), LONG_MAX) for s in self.rows[a:b].astype(object) @ q.astype(object)], np.int64)

    def search(self, own: int, q: np.ndarray, k: int, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k best of this tree and of those known (ids, scores: best first). Rows of the query's own id don't count."""
        length = float(np.linalg.norm(q.astype(np.float64)))
        bounds = self.centres @ q.astype(np.float64) + length * self.radii + 1e-9 * length * self.reach
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if len(ids) == k and -bound < scores[-1]:
                break
            left, right = self.children[node]
            if left >= 0:
                heapq.heappush(heap, (-bounds[left], left))
                heapq.heappush(heap, (-bounds[right], right))
                continue
            a, b = self.spans[node]
            found, near = self.scores(a, b, q), self.ids[a:b]
            good = near != own
            if len(ids) == k:
                good &= found >= scores[-1]
            if good.any():
                ids, scores = best(np.r_[ids, near[good]], np.r_[scores, found[good]], k)
        return ids, scores


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id; an id counts once, with its best score."""
    order = np.lexsort((ids, ~scores))  # ~x falls as x rises, and has no overflow
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:k]
    return ids[order][first], scores[order][first]


# --- all trees ---------------------------------------------------------------------------


def trees(vectors: DataFrame) -> DataFrame:
    """dim, shard, tree: vectors of a length are dealt to shards by a hash of row and id, a bounded number of bytes each."""
    dims = vectors.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("rows"))
    shards = dims.select("dim", F.greatest(F.lit(1), F.ceil(F.col("rows") * F.col("dim") * 8 / TREE_BYTES)).cast("long").alias("shards"))
    dealt = (
        vectors.withColumn("dim", F.size("v"))
        .join(shards, "dim")
        .select("dim", F.pmod(F.xxhash64("vec_id", "v"), F.col("shards")).alias("shard"), "vec_id", "v")
    )

    def build(key, table):
        dim = key[0].as_py()
        ids = table.column("vec_id").to_numpy()
        rows = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim).astype(np.int64)
        made = BallTree.build(ids, rows) if dim else BallTree(ids, rows, np.zeros((1, 0)), np.zeros(1), np.array([[0, len(ids)]]), np.array([[-1, -1]]))
        return pa.table({"dim": [key[0]], "shard": [key[1]], "tree": pa.array([made.dump()], pa.binary())})

    return dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, shard long, tree binary")


def blocks(queries: DataFrame) -> DataFrame:
    """dim, block, asked (query_id, v, ids and scores known so far): queries of a length, at most about BLOCK together."""
    dims = queries.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("rows"))
    many = dims.select("dim", F.ceil(F.col("rows") / BLOCK).cast("long").alias("blocks"))
    none = F.array().cast("array<long>")
    return (
        queries.withColumn("dim", F.size("v"))
        .join(many, "dim")
        .groupBy("dim", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).alias("block"))
        .agg(F.collect_list(F.struct(F.col("vec_id").alias("query_id"), "v", none.alias("ids"), none.alias("scores"))).alias("asked"))
    )


_ASKED = "array<struct<query_id: bigint, v: array<bigint>, ids: array<bigint>, scores: array<bigint>>>"


def _visit(stream: DataFrame, k: int) -> DataFrame:
    """dim, block, task, asked after the trees of a task. stream: those with asked (first) or tree, sorted by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, []

        def done():
            asked = [{"query_id": i, "v": v.tolist(), "ids": a.tolist(), "scores": s.tolist()} for i, v, a, s in state]
            return pa.RecordBatch.from_pylist([{"dim": key[0], "block": key[1], "task": key[2], "asked": asked}], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                here = tuple(batch.column(c)[i].as_py() for c in range(3))
                if here != key:
                    if state:
                        yield done()
                    key, state = here, []
                asked = batch.column(3)[i].as_py()
                if asked is not None:
                    state = [(x["query_id"], *(np.array(x[n], np.int64) for n in ("v", "ids", "scores"))) for x in asked]
                elif state:
                    tree = BallTree.load(batch.column(4)[i].as_py())
                    state = [(own, q, *tree.search(own, q, k, ids, scores)) for own, q, ids, scores in state]
        if state:
            yield done()

    long = pa.list_(pa.int64())
    schema = pa.schema(
        [("dim", pa.int32()), ("block", pa.int64()), ("task", pa.int64()), ("asked", pa.list_(pa.struct([("query_id", pa.int64()), ("v", long), ("ids", long), ("scores", long)])))]
    )
    dealt = stream.repartition(parts(stream), "dim", "block", "task").sortWithinPartitions("dim", "block", "task", "order")
    return dealt.select("dim", "block", "task", "asked", "tree").mapInArrow(run, f"dim int, block long, task long, asked {_ASKED}")


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best vectors of each query.

    vectors, queries: vec_id, v (longs, see usable). Vectors are compared with those of the same length. Ties go to the
    smaller vec_id. Rows with the query's own id are no candidates; a vec_id with several rows counts once for a query,
    with its best score, and as a query gets the best of all its rows. A query without candidates has no row. A scores
    beyond 64 bits stops at the end of the range.
    """
    built = write(trees(vectors), "trees")
    asked = write(blocks(queries), "blocks")
    many = built.groupBy("dim").agg(F.count(F.lit(1)).alias("trees"))
    # A block is searched by as many tasks as keep the session's partitions busy; each has its share of the trees.
    width = F.greatest(F.lit(1), F.least(F.col("trees") - 1, F.lit(parts(vectors)))).cast("long")
    numbered = asked.join(many, "dim").withColumn("width", width).withColumn("home", F.pmod("block", F.col("trees")))
    none = lambda kind: F.lit(None).cast(kind)
    names = built.select("dim", "shard", F.row_number().over(Window.partitionBy("dim").orderBy("shard")).alias("n")).withColumn("n", F.col("n") - 1)

    def stream(asked_rows: DataFrame, pairs: DataFrame) -> DataFrame:
        first = asked_rows.select("dim", "block", "task", F.lit(0).alias("order"), "asked", none("binary").alias("tree"))
        then = pairs.join(built, ["dim", "shard"]).select("dim", "block", "task", F.lit(1).alias("order"), none(_ASKED).alias("asked"), "tree")
        return first.unionByName(then)

    places = numbered.select("dim", "block", "width", "home").join(names, "dim")  # each block meets each tree
    at_home = places.filter("n = home").withColumn("task", F.lit(0).cast("long"))
    pilot = write(_visit(stream(numbered.withColumn("task", F.lit(0).cast("long")), at_home), k), "pilot")
    rest = places.filter("n <> home").withColumn("task", F.pmod(F.col("n"), F.col("width")).cast("long"))
    again = pilot.drop("task").join(rest.select("dim", "block", "task").distinct(), ["dim", "block"])
    found = pilot.unionByName(_visit(stream(again, rest), k))
    rows = found.select(F.explode("asked").alias("q")).select("q.query_id", F.explode(F.arrays_zip("q.ids", "q.scores")).alias("x"))
    # Each task gives at most k rows a query; rows known from the first pass come back from several tasks.
    single = rows.groupBy("query_id", F.col("x.ids").alias("vec_id")).agg(F.max("x.scores").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return single.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
