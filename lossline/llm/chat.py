"""Reply trees to training conversations: paths by self-joins, chosen by score, one marked-up text for each.

A turn is written as `### Role: text</turn>` and a line end. Inside roles and texts, and only there, a control string is
preceded by a backslash, and so is a backslash; taking those away gives back the text. The loss mask of a conversation is
a list of [start, end) code points: the texts of assistant turns (escaped as they stand there). A turn that several chosen
paths share is masked in the best of them only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lossline.llm.common import parts, pick, ranked, write

# Fixed values of the template.
HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
LEARNED = "assistant"
#: What a parser looks for, and what shields it.
CONTROL = re.compile(r"\\|### |</turn>|: |\n")
IN_TEXT = re.compile(r"\\|### |</turn>")
SHIELDED = re.compile(r"\\(\\|### |</turn>|: |\n)")


def escape(text: str, role: bool = False) -> str:
    """Texts keep colons and line ends as they are; a role is shielded from them too, since it ends at one."""
    return (CONTROL if role else IN_TEXT).sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return SHIELDED.sub(r"\1", text)


def turn(role: str, text: str) -> str:
    return f"{HEAD}{escape(role, True)}{MIDDLE}{escape(text)}{END}"


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn, as they were before."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(HEAD, at):
            raise ValueError(f"no turn at {at}")
        role, at = _until(formatted, at + len(HEAD), MIDDLE)
        text, at = _until(formatted, at, END)
        out.append((unescape(role), unescape(text)))
    return out


def _until(formatted: str, at: int, mark: str) -> tuple[str, int]:
    """What stands before the next mark that no backslash shields, and where the mark ends."""
    begin = at
    while True:
        stop, shield = formatted.find(mark, at), formatted.find("\\", at)
        if stop < 0:
            raise ValueError("a turn has no end")
        if shield < 0 or stop < shield:
            return formatted[begin:stop], stop + len(mark)
        found = SHIELDED.match(formatted, shield)
        if not found:
            raise ValueError(f"a lone backslash at {shield}")
        at = found.end()


# --- trees -------------------------------------------------------------------------------


def linear(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees in which each turn replies to the one before it.

    Turns are ordered by turn, role and text (nulls first), so repeated and tied rows have a defined place. Null roles
    and texts count as empty. All rows without conv_id are one conversation.
    """
    read = pick(rows, "conv_id", "turn", "role", "text")
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    placed = write(ranked(read, "place", *order), "turns")  # a conversation of very many turns lies in several partitions
    first = placed.groupBy(F.col("conv_id").alias("tree")).agg(F.min("place").alias("first"))
    return placed.join(first, F.expr("conv_id <=> tree")).select(
        "tree",
        F.col("place").alias("node"),
        F.when(F.col("place") > F.col("first"), F.col("place") - 1).alias("parent"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(0.0).alias("score"),
    )


def paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """tree, path, leaf, depth, node: the turns of the `best` root-to-leaf paths of each tree, path 1 first.

    nodes: tree, node, parent (null: a root), score. Self-joins double the distance to an ancestor each time and add up
    scores on the way, so a path of n turns takes about log2(n) joins. A path's score is the mean of its turns'; ties go
    to the smaller leaf. A reply to a node that is missing begins a path; nodes in a cycle hang on no root and are left
    out. Null scores count as 0.
    """
    own = pick(nodes, "tree", "node", "parent", "score")
    here = own.select("tree", "node").withColumnRenamed("node", "parent").withColumn("_there", F.lit(True))
    joined = own.alias("o").join(here.alias("h"), F.expr("o.tree <=> h.tree AND o.parent = h.parent"), "left")
    start = joined.select(
        "o.tree", "o.node", F.when(F.col("h._there"), F.col("o.parent")).alias("up"), F.coalesce("o.score", F.lit(0.0)).cast("double").alias("total"),
        F.lit(1).cast("long").alias("depth"),
    )
    known = write(start, "hops")  # every node, with its ancestor so far
    hops, longest, rows = [], 1, known.count()
    while True:
        # Nodes that hang on a root already are looked up, but don't go on.
        hops.append(known.filter("up IS NOT NULL"))
        if longest > rows or not hops[-1].limit(1).count():
            break
        below, above = hops[-1].alias("b"), known.alias("a")
        doubled = below.join(above, F.expr("b.tree <=> a.tree AND b.up = a.node")).select(
            "b.tree",
            "b.node",
            "a.up",
            (F.col("b.total") + F.col("a.total")).alias("total"),
            (F.col("b.depth") + F.col("a.depth")).alias("depth"),
        )
        known = write(known.filter("up IS NULL").unionByName(doubled), "hops")
        longest *= 2
    replied = hops[0].select(F.col("tree").alias("t"), F.col("up").alias("n")).distinct()
    last = known.filter("up IS NULL")
    leaves = last.join(replied, F.expr("tree <=> t AND node = n"), "left_anti")
    ranked = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), "node")
    chosen = leaves.withColumn("path", F.row_number().over(ranked)).filter(F.col("path") <= best)
    # Every distance is one sum of powers of two, so each ancestor is reached once.
    reached = chosen.select("tree", "path", F.col("node").alias("leaf"), "node")
    for hop in reversed(hops[:-1]):
        up = hop.select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        further = reached.join(up, F.expr("tree <=> t AND node = n")).select("tree", "path", "leaf", F.col("up").alias("node"))
        reached = write(reached.unionByName(further), "paths")
    depths = last.select(F.col("tree").alias("t"), F.col("node").alias("n"), "depth")
    return reached.join(depths, F.expr("tree <=> t AND node = n")).select("tree", "path", "leaf", "depth", "node")


def _single(nodes: DataFrame) -> DataFrame:
    """One row for each (tree, node): of several the smallest by parent, role, text and score."""
    read = pick(nodes, "tree", "node", "parent", "role", "text", "score")
    least = F.min(F.struct("parent", "role", "text", "score")).alias("x")
    return write(read.groupBy("tree", "node").agg(least).select("tree", "node", "x.*"), "nodes")


def format_paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """tree, path, formatted, mask (array of [start, end) code points): one conversation for each chosen path.

    Rows that repeat a node count once. The turns of a path meet in its order in one partition and are written out as they come; a task holds no more than
    the one text that it is making.
    """
    nodes = _single(nodes)
    chosen = paths(nodes, best)
    # A turn is learned from in the first path that has it.
    first = chosen.groupBy("tree", "node").agg(F.min("path").alias("first"))
    told = pick(nodes, "tree", "node", "role", "text")
    rows = (
        chosen.alias("c")
        .join(first.alias("f"), F.expr("c.tree <=> f.tree AND c.node = f.node"))
        .join(told.alias("t"), F.expr("c.tree <=> t.tree AND c.node = t.node"))
        .select("c.tree", "c.path", "c.depth", F.coalesce("t.role", F.lit("")).alias("role"), F.coalesce("t.text", F.lit("")).alias("text"), F.expr("c.path = f.first").alias("fresh"))
    )
    kind = rows.schema["tree"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces, at, mask = None, [], 0, []

        def done():
            return pa.RecordBatch.from_arrays(
                [key[0], pa.array([key[1]], pa.int32()), pa.array(["".join(pieces)], pa.string()), pa.array([mask], pa.list_(pa.list_(pa.int64())))],
                names=["tree", "path", "formatted", "mask"],
            )

        for batch in batches:
            trees = batch.column(0)
            plain = trees.to_pylist()
            for i, (tree, path, role, text, fresh) in enumerate(zip(plain, *(batch.column(c).to_pylist() for c in (1, 3, 4, 5)))):
                if key is None or (key[2], key[1]) != (tree, path):
                    if key is not None:
                        yield done()
                    key, pieces, at, mask = (trees.slice(i, 1), path, tree), [], 0, []
                written = turn(role, text)
                if role == LEARNED and fresh:
                    begin = at + len(written) - len(END) - len(escape(text))
                    mask.append([begin, at + len(written) - len(END)])
                pieces.append(written)
                at += len(written)
        if key is not None:
            yield done()

    dealt = rows.repartition(parts(nodes), "tree", "path").sortWithinPartitions("tree", "path", "depth")
    return dealt.mapInArrow(run, f"tree {kind}, path int, formatted string, mask array<array<long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """tree, path, turns (role, text), loss (the masked texts, unescaped, side by side) of formatted conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            for i in range(batch.num_rows):
                text, mask = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                turns = [{"role": r, "text": t} for r, t in parse(text)]
                loss = "".join(unescape(text[a:b]) for a, b in mask)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([turns], kind), pa.array([loss], pa.string())],
                    names=["tree", "path", "turns", "loss"],
                )

    kind = formatted.schema["tree"].dataType.simpleString()
    return formatted.select("tree", "path", "formatted", "mask").mapInArrow(
        run, f"tree {kind}, path int, turns array<struct<role: string, text: string>>, loss string"
    )
