"""From raw documents to token ids in five stages, each one operator over all rows that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossline.llm import bpe, decontaminate, langid, line_dedup, near_dup
from lossline.llm.common import hidden, load, settle, write
from lossline.llm.queries import vocabulary_path

#: Below this probability a text has no clear language. Four languages in equal parts would have a quarter each.
LEAST_LANGUAGE_SCORE = 0.35
#: Shares of common word shingles from which two documents are near copies.
LEAST_SIMILARITY_PERCENT = 80


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """changed (the columns of docs, then others) with the columns of docs only, the length of the text brought up to date."""
    kept, names, (text,) = hidden(changed, "text")
    kept = kept.select(*kept.columns[: len(docs.columns)])
    if "n_chars" in docs.columns:
        at = kept.columns[docs.columns.index("n_chars")]
        kept = kept.withColumn(at, F.length(text).cast(kept.schema[at].dataType))
    return kept.toDF(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network can tell; null texts and texts without letters go. The network is fitted on
    the labelled rows of the raw documents that operator 6 may learn from; where there are none, no language can be told
    apart and every document stays."""
    settle(spark)
    model = langid.fit(load(spark, sf_dir, "documents"))
    if model is None:
        return docs
    found = langid.identify(docs, model)
    inner, _, (label, score) = hidden(found, "lang_pred", "lang_score")
    told = inner.filter((F.col(label) != langid.UNDETERMINED) & (F.col(score) >= LEAST_LANGUAGE_SCORE))
    return told.select(*told.columns[: len(docs.columns)]).toDF(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents share; n_chars follows the text."""
    settle(spark)
    return _with_text(docs, line_dedup.dedup_lines(docs, threshold=10, least=1))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: that of the smallest doc_id, of several texts under it that of the smallest
    hash. Rows are judged one by one, so another row of the same doc_id takes none with it; of rows equal in doc_id and text
    one stays, and so does one of a group without doc_id. Documents without words are no copies."""
    settle(spark)
    found = near_dup.groups(docs, percent=LEAST_SIMILARITY_PERCENT).filter(F.col("component").isNotNull())
    found = found.select("component", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k1", "k2").alias("row"))
    found = write(found, "groups")
    first = write(found.groupBy("component").agg(F.min("row").alias("first")), "first")
    dropped = found.join(first, "component").filter(F.col("row") != F.col("first")).select("row.k1", "row.k2").distinct()
    dropped = write(dropped, "copies")
    inner, names, (doc_id, text) = hidden(docs, "doc_id", "text")
    keyed = inner.withColumns(near_dup.row_keys(doc_id, text))
    kept = keyed.join(dropped, ["k1", "k2"], "left_anti")
    # Equal rows are copies of each other: those that stay are taken once.
    several = found.groupBy("row.k1", "row.k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    equal = write(several.select("k1", "k2"), "equal")
    if equal.limit(1).count():
        once = kept.join(equal, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
        kept = kept.join(equal, ["k1", "k2"], "left_anti").unionByName(once)
    return kept.select(*inner.columns).toDF(*names)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    settle(spark)
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the text that they decode to."""
    settle(spark)
    made = bpe.encode_documents(docs, vocabulary_path())
    return made.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

#: A trained network and byte pair encoding have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; between two of them the documents are written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
