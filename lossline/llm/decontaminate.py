"""Words of documents that repeat a window of a benchmark item, found by a prefix-filtered join; DataFrame functions only.

The words of a window are ordered by how often the corpus has them. All of them must occur, so the prefix that has to be
joined is the rarest word alone. Each place of that word in a document leaves one place for the window; it must lie
within the document (position and length), and the words there are compared with the window's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lossline.llm.common import hidden, pick, write

WINDOW = 10
#: What separates words, and the letters that are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> F.Column:
    """The words of a text as they are spelled; none for null."""
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SEPARATORS), lambda w: w != "")


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, words, span: the different windows of each item; an item of fewer words, but not none, is one window."""
    spelled = pick(items, "item_id", "text").withColumn("w", words_of("text")).filter(F.size("w") > 0)
    lowered = spelled.withColumn("w", F.transform("w", lambda w: F.translate(w, UPPER, LOWER)))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))
    cut = lowered.select("item_id", "w", F.explode(starts).alias("start"))
    return cut.select("item_id", F.slice("w", F.col("start"), F.lit(window)).alias("words")).distinct().withColumn("span", F.size("words"))


def spelled(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, spelled (words), more. A generator of one row keeps Spark from working out the words again and again."""
    return docs.select("doc_id", *more, F.explode(F.array(words_of("text"))).alias("spelled"))


def row_key(doc_id: str, text: str) -> F.Column:
    """What tells a row: doc_id and 128 bits of the text. Equal rows share it, and all that is said of them."""
    return F.struct(F.col(doc_id).alias("id"), *[F.xxhash64(F.lit(salt), text).alias(f"k{salt}") for salt in (1, 2)])


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, start, span, items: every place of a window in a document. docs: doc_id (of any type), text."""
    # The word as Spark lower-cases it is a coarser key than A-Z alone: equal windows agree on it, and the comparison
    # at the end is the exact one.
    numbered = windows.groupBy("words").agg(F.collect_set("item_id").alias("items")).withColumn("window", F.xxhash64("words"))
    numbered = write(numbered, "windows")
    tokens = numbered.select("window", "words", F.posexplode("words").alias("at", "word")).withColumn("token", F.lower("word"))
    # Written, so that Spark knows the size before it plans: a small one is sent to the words, a large one makes a shuffle.
    vocabulary = write(tokens.select("token").distinct(), "vocabulary")
    corpus = spelled(docs).select(F.explode_outer("spelled").alias("word")).select(F.lower("word").alias("token"))
    counts = corpus.join(vocabulary, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarity = tokens.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # A window with a word that the corpus lacks occurs nowhere.
    prefixes = write(
        rarity.groupBy("words")
        .agg(F.min(F.struct("n", "token", "at")).alias("p"))
        .filter("p.n > 0")
        .select("words", F.size("words").alias("span"), F.col("p.token").alias("token"), F.col("p.at").alias("at")),
        "prefixes",
    )
    rare = write(prefixes.select("token").distinct(), "rare")
    places = spelled(docs).select("doc_id", F.size("spelled").alias("n_words"), F.posexplode_outer("spelled").alias("pos", "word"))
    found = (
        places.select("doc_id", "n_words", "pos", F.lower("word").alias("token"))
        .join(rare, "token", "left_semi")
        .join(prefixes, "token")
        .withColumn("start", F.col("pos") - F.col("at"))
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("span") <= F.col("n_words")))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("start", "span", "words")).alias("places"))  # rows of equal text share theirs
    )

    def there(place):
        return F.transform(F.slice("spelled", place["start"] + 1, place["span"]), lambda w: F.translate(w, UPPER, LOWER))

    # Whole texts are dealt out once and cut into words where a document has candidates.
    met = spelled(docs.join(found, "doc_id"), "places")
    same = met.select("doc_id", F.inline(F.filter("places", lambda p: there(p) == p["words"])))
    return same.join(numbered.select("words", "items"), "words").select("doc_id", "start", "span", "items")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (their ids as sorted strings), contaminated, for every row of docs.

    A word is hit if it lies in any occurrence of a window; overlapping occurrences count a word once. Null and empty
    texts have no words. Items without words, or with null text, have no window; a null item_id names no item. Every row is
    judged by its own text, also where others have its doc_id or it has none.
    """
    rows = pick(docs, "doc_id", "text")
    read = rows.select(row_key("doc_id", "text").alias("doc_id"), "text")
    found = write(occurrences(read, windows_of(items, window)), "occurrences")
    order = Window.partitionBy("doc_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.groupBy("doc_id", "start").agg(F.max(F.col("start") + F.col("span")).alias("end"))
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(order), F.lit(0))))
    hits = spans.withColumn("covered", covered).groupBy("doc_id").agg(F.sum("covered").alias("n_hit"))
    named = found.select("doc_id", F.explode("items").alias("item")).groupBy("doc_id").agg(F.collect_set(F.col("item").cast("string")).alias("items"))
    about = hits.join(named, "doc_id", "left")
    counted = rows.select(
        F.col("doc_id").alias("own_id"), row_key("doc_id", "text").alias("doc_id"), F.size(words_of("text")).cast("long").alias("n_words")
    )
    none = F.array().cast("array<string>")
    return counted.join(about, "doc_id", "left").select(
        F.col("own_id").alias("doc_id"),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.array_sort(F.coalesce("items", none)).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs, all columns, without a hit. Every row is judged by its own text."""
    inner, names, (doc_id, text) = hidden(docs, "doc_id", "text")
    read = inner.select(row_key(doc_id, text).alias("doc_id"), F.col(text).alias("text"))
    hit = write(occurrences(read, windows_of(items, window)).select(F.col("doc_id").alias("_hit")).distinct(), "hit")
    keyed = inner.withColumn("_key", row_key(doc_id, text))
    return keyed.join(hit, F.col("_key") == F.col("_hit"), "left_anti").select(*inner.columns).toDF(*names)
