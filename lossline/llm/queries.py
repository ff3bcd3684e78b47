"""The registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossline.llm import ball_tree, bpe, chat, decontaminate, langid, line_dedup, mixing_lm, near_dup, periodic_runs, recompression, shards, token_files, whitening
from lossline.llm.common import load, pick, settle, write

#: Where the vocabulary files lie; a parameter, since they belong to another package.
VOCABULARY = "word_bpe_49k.json"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            settle(spark)
            return build(spark, folder)

        _QUERIES[name] = run
        if oracle is not None:
            _ORACLE[name] = oracle
        return run

    return register


@query("op1_bpe")
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(load(spark, folder, "documents"), vocabulary_path()))


@query("op6_langid")
def op6_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = pick(load(spark, folder, "documents"), "doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


LINES_SQL = """
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, text FROM documents
), lines AS (
  SELECT k, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), hot AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT k) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (hot.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN hot USING (key)
GROUP BY k, doc_id
"""


@query("op2_line_dedup", LINES_SQL)
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = pick(load(spark, folder, "documents"), "doc_id", "text")
    kept = line_dedup.dedup_lines(docs, threshold=10, least=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


GROUPS_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) r(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y USING (g)
                    WHERE x.doc_id <> y.doc_id GROUP BY ALL) JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * c >= 85 * (s.n + t.n - c)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, min(other) = doc_id AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


@query("op10_near_dup", GROUPS_SQL)
def op10_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(load(spark, folder, "documents"), percent=85)


WINDOWS_SQL = """
WITH doc_words AS (
  SELECT row_number() OVER () AS k, doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS w FROM documents
), item_words AS (
  SELECT item_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS span, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS words
  FROM item_words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(s) WHERE len(w) > 0
), spans AS (SELECT DISTINCT span FROM item_windows
), doc_windows AS (
  SELECT k, s, span, array_to_string(w[s : s + span - 1], ' ') AS words
  FROM doc_words, spans, unnest(range(1, len(w) - span + 2)) t(s)
), found AS (
  SELECT k, s, span, item_id FROM doc_windows JOIN item_windows USING (span, words)
), hit AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(s, s + span)) AS p FROM found) GROUP BY k
), items AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY k
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (k) LEFT JOIN items USING (k)
"""


@query("op7_decontaminate", WINDOWS_SQL)
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontaminate(load(spark, folder, "documents"), load(spark, folder, "benchmark"))
    ids = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids, "contaminated")


@query("op9_token_files")
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write_tokens(load(spark, folder, "documents"), vocabulary_path(), end_id=1)
    return token_files.read_tokens(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(role) + len(regexp_extract_all(role, '\\|### |</turn>|: |\n'))
                + length(text) + len(regexp_extract_all(text, '\\|### |</turn>'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query("op3_chat", CHAT_SQL)
def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = pick(load(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    hostile = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hostile), (-7, 1, "assistant", hostile)], rows.schema)
    formatted = chat.format_paths(chat.linear(rows.unionByName(extra)), best=1)
    formatted = write(formatted, "formatted")
    back = chat.read_back(formatted)
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    digests = back.select(
        F.col("tree").alias("t"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
    )
    sizes = formatted.select(F.col("tree").alias("conv_id"), F.length("formatted").cast("long").alias("formatted_chars"))
    return sizes.join(digests, F.expr("conv_id <=> t")).drop("t")


@query("op8_shards")
def op8_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.interleave(load(spark, folder, "documents"), shards=40)
    none = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none)


SEARCH_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
"""


@query("op5_ball_tree", SEARCH_SQL)
def op5_ball_tree(spark: SparkSession, folder: str) -> DataFrame:
    vectors = write(ball_tree.usable(load(spark, folder, "embeddings"), scale=1024), "vectors")
    return ball_tree.search(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


REPEATS_SQL = """
WITH d AS (
  SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s : s + 34], ' ') AS t FROM d, unnest(range(1, len(w) - 33)) r(s)
), twice AS (SELECT t FROM windows GROUP BY t HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM windows SEMI JOIN twice USING (t)
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
), kept AS (
  SELECT doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS kept
  FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op4_recompression", REPEATS_SQL)
def op4_recompression(spark: SparkSession, folder: str) -> DataFrame:
    kept = recompression.remove_repeats(pick(load(spark, folder, "documents"), "doc_id", "text"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


RUNS_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS k, doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w,
         xor(4294967295, list_reduce(list_concat([4294967295], [ascii(x) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
           lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
             lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS h
  FROM documents
), sized AS (
  SELECT k, doc_id, w, len(w) AS n, coalesce(h % 10 = 0, false) AND len(w) > 0 AS planted, h // 10 AS g FROM split
), started AS (SELECT *, CASE WHEN planted THEN g % n ELSE n END AS a FROM sized
), d AS (
  SELECT k, doc_id, n, [w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1] FOR i IN range(n)] AS w
  FROM started
), words AS (
  SELECT k, n, unnest(w) AS word, unnest(range(n)) AS i FROM d
), pairs AS (
  SELECT x.k, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.k = y.k AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n
), islands AS (
  SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM pairs
), stretches AS (
  SELECT k, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY k, q, island
), runs AS (
  SELECT k, start, length, min(q) AS period FROM stretches WHERE length >= greatest(12, 2 * q) GROUP BY k, start, length
), told AS (
  SELECT k, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS told,
         max(struct_pack(length := length, start := -start, period := -period)) AS best
  FROM runs GROUP BY k
), gone AS (
  SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT k, string_agg(word, ' ' ORDER BY words.i) AS kept FROM words ANTI JOIN gone USING (k, i) GROUP BY k
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best.start AS start, best.length AS length, -best.period AS period,
       1000 * best.length // -best.period AS exponent_milli, sha256(coalesce(told, '')) AS runs_sha256,
       sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (k) LEFT JOIN kept USING (k)
"""


def with_periods(docs: DataFrame) -> DataFrame:
    """The given documents with the periods that the contract of operator 11 plants: of doc_ids whose crc32 is h, with
    h % 10 = 0 and g = h div 10, the words from a = g % n on repeat the p = 1 + (n - a) div (3 + g % 8) words from a."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    docs = docs.withColumns({"h": h, "w": F.when(h % 10 == 0, words)})
    docs = docs.withColumns({"n": F.size("w").cast("long"), "g": F.expr("h div 10")}).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    period = F.expr("slice(w, cast(a + 1 AS int), cast(1 + (n - a) div (3 + g % 8) AS int))")
    times = F.expr("cast(4 + g % 8 AS int)")  # as many periods as reach beyond the end
    long = F.concat(F.expr("slice(w, 1, cast(a AS int))"), F.flatten(F.array_repeat(period, times)))
    text = F.when(F.col("n") > 0, F.array_join(F.slice(long, F.lit(1), F.col("n").cast("int")), " ")).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query("op11_periodic_runs", RUNS_SQL)
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = pick(load(spark, folder, "documents"), "doc_id", "text")
    return periodic_runs.digests(periodic_runs.runs(with_periods(docs), least=12))


@query("op12_mixing_lm")
def op12_mixing_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = pick(load(spark, folder, "documents"), "doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    model, counts = mixing_lm.fit(docs.filter(~held_out))
    found = mixing_lm.score(docs, model, counts, keep_text=False)
    tokens = F.lit(model.tokens).cast("long").alias("train_tokens")
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", tokens, "base_score", "score")


@query("op13_whitening")
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = whitening.whiten(pick(load(spark, folder, "embeddings"), "vec_id", "embedding"), scale=64, shift=1_000_000, most=16)
    explained = model.values / model.trace if model and model.trace > 0 else []
    return rows.select(
        "vec_id",
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),  # null beyond 64 bits
        F.posexplode("whitened").alias("at", "whitened"),
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, map(float, explained))).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
