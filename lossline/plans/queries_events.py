"""Event intake, window and streaming queries over the events table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F, types as T

from lossline import session
from lossline.config import StreamConfig
from lossline.functions.ordering import ord_ntile
from lossline.operators import events as ev
from lossline.plans.catalog import add
from lossline.plans.oracle import relation, sql
from lossline.sources import projection
from lossline.streaming import keyed, panes, queries as streams, sinks

CFG = StreamConfig()
_NOW = "'2024-02-01 00:00:00'"


def _now():
    """A fixed processing time. Columns need a session, so it is made when a query is built."""
    return F.lit(datetime(2024, 2, 1)).cast("timestamp")


relation("claim_events", """
SELECT event_id, '{' || concat_ws(', ',
         if(event_id % 29 <> 0, '"claim_id": "c-' || (event_id // 2) || '"', NULL),
         '"policy_id": "POL-' || user_id || '"',
         '"accident_date": "' || if(event_id % 37 = 0, 'not-a-date', strftime(ts, '%Y-%m-%d')) || '"',
         '"cause_of_loss": "' || event_type || '"',
         '"estimated_amount": ' || if(event_id % 31 = 0, '-', '') || CAST(value AS DECIMAL(12,2)),
         '"coverage_type": "' || CASE event_type WHEN 'click' THEN 'auto_colision' WHEN 'view' THEN 'hogar_robo'
            WHEN 'signup' THEN 'vida_individual' WHEN 'purchase' THEN 'gastos_medicos_mayores'
            ELSE 'unknown_x' END || '"',
         '"claimant_state": "S' || (user_id % 32) || '"', '"currency": "MXN"',
         '"timestamp": "' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z"') || if(event_id % 41 = 0, '', '}') AS value,
       date_trunc('second', ts) AS event_ts,
       date_trunc('second', ts) + CASE WHEN event_id % 10 = 0 THEN INTERVAL 90 MINUTE
                                       WHEN event_id % 7 = 0 THEN INTERVAL 3 MINUTE
                                       ELSE INTERVAL 0 MINUTE END AS arrival_ts
FROM events
""")
relation("event_fields", """
SELECT *, json_extract_string(j, '$.claim_id') AS claim_id, json_extract_string(j, '$.policy_id') AS policy_id,
       json_extract_string(j, '$.accident_date') AS accident_text, json_extract_string(j, '$.cause_of_loss') AS cause_of_loss,
       json_extract_string(j, '$.estimated_amount') AS amount_text,
       TRY_CAST(json_extract_string(j, '$.estimated_amount') AS DECIMAL(28,6)) AS amount,
       json_extract_string(j, '$.coverage_type') AS coverage_type,
       json_extract_string(j, '$.claimant_state') AS claimant_state, json_extract_string(j, '$.currency') AS currency,
       TRY_CAST(replace(json_extract_string(j, '$.timestamp'), 'Z', '') AS TIMESTAMP) AS event_time
FROM (SELECT *, if(json_valid(value), CAST(value AS JSON), NULL) AS j FROM claim_events)
""")
relation("event_verdicts", """
SELECT *, CASE WHEN j IS NULL THEN 'JSON parse error'
               WHEN claim_id IS NULL THEN 'Missing required field: claim_id'
               WHEN amount <= 0 THEN 'Invalid estimated_amount: ' || amount_text
               WHEN TRY_CAST(accident_text AS DATE) IS NULL THEN 'Invalid accident_date: ' || accident_text
               WHEN coverage_type NOT IN ('auto_colision', 'hogar_robo', 'vida_individual', 'gastos_medicos_mayores')
               THEN 'Unknown coverage_type: ' || coverage_type END AS error_reason
FROM event_fields
""")
relation("good_events", "SELECT * FROM event_verdicts WHERE error_reason IS NULL")


def _judged(d):
    return ev.validate(d.events, _now())


def _valid(d):
    return ev.valid_events(_judged(d), CFG, _now())


add(
    "str_parse",
    lambda d: ev.parse(d.events).select("event_id", F.col("_json").isNotNull().alias("is_json")),
    sql("SELECT event_id, json_valid(value) AS is_json FROM claim_events"),
)
add(
    "str_validate",
    lambda d: _judged(d).select("event_id", "error_type", "error_reason"),
    sql("SELECT event_id, CASE WHEN error_reason LIKE 'JSON%' THEN 'parse' WHEN error_reason IS NOT NULL "
        "THEN 'validate' END AS error_type, error_reason FROM event_verdicts"),
)
add(
    "str_dead_letters",
    lambda d: ev.dead_letters(_judged(d), _now()),
    sql(f"""SELECT value AS raw_data, error_reason, if(error_reason LIKE 'JSON%', 'parse', 'validate') AS error_type,
       {_NOW} AS processing_timestamp FROM event_verdicts WHERE error_reason IS NOT NULL"""),
)
add(
    "str_assign_event_time",
    lambda d: _valid(d).select("event_id", "event_time"),
    sql("SELECT event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time FROM good_events"),
)
add(
    "str_enrich",
    lambda d: _valid(d).drop("event_ts", "arrival_ts", "value"),
    sql(f"""
SELECT event_id, claim_id, policy_id, accident_text AS accident_date, cause_of_loss,
       CAST(amount AS DOUBLE) AS estimated_amount, coverage_type, claimant_state, currency,
       strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, {_NOW} AS processing_timestamp,
       'valid' AS validation_status, '0.1.0' AS pipeline_version
FROM good_events"""),
)

# --- intake -----------------------------------------------------------------------------------

AS_OF = datetime(2024, 1, 20).date()
relation("intake_errors", """
SELECT *, CASE WHEN j IS NULL THEN ['JSON parse error']
               WHEN claim_id IS NULL THEN ['missing required field: claim_id']
               ELSE list_filter([
                 if(amount <= 0, 'estimated_amount must be positive, got ' || CAST(CAST(amount AS DOUBLE) AS VARCHAR), NULL),
                 CASE WHEN TRY_CAST(accident_text AS DATE) IS NULL
                      THEN 'accident_date is not a valid ISO date: ' || accident_text
                      WHEN CAST(accident_text AS DATE) > DATE '2024-01-20'
                      THEN 'accident_date is in the future: ' || accident_text END], lambda x: x IS NOT NULL)
          END AS errors
FROM event_fields
""")


def _intake(d):
    return ev.intake_validate_all(d.events, AS_OF)


add(
    "intake_validate_all",
    lambda d: _intake(d).select("event_id", "validation_status", "reason", F.size("validation_errors").alias("errors")),
    sql("SELECT event_id, if(len(errors) = 0, 'valid', 'invalid') AS validation_status, "
        "array_to_string(errors, '; ') AS reason, len(errors) AS errors FROM intake_errors"),
)


def _route(d):
    valid, invalid = ev.intake_route(_intake(d), _now())
    good = valid.select(F.lit("valid").alias("route"), "claim_id", F.lit("").alias("reason"))
    return good.unionByName(
        invalid.select(F.lit("invalid").alias("route"), F.lit(None).cast("string").alias("claim_id"), "reason")
    )


add(
    "intake_route",
    _route,
    sql("SELECT if(len(errors) = 0, 'valid', 'invalid') AS route, if(len(errors) = 0, claim_id, NULL) AS claim_id, "
        "array_to_string(errors, '; ') AS reason FROM intake_errors"),
)


def _envelopes(d):
    data = F.regexp_replace(F.base64(F.col("value").cast("binary")), r"\s", "")
    whole = F.concat(
        F.lit('{"message": {"data": "'), data, F.lit('", "messageId": "m-'), F.col("event_id").cast("string"),
        F.lit('", "attributes": {"source": "s"}}, "subscription": "claims"}'),
    )
    empty = F.lit('{"subscription": "claims"}')
    return d.events.select("event_id", F.when(F.col("event_id") % 53 == 0, empty).otherwise(whole).alias("envelope"))


add(
    "src_push_envelope",
    lambda d: ev.open_envelopes(_envelopes(d)).drop("envelope"),
    sql("SELECT event_id, if(event_id % 53 = 0, NULL, 'm-' || event_id) AS message_id, "
        "if(event_id % 53 = 0, NULL, value) AS value, if(event_id % 53 = 0, 'no message', NULL) AS error "
        "FROM claim_events"),
)

# --- batch ---------------------------------------------------------------------------------------

relation("keyed_amounts", """
SELECT event_time, ifnull(coverage_type, 'unknown') AS coverage_type, ifnull(amount, 0) AS amount
FROM event_fields WHERE j IS NOT NULL
""")


def _batch(d):
    return ev.batch_parse(d.events, _now())


_SUMS = """count(*) AS claim_count, CAST(round(sum(amount), 2) AS DOUBLE) AS total_amount_mxn,
       CAST(sign(sum(amount)) * ((2 * abs(CAST(sum(amount) * 100 AS BIGINT)) + count(*)) // (2 * count(*))) AS DOUBLE) / 100 AS avg_amount_mxn,
       CAST(round(min(amount), 2) AS DOUBLE) AS min_amount_mxn, CAST(round(max(amount), 2) AS DOUBLE) AS max_amount_mxn"""
_WINDOW = """strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('hour', event_time) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, coverage_type"""

add(
    "batch_parse_claim",
    lambda d: ev.batch_dead_letters(_batch(d), _now()),
    sql(f"SELECT value AS raw_data, 'not JSON' AS error_reason, {_NOW} AS processing_timestamp "
        "FROM event_fields WHERE j IS NULL"),
)
add(
    "batch_key_amount",
    lambda d: ev.batch_key_amount(_batch(d)),
    sql("SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, coverage_type, "
        "CAST(amount AS DOUBLE) AS estimated_amount FROM keyed_amounts"),
)
add(
    "batch_hourly_summary",
    lambda d: ev.window_summary(ev.batch_key_amount(_batch(d))),
    sql(f"SELECT {_WINDOW}, {_SUMS} FROM keyed_amounts GROUP BY date_trunc('hour', event_time), coverage_type"),
)

# --- windows over the valid events -------------------------------------------------------------------

add(
    "src_events_table",
    lambda d: d.source("events").withColumn("value", F.col("value").cast("decimal(12,2)")),
    sql("SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS value) "
        "FROM events"),
)
add(
    "stream_sliding",
    lambda d: ev.window_summary(_valid(d), "1 hour", "20 minutes"),
    sql(f"""
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, coverage_type, {_SUMS}
FROM (SELECT *, time_bucket(INTERVAL 20 MINUTE, event_time) - back * INTERVAL 20 MINUTE AS s
      FROM good_events, range(3) r(back))
GROUP BY s, coverage_type"""),
)
add(
    "stream_session",
    lambda d: ev.session_summary(_valid(d)),
    sql("""
SELECT policy_id, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS session_start,
       strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last_event, count(*) AS claim_count,
       CAST(round(sum(amount), 2) AS DOUBLE) AS total_amount_mxn
FROM (SELECT *, sum(opens) OVER (PARTITION BY policy_id ORDER BY event_time, event_id) AS nr
      FROM (SELECT *, CAST(ifnull(event_time - lag(event_time) OVER (PARTITION BY policy_id ORDER BY event_time, event_id)
                                  >= INTERVAL 30 MINUTE, TRUE) AS INTEGER) AS opens FROM good_events))
GROUP BY policy_id, nr"""),
)
add(
    "stream_global_count_trigger",
    lambda d: ev.count_trigger(_valid(d), ["arrival_ts", "event_id"], 500),
    sql(f"""
SELECT (nr - 1) // 500 AS firing, {_SUMS}
FROM (SELECT *, row_number() OVER (ORDER BY arrival_ts, event_id) AS nr FROM good_events) GROUP BY 1"""),
)
add(
    "stream_late_arrivals",
    lambda d: ev.late_arrivals(
        _valid(d).select("claim_id", "event_time", "arrival_ts", "event_id", "value"), ["arrival_ts", "event_id"], _now()
    ),
    sql(f"""
SELECT claim_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS original_timestamp,
       strftime(arrival_ts, '%Y-%m-%d %H:%M:%S') AS arrival_timestamp,
       date_diff('second', event_time, newest) AS lateness_seconds, value AS raw_data, {_NOW} AS processing_timestamp
FROM (SELECT *, max(event_time) OVER (ORDER BY arrival_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
      FROM good_events)
WHERE newest > event_time"""),
)
add(
    "stream_dedup",
    lambda d: ev.dedup_events(_valid(d), "1 hour", ["event_time", "event_id"]).select(
        "claim_id", "event_id", "event_time", "estimated_amount"
    ),
    sql("""
SELECT claim_id, event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(amount AS DOUBLE) AS estimated_amount
FROM good_events
QUALIFY row_number() OVER (PARTITION BY claim_id, date_trunc('hour', event_time) ORDER BY event_time, event_id) = 1"""),
)
_REPEATS = sql("""
SELECT policy_id, CAST(day AS VARCHAR) AS claim_date, claims, claims_in_period
FROM (SELECT *, CAST(sum(claims) OVER (PARTITION BY policy_id ORDER BY day RANGE BETWEEN INTERVAL 30 DAY PRECEDING
             AND CURRENT ROW) AS BIGINT) AS claims_in_period
      FROM (SELECT policy_id, CAST(event_time AS DATE) AS day, count(*) AS claims FROM good_events GROUP BY ALL))
WHERE claims_in_period >= 2""")
add(
    "stream_repeat_claims",
    lambda d: ev.repeat_claims(_valid(d), 30),
    _REPEATS,
)


def _known_policies(d):
    """Policies the events can name, with their segment."""
    return d.source("customer").select(
        F.concat(F.lit("POL-"), F.col("c_custkey").cast("string")).alias("policy_id"),
        F.col("c_mktsegment").alias("segment"),
    )


_ENRICHED = sql("""
SELECT event_id, policy_id, segment
FROM good_events LEFT JOIN (SELECT 'POL-' || c_custkey AS policy_id, c_mktsegment AS segment
                            FROM customer) USING (policy_id)""")


# --- the same through Structured Streaming --------------------------------------------------------------


def _event_stream(d):
    """Valid events of the events table, read as a stream."""
    raw = projection.raw_claim_events(streams.table_stream(d.spark, d.folder, "events"))
    return ev.valid_events(ev.validate(raw, _now()), CFG, _now())


def _streamed(d, stream, name, mode="append", keys=None):
    """Run a stream to the end of its input and read back what the sink holds: with keys, the last row of each."""
    out = d.scratch(name)
    streams.run_available(stream, sinks.append_batches(out), d.scratch(f"{name}-checkpoint"), mode)
    rows = d.spark.read.schema(T.StructType([*stream.schema.fields, T.StructField(sinks.BATCH, T.LongType())])).parquet(out)
    return (sinks.latest(rows, keys) if keys else rows).drop(sinks.BATCH)


def _parted_stream(d, parts):
    """The events as a stream of several batches: those of id 0 modulo parts first, then those of 1, and so on.

    A batch is a fixed number of files, as many for every part, so its events are parsed in as many tasks. Dealing rows out
    in turn fills every file unless the table is tiny; then a part is one file.
    """
    raw = d.source("events")
    for files in (int(d.spark.conf.get("spark.sql.shuffle.partitions")), 1):
        folder = d.scratch("parted")
        written = set()
        for part in range(parts):
            path = f"{folder}/part={part}"
            raw.filter(F.col("event_id") % parts == part).repartition(files).write.parquet(path)
            written.add(len(d.spark.read.schema(raw.schema).parquet(path).inputFiles()))
        if written == {files}:
            break
    stream = d.spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/*")
    return ev.valid_events(ev.validate(projection.raw_claim_events(stream), _now()), CFG, _now())


add(
    "src_stream_events",
    lambda d: _streamed(d, _event_stream(d).select("event_id", "claim_id", "event_time"), "events"),
    sql("SELECT event_id, claim_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time FROM good_events"),
)
_PANE_KEY = ["window_start", "window_end", "coverage_type"]
add(
    "stream_window_summary",
    lambda d: _streamed(d, streams.windowed(_event_stream(d), CFG), "updates", "update", _PANE_KEY),
    sql(f"SELECT {_WINDOW}, {_SUMS} FROM good_events GROUP BY date_trunc('hour', event_time), coverage_type"),
)
_CLOSED = f"""
SELECT {_WINDOW}, {_SUMS} FROM good_events GROUP BY date_trunc('hour', event_time), coverage_type
HAVING date_trunc('hour', event_time) + INTERVAL 1 HOUR
       <= (SELECT max(event_time) FROM good_events) - INTERVAL 1 HOUR"""
add(
    "stream_final_only",
    lambda d: _streamed(d, streams.windowed(_event_stream(d), CFG), "final"),
    sql(_CLOSED),
)
_SHORT = StreamConfig(window_seconds=1800, allowed_lateness_seconds=600)
add(
    "stream_allowed_lateness",
    lambda d: _streamed(d, streams.windowed(_event_stream(d), _SHORT), "lateness"),
    sql(f"""
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, coverage_type, {_SUMS}
FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, event_time) AS s FROM good_events) GROUP BY s, coverage_type
HAVING s + INTERVAL 30 MINUTE <= (SELECT max(event_time) FROM good_events) - INTERVAL 10 MINUTE"""),
)
add(
    # Rows are late by the watermark that the batch before began with: the third batch loses what the first closed.
    "stream_late_dropped",
    lambda d: _streamed(d, streams.windowed(_parted_stream(d, 3), _SHORT), "dropped", "update", _PANE_KEY),
    sql(f"""
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, coverage_type, {_SUMS}
FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, event_time) AS s FROM good_events)
WHERE event_id % 3 < 2
   OR s + INTERVAL 30 MINUTE > (SELECT max(event_time) FROM good_events WHERE event_id % 3 = 0) - INTERVAL 10 MINUTE
GROUP BY s, coverage_type"""),
)
add(
    "stream_dedup_state",
    lambda d: _streamed(d, streams.deduplicated(_event_stream(d), CFG).select("claim_id", "window.start"), "dedup"),
    sql("SELECT DISTINCT claim_id, strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS start FROM good_events"),
)
add(
    "stream_enrich_policy",
    lambda d: _streamed(
        d, ev.enrich_with_policy(_event_stream(d), _known_policies(d)).select("event_id", "policy_id", "segment"), "policy"
    ),
    _ENRICHED,
)


def _panes(d):
    session.configure_state_store(d.spark)
    return _streamed(d, panes.pane_summary(_event_stream(d), CFG), "panes", "update").drop("firing_id")


add(
    "stream_pane_timing",
    _panes,
    sql(f"""
SELECT * EXCLUDE (closes), unnest(if(closes <= (SELECT max(event_time) FROM good_events), ['EARLY', 'ON_TIME'], ['EARLY']))
         AS pane_timing
FROM (SELECT {_WINDOW}, {_SUMS}, date_trunc('hour', event_time) + INTERVAL 1 HOUR AS closes
      FROM good_events GROUP BY date_trunc('hour', event_time), coverage_type)"""),
)


relation("parted_events", "SELECT *, event_id % 3 AS part FROM good_events")
relation("newest_of_parts", """
SELECT max(event_time) FILTER (part = 0) AS m0, max(event_time) FILTER (part < 2) AS m1, max(event_time) AS m2 FROM parted_events
""")
relation("held_by_batch", f"""
SELECT {_WINDOW}, {_SUMS}, date_trunc('hour', event_time) + INTERVAL 1 HOUR AS closes, batch, bool_or(part = batch) AS fresh
FROM parted_events, range(3) r(batch) WHERE part <= batch GROUP BY date_trunc('hour', event_time), coverage_type, batch
""")
add(
    # A month of lateness: the second and third batch belong to windows that have fired on time.
    "stream_pane_late",
    lambda d: _late_panes(d),
    sql("""
SELECT * EXCLUDE (closes, batch, fresh, m0, m1, m2),
       if((batch = 1 AND closes <= m0) OR (batch = 2 AND closes <= m1), 'LATE', 'EARLY') AS pane_timing
FROM held_by_batch, newest_of_parts WHERE fresh
UNION ALL
SELECT * EXCLUDE (closes, batch, fresh, m0, m1, m2), 'ON_TIME' FROM held_by_batch, newest_of_parts
WHERE batch = CASE WHEN closes <= m0 THEN 0 WHEN closes <= m1 THEN 1 WHEN closes <= m2 THEN 2 END"""),
)


def _late_panes(d):
    session.configure_state_store(d.spark)
    month = StreamConfig(allowed_lateness_seconds=45 * 86_400)
    return _streamed(d, panes.pane_summary(_parted_stream(d, 3), month), "panes", "update").drop("firing_id")


# --- state per key, over several batches in order of arrival, with a restart before each -----------------

#: Events arrive 90 minutes late at most, so none is behind this watermark.
_SLACK = StreamConfig(allowed_lateness_seconds=7200)


def _in_batches(d, build, mode, sink, batches=3):
    """Let the events arrive in so many parts; each part is one batch of a query that starts again from its checkpoint."""
    session.configure_state_store(d.spark)
    folder, checkpoint = d.scratch("arriving"), d.scratch("arriving-checkpoint")
    parts = ord_ntile(d.events, ["arrival_ts", "event_id"], batches, "part")
    for part in range(1, batches + 1):
        parts.filter(F.col("part") == part).drop("part").write.mode("append").parquet(folder)
        stream = d.spark.readStream.schema(parts.drop("part").schema).parquet(folder)
        built = build(ev.valid_events(ev.validate(stream, _now()), CFG, _now()))
        streams.run_available(built, sink, checkpoint, mode)
    return T.StructType([*built.schema.fields, T.StructField(sinks.BATCH, T.LongType())])


def _upserted(d):
    """Window summaries over several batches, of which the table holds the last row of each window only."""
    path = d.scratch("windows")
    sink = sinks.upsert_batches(path, _PANE_KEY, "window_start")
    _in_batches(d, lambda e: streams.windowed(e, _SLACK), "update", sink)
    return d.spark.read.parquet(path).drop("window_start_day")


add(
    "stream_window_summary_upsert",
    _upserted,
    sql(f"SELECT {_WINDOW}, {_SUMS} FROM good_events GROUP BY date_trunc('hour', event_time), coverage_type"),
)


def _kept(d, build, name, mode="append", keys=None):
    out = d.scratch(name)
    rows = d.spark.read.schema(_in_batches(d, build, mode, sinks.append_batches(out))).parquet(out)
    return (sinks.latest(rows, keys) if keys else rows).drop(sinks.BATCH)


def _late_stream(d):
    on_time, late = d.scratch("on-time"), d.scratch("late")
    sink = sinks.route_late(on_time, late, _now())
    _in_batches(d, lambda e: keyed.with_lateness(e, F.col("event_id") % 8, ["arrival_ts", "event_id"]), "append", sink)
    return d.spark.read.parquet(late).drop(sinks.BATCH)


add(
    "stream_late_arrivals_state",
    _late_stream,
    sql(f"""
SELECT claim_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS original_timestamp,
       strftime(arrival_ts, '%Y-%m-%d %H:%M:%S') AS arrival_timestamp,
       date_diff('second', event_time, newest) AS lateness_seconds, value AS raw_data, {_NOW} AS processing_timestamp
FROM (SELECT *, max(event_time) OVER (PARTITION BY event_id % 8 ORDER BY arrival_ts, event_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM good_events)
WHERE newest > event_time"""),
)
add(
    "stream_repeat_claims_state",
    lambda d: _kept(d, lambda e: keyed.repeat_claims(e, _SLACK, 30), "repeats", "update", ["policy_id", "claim_date"]),
    _REPEATS,
)
add(
    "stream_session_state",
    lambda d: _kept(d, lambda e: keyed.sessions(e, _SLACK), "sessions"),
    sql("""
SELECT policy_id, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS session_start,
       strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS last_event, count(*) AS claim_count,
       CAST(round(sum(amount), 2) AS DOUBLE) AS total_amount_mxn
FROM (SELECT *, sum(opens) OVER (PARTITION BY policy_id ORDER BY event_time, event_id) AS nr
      FROM (SELECT *, CAST(ifnull(event_time - lag(event_time) OVER (PARTITION BY policy_id ORDER BY event_time, event_id)
                                  >= INTERVAL 30 MINUTE, TRUE) AS INTEGER) AS opens FROM good_events))
GROUP BY policy_id, nr
HAVING max(event_time) + INTERVAL 30 MINUTE <= (SELECT max(event_time) FROM good_events) - INTERVAL 2 HOUR"""),
)


def _policy_versions(d):
    """Two versions of most policies the events can name: the second begins on a day of January."""
    change = F.expr("timestamp'2024-01-05 00:00:00' + make_dt_interval(c_custkey % 20)")
    first = F.struct(F.lit(1).alias("version"), F.lit(datetime(2023, 9, 1)).cast("timestamp").alias("valid_from"), change.alias("valid_to"))
    second = F.struct(F.lit(2).alias("version"), change.alias("valid_from"), F.lit(datetime(2024, 8, 1)).cast("timestamp").alias("valid_to"))
    some = d.source("customer").filter("c_custkey % 7 <> 0")
    policy = F.concat(F.lit("POL-"), F.col("c_custkey").cast("string")).alias("policy_id")
    return some.select(policy, F.col("c_mktsegment").alias("segment"), F.inline(F.array(first, second)))


def _with_versions(d):
    folder, versions = d.scratch("versions"), _policy_versions(d)
    versions.write.parquet(folder)

    def build(events):
        arriving = d.spark.readStream.schema(versions.schema).parquet(folder)
        return keyed.enrich_with_versions(events, arriving, _SLACK).select("event_id", "policy_id", "segment", "version", "valid_from")

    return _kept(d, build, "versioned")


add(
    "stream_enrich_policy_versions",
    _with_versions,
    sql("""
SELECT event_id, e.policy_id, segment, version, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from
FROM good_events e ASOF JOIN (
  SELECT 'POL-' || c_custkey AS policy_id, c_mktsegment AS segment, version,
         if(version = 1, TIMESTAMP '2023-09-01', TIMESTAMP '2024-01-05' + (c_custkey % 20) * INTERVAL 1 DAY) AS valid_from
  FROM customer, (VALUES (1), (2)) v(version) WHERE c_custkey % 7 <> 0) v
ON e.policy_id = v.policy_id AND e.event_time >= v.valid_from"""),
)


def _routed(d):
    """Dead letters, valid events and one subscriber's share, written by one streaming query."""
    raw = projection.raw_claim_events(streams.table_stream(d.spark, d.folder, "events"))
    paths = {n: d.scratch(n) for n in ("valid", "dead", "motor")}
    wanted = {paths["motor"]: {"coverage_type": ["auto_colision"]}}
    streams.run_available(
        ev.validate(raw, _now()), sinks.route_batches(paths["valid"], paths["dead"], wanted), d.scratch("route-checkpoint")
    )
    return {n: d.spark.read.option("basePath", p).parquet(p) for n, p in paths.items()}


add(
    "stream_filter_attr",
    lambda d: _routed(d)["motor"].select("event_id", "claim_id", "coverage_type"),
    sql("SELECT event_id, claim_id, coverage_type FROM good_events WHERE coverage_type = 'auto_colision'"),
)


def _sink_counts(d):
    parts = [t.groupBy("batch_id").count().select(F.lit(n).alias("sink"), "count") for n, t in _routed(d).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


add(
    "snk_append",
    _sink_counts,
    sql("""
SELECT 'valid' AS sink, count(*) AS count FROM good_events
UNION ALL SELECT 'dead', count(*) FROM event_verdicts WHERE error_reason IS NOT NULL
UNION ALL SELECT 'motor', count(*) FROM good_events WHERE coverage_type = 'auto_colision'"""),
)


def _options(d):
    """Window summary with options taken from the configuration: half-hour windows."""
    cfg = StreamConfig(window_seconds=1800, input_path=d.folder, output_path=d.scratch("unused")).require_endpoints()
    return ev.window_summary(_valid(d), cfg.window)


add(
    "stream_options",
    _options,
    sql(f"""
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, coverage_type, {_SUMS}
FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, event_time) AS s FROM good_events) GROUP BY s, coverage_type"""),
)
