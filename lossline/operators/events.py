"""Claim events: parsing, validation, routing, window summaries. The same functions serve
tables and streams; every rule is a column expression over the JSON text (column value).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossline.config import StreamConfig
from lossline.functions.ordering import ord_row_number, ord_running
from lossline.session import materialise

# Required fields, known coverages, length kept of a rejected text.
STREAM_REQUIRED = ("claim_id", "policy_id", "estimated_amount", "coverage_type")
INTAKE_REQUIRED = ("claim_id", "policy_id", "accident_date", "estimated_amount", "coverage_type")
KNOWN_COVERAGES = (
    "auto_colision",
    "auto_robo_total",
    "auto_responsabilidad_civil",
    "gastos_medicos_mayores",
    "vida_individual",
    "hogar_incendio",
    "hogar_robo",
    "responsabilidad_civil_general",
)

AMOUNT = "decimal(28,6)"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$|^\d{8}$"
ISO_INSTANT = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.]\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$|^\d{8}$"
)
NUMBER_TYPES = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
SCALAR_TYPES = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN|VOID)$"

FIELDS = (
    "claim_id",
    "policy_id",
    "accident_date",
    "cause_of_loss",
    "estimated_amount",
    "coverage_type",
    "claimant_state",
    "currency",
    "timestamp",
    "processing_timestamp",
)

_JSON, _ROOT, _REASON, _TYPE = "_json", "_root", "error_reason", "error_type"
_HELPERS = [_JSON, _ROOT, *[f"_text_{f}" for f in FIELDS], *[f"_kind_{f}" for f in FIELDS]]


def _text(name: str) -> Column:
    return F.col(f"_text_{name}")


def _kind(name: str) -> Column:
    """JSON type of a field: VOID for a null, SQL null only if the field is absent."""
    return F.col(f"_kind_{name}")


def _absent(name: str) -> Column:
    return _kind(name).isNull()


def _shown(name: str) -> Column:
    """The value as the messages quote it: a fraction keeps its point, null is None."""
    text = _text(name)
    whole = _kind(name).startswith("DECIMAL") & ~text.contains(".")
    return F.coalesce(F.when(whole, F.concat(text, F.lit(".0"))).otherwise(text), F.lit("None"))


def _truthy(name: str) -> Column:
    """Whether a field is present and not null, empty, zero or false."""
    text = _text(name)
    filled = F.when(_kind(name) == "STRING", text != "").otherwise(~text.isin("0", "0.0", "false", "[]", "{}"))
    return F.coalesce(filled, F.lit(False))


def iso_date(text: Column) -> Column:
    """The date of an ISO text, or null."""
    plain = F.when(text.rlike(r"^\d{8}$"), F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", r"$1-$2-$3")).otherwise(text)
    return F.when(text.rlike(ISO_DATE), plain.try_cast("date"))


def iso_instant(text: Column) -> Column:
    """The instant of an ISO text (Z or an offset, UTC if neither), or null."""
    plain = F.when(text.rlike(r"^\d{8}$"), F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", r"$1-$2-$3")).otherwise(text)
    return F.when(text.rlike(ISO_INSTANT), plain.try_cast("timestamp"))


def _once(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A filter on a plain projection is pushed below it and repeats the expressions; the output
    of a generator of one row is not repeated.
    """
    fields = ", ".join(f"'{name}', {expression}" for name, expression in columns.items())
    return df.select("*", F.expr(f"inline(array(named_struct({fields})))"))


def parse(events: DataFrame) -> DataFrame:
    """Adds the parsed event (null where the text is not JSON), its type, and text and type of each field."""
    parts = {_ROOT: f"schema_of_variant({_JSON})"}
    for f in FIELDS:
        parts[f"_text_{f}"] = f"try_variant_get({_JSON}, '$.{f}', 'string')"
        parts[f"_kind_{f}"] = f"schema_of_variant(try_variant_get({_JSON}, '$.{f}', 'variant'))"
    parts["estimated_amount"] = f"try_variant_get({_JSON}, '$.estimated_amount', '{AMOUNT}')"
    return _once(_once(events, {_JSON: "try_parse_json(value)"}), parts)


def _fields() -> dict[str, Column]:
    plain = ("claim_id", "policy_id", "cause_of_loss", "coverage_type", "claimant_state", "currency")
    return {f: _text(f) for f in plain} | {"accident_date": iso_date(F.substring(_text("accident_date"), 1, 10))}


def validate(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Events with their fields, event_time, error_type and error_reason; the first failing rule wins.

    Order: JSON, required fields, amount, accident date, coverage, timestamp. A value of the
    wrong JSON type is an error of type unknown where no rule names it. true is not an amount.
    """
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    coverage, amount, day, instant = (_text(f) for f in ("coverage_type", "estimated_amount", "accident_date", "timestamp"))
    is_amount = _kind("estimated_amount").rlike(NUMBER_TYPES) & (amount.try_cast("double") > 0)
    is_day = (_kind("accident_date") == "STRING") & iso_instant(day).isNotNull()
    rules = [
        (F.col(_JSON).isNull(), "parse", F.lit("JSON parse error")),
        (F.col(_ROOT).rlike(SCALAR_TYPES), "unknown", F.lit("Unexpected error: not an object")),
        *[(_absent(f), "validate", F.lit(f"Missing required field: {f}")) for f in STREAM_REQUIRED],
        (
            ~F.coalesce(is_amount, F.lit(False)),
            "validate",
            F.concat(F.lit("Invalid estimated_amount: "), _shown("estimated_amount")),
        ),
        (
            _truthy("accident_date") & ~F.coalesce(is_day, F.lit(False)),
            "validate",
            F.concat(F.lit("Invalid accident_date: "), _shown("accident_date")),
        ),
        (~_truthy("coverage_type") | (F.trim(coverage) == ""), "validate", F.lit("Empty coverage_type")),
        (_kind("coverage_type") != "STRING", "unknown", F.lit("Unexpected error: coverage_type is not text")),
        (~coverage.isin(*KNOWN_COVERAGES), "validate", F.concat(F.lit("Unknown coverage_type: "), coverage)),
        (
            _truthy("timestamp") & iso_instant(instant).isNull(),
            "unknown",
            F.concat(F.lit("Unexpected error: invalid timestamp "), _shown("timestamp")),
        ),
    ]
    kind = F.coalesce(*[F.when(condition, F.lit(kind)) for condition, kind, _ in rules])
    reason = F.coalesce(*[F.when(condition, text) for condition, _, text in rules])
    event_time = F.when(_truthy("timestamp"), iso_instant(instant)).otherwise(processed_at)
    judged = parse(events).withColumns({**_fields(), "event_time": event_time, _TYPE: kind, _REASON: reason})
    return judged.drop(*_HELPERS)


def valid_events(judged: DataFrame, cfg: StreamConfig = StreamConfig(), processed_at: Column | None = None) -> DataFrame:
    """Events that passed, enriched with processing metadata."""
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    return (
        judged.filter(F.col(_TYPE).isNull())
        .drop(_TYPE, _REASON)
        .withColumns(
            {
                "processing_timestamp": processed_at,
                "validation_status": F.lit("valid"),
                "pipeline_version": F.lit(cfg.version),
            }
        )
    )


def dead_letters(judged: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Events that failed: the raw text, reason and kind of error."""
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    return judged.filter(F.col(_TYPE).isNotNull()).select(
        F.col("value").alias("raw_data"),
        _REASON,
        _TYPE,
        processed_at.alias("processing_timestamp"),
    )


def _plain_number(number: Column) -> Column:
    """A double in digits, without an exponent: -20000000.0, 0.5."""
    whole = (F.abs(number) < 1e15) & (number == F.floor(number))
    digits = F.regexp_replace(F.format_string("%.15f", number), "0+$", "")
    return F.when(whole, F.concat(number.cast("decimal(16,0)").cast("string"), F.lit(".0"))).when(F.abs(number) < 1e15, digits).otherwise(number.cast("string"))


# --- intake: all errors of an event -------------------------------------------------------


def intake_validate_all(events: DataFrame, as_of: date | Column) -> DataFrame:
    """Events with validation_errors (array), validation_status and the joined reason.

    If a required field is missing, only the missing fields are named; otherwise every failing
    rule is. as_of is the day after which an accident lies in the future.
    """
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    absent = [F.when(_absent(f), F.lit(f"missing required field: {f}")) for f in INTAKE_REQUIRED]
    number = F.trim(_text("estimated_amount")).try_cast("double")
    day = iso_date(_text("accident_date"))
    rules = [
        F.when(number.isNull(), F.concat(F.lit("estimated_amount is not a number: "), _shown("estimated_amount")))
        .when(number <= 0, F.concat(F.lit("estimated_amount must be positive, got "), _plain_number(number))),
        F.when(day.isNull(), F.concat(F.lit("accident_date is not a valid ISO date: "), _shown("accident_date")))
        .when(day > today, F.concat(F.lit("accident_date is in the future: "), _shown("accident_date"))),
        F.when(~_truthy("coverage_type"), F.lit("coverage_type is empty")),
    ]
    unreadable = F.when(F.col(_JSON).isNull(), F.array(F.lit("JSON parse error")))
    missing = F.array_compact(F.array(*absent))
    errors = F.coalesce(unreadable, F.when(F.size(missing) > 0, missing).otherwise(F.array_compact(F.array(*rules))))
    judged = parse(events).withColumns({**_fields(), "validation_errors": errors}).drop(*_HELPERS)
    return judged.withColumns(
        {
            "validation_status": F.when(F.size("validation_errors") == 0, "valid").otherwise("invalid"),
            "reason": F.concat_ws("; ", "validation_errors"),
        }
    )


def intake_route(judged: DataFrame, processed_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid events, enriched; and invalid ones with the raw text, errors and reason."""
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    valid = (
        judged.filter(F.col("validation_status") == "valid")
        .drop("validation_errors", "reason", "value")
        .withColumn("processing_timestamp", processed_at)
    )
    invalid = judged.filter(F.col("validation_status") == "invalid").select(
        "value", "validation_status", "validation_errors", "reason"
    )
    return valid, invalid


ENVELOPE = "message STRUCT<data: STRING, messageId: STRING, attributes: MAP<STRING, STRING>>, subscription STRING"


def open_envelopes(envelopes: DataFrame) -> DataFrame:
    """Payload text (value) of push envelopes {message: {data: base64, ...}}; no message is an error."""
    opened = envelopes.withColumn("_message", F.from_json("envelope", ENVELOPE)["message"])
    message = F.col("_message")
    data = F.expr("try_to_binary(coalesce(_message.data, ''), 'base64')")
    return opened.withColumns(
        {
            "message_id": message["messageId"],
            "value": F.when(message.isNotNull(), data.cast("string")),
            "error": F.when(message.isNull(), "no message").when(data.isNull(), "data is not base64"),
        }
    ).drop("_message")


# --- batch reading of the event table -----------------------------------------------------------


def batch_parse(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Events with their fields and event_time from timestamp, else processing_timestamp, else now."""
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    given = F.when(_truthy("timestamp"), _text("timestamp")).when(
        _truthy("processing_timestamp"), _text("processing_timestamp")
    )
    reason = F.when(F.col(_JSON).isNull(), "not JSON").when(
        ~F.coalesce(F.col(_ROOT).startswith("OBJECT"), F.lit(False)), "not an object"
    ).when(given.isNotNull() & iso_instant(given).isNull(), F.concat(F.lit("invalid timestamp: "), given))
    return (
        parse(events)
        .withColumns({**_fields(), "event_time": F.coalesce(iso_instant(given), processed_at), _REASON: reason})
        .drop(*_HELPERS)
    )


def batch_dead_letters(parsed: DataFrame, processed_at: Column | None = None) -> DataFrame:
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    return parsed.filter(F.col(_REASON).isNotNull()).select(
        F.col("value").alias("raw_data"), _REASON, processed_at.alias("processing_timestamp")
    )


def batch_key_amount(parsed: DataFrame) -> DataFrame:
    """Readable events keyed by coverage (unknown if none) with their amount (0 if none)."""
    zero = F.lit(0).cast(AMOUNT)
    return parsed.filter(F.col(_REASON).isNull()).select(
        "event_time",
        F.coalesce("coverage_type", F.lit("unknown")).alias("coverage_type"),
        F.coalesce("estimated_amount", zero).alias("estimated_amount"),
    )


# --- window summaries ---------------------------------------------------------------------------------


def _summary() -> list[Column]:
    amount = F.col("estimated_amount")

    def money(value: Column, name: str) -> Column:
        return F.round(value, 2).cast("double").alias(name)

    return [
        F.count("*").alias("claim_count"),
        money(F.sum(amount), "total_amount_mxn"),
        money(F.sum(amount) / F.count("*"), "avg_amount_mxn"),
        money(F.min(amount), "min_amount_mxn"),
        money(F.max(amount), "max_amount_mxn"),
    ]


def window_summary(events: DataFrame, window: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Count, total, mean, least and largest amount per event-time window and coverage.

    Partial sums are formed before the shuffle, so a coverage that holds most events sends
    one row per window and map task.
    """
    return (
        events.groupBy(F.window("event_time", window, slide).alias("w"), "coverage_type")
        .agg(*_summary())
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "coverage_type",
            "claim_count",
            "total_amount_mxn",
            "avg_amount_mxn",
            "min_amount_mxn",
            "max_amount_mxn",
        )
    )


def session_summary(events: DataFrame, key: str = "policy_id", gap_seconds: int = 1800) -> DataFrame:
    """Sessions per key: events less than the gap apart belong together.

    Events are first reduced to one row per key and minute; a reduced row stretches its
    session window by the time it covers, so the sessions are the same.
    """
    minute = events.groupBy(key, F.window("event_time", "1 minute")).agg(
        F.min("event_time").alias("first"),
        F.max("event_time").alias("last"),
        F.count("*").alias("n"),
        F.sum("estimated_amount").alias("amount"),
    )
    # Spark joins windows that touch; a microsecond less keeps events apart that are a whole gap apart.
    covered = F.unix_micros("last") - F.unix_micros("first") + F.lit(gap_seconds * 1_000_000 - 1)
    length = F.make_interval(secs=(covered / 1_000_000).cast("decimal(18,6)"))
    return (
        minute.groupBy(key, F.session_window("first", length).alias("s"))
        .agg(
            F.min("first").alias("session_start"),
            F.max("last").alias("last_event"),
            F.sum("n").alias("claim_count"),
            F.round(F.sum("amount"), 2).cast("double").alias("total_amount_mxn"),
        )
        .drop("s")
    )


def dedup_events(events: DataFrame, window: str, order: list[str]) -> DataFrame:
    """First event per claim and window, by order. The least struct per key needs no sort of a group."""
    rest = [c for c in events.columns if c not in ("claim_id", *order)]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return (
        events.groupBy("claim_id", F.window("event_time", window).alias("w"))
        .agg(first)
        .select("claim_id", "first.*")
    )


def late_arrivals(events: DataFrame, order: list[str], processed_at: Column | None = None, shard: Column | None = None) -> DataFrame:
    """Events older than one that arrived before them (in the same shard, if given), with their lateness.

    order sorts by arrival. The latest event time so far is a running maximum over the
    whole table, taken range by range (functions.ordering); with shards, over them one after the other.
    """
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    shard = F.lit(0) if shard is None else shard
    marked = events.withColumn("_shard", shard).withColumn("_at", F.struct("_shard", "event_time"))
    seen = ord_running(marked, ["_shard", *order], "_at", "_seen", "max", include_current=False)
    newest = F.when(F.col("_seen._shard") == F.col("_shard"), F.col("_seen.event_time"))
    seen = seen.withColumn("_newest", newest)
    late = F.unix_seconds("_newest") - F.unix_seconds("event_time")
    return seen.filter(F.col("event_time") < F.col("_newest")).select(
        "claim_id",
        F.col("event_time").alias("original_timestamp"),
        F.col("arrival_ts").alias("arrival_timestamp"),
        late.alias("lateness_seconds"),
        F.col("value").alias("raw_data"),
        processed_at.alias("processing_timestamp"),
    )


def count_trigger(events: DataFrame, order: list[str], every: int) -> DataFrame:
    """One global window that fires after every so many events: one row per firing.

    Only the amount and the order are dealt out, and they are written before: dealing by range reads its input twice, which
    would parse the events twice.
    """
    narrow = materialise(events.select(*dict.fromkeys([*order, "estimated_amount"])), "counted")
    ranked = ord_row_number(narrow, order, "_n")
    return (
        ranked.groupBy(F.floor((F.col("_n") - 1) / every).alias("firing"))
        .agg(*_summary())
        .select("firing", "claim_count", "total_amount_mxn", "avg_amount_mxn", "min_amount_mxn", "max_amount_mxn")
    )


def repeat_claims(events: DataFrame, days: int = 30, at_least: int = 2) -> DataFrame:
    """Policies with several claims within some days, per policy and day of a claim.

    Claims are counted per policy and day first: the window holds at most one row per day,
    however many claims a policy has.
    """
    day = F.unix_date(F.to_date("event_time"))
    daily = events.groupBy("policy_id", day.alias("day")).agg(F.count("*").alias("claims"))
    recent = Window.partitionBy("policy_id").orderBy("day").rangeBetween(-days, 0)
    return (
        daily.withColumn("claims_in_period", F.sum("claims").over(recent))
        .filter(F.col("claims_in_period") >= at_least)
        .select("policy_id", F.date_from_unix_date("day").alias("claim_date"), "claims", "claims_in_period")
    )


def enrich_with_policy(events: DataFrame, policies: DataFrame) -> DataFrame:
    """Events with the policy they belong to, where it is known."""
    return events.join(policies, "policy_id", "left")


def filter_attributes(events: DataFrame, **wanted: list[str]) -> DataFrame:
    """Only events whose fields have one of the wanted values: one subscriber's share."""
    for name, values in wanted.items():
        events = events.filter(F.col(name).isin(list(values)))
    return events
