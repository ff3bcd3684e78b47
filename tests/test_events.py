"""Event rules on hand-made texts, in batch."""

from __future__ import annotations

import base64
import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from lossline.config import StreamConfig
from lossline.operators import events as ev

GOOD = {
    "claim_id": "c1",
    "policy_id": "POL-1",
    "accident_date": "2024-01-01",
    "estimated_amount": 10000.0,
    "coverage_type": "hogar_robo",
    "timestamp": "2024-01-01T10:05:00Z",
}


def texts(spark, *events):
    rows = [(i, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, "n int, value string")


def judge(spark, *events):
    return {r["n"]: (r["error_type"], r["error_reason"]) for r in ev.validate(texts(spark, *events)).collect()}


def without(*names):
    return {k: v for k, v in GOOD.items() if k not in names}


CASES = [
    (GOOD, None, None),
    ("not json at all", "parse", "JSON parse error"),
    ("also {{{ not json", "parse", "JSON parse error"),
    ("[1, 2]", "validate", "Missing required field: claim_id"),
    ("12", "unknown", "Unexpected error: not an object"),
    ("null", "unknown", "Unexpected error: not an object"),
    (without("claim_id"), "validate", "Missing required field: claim_id"),
    (without("policy_id", "coverage_type"), "validate", "Missing required field: policy_id"),
    ({**GOOD, "claim_id": None}, None, None),
    ({**GOOD, "estimated_amount": -500}, "validate", "Invalid estimated_amount: -500"),
    ({**GOOD, "estimated_amount": -500.0}, "validate", "Invalid estimated_amount: -500.0"),
    ({**GOOD, "estimated_amount": 0}, "validate", "Invalid estimated_amount: 0"),
    ({**GOOD, "estimated_amount": "500"}, "validate", "Invalid estimated_amount: 500"),
    ({**GOOD, "estimated_amount": None}, "validate", "Invalid estimated_amount: None"),
    ({**GOOD, "estimated_amount": True}, "validate", "Invalid estimated_amount: true"),
    ({**GOOD, "accident_date": "not-a-date"}, "validate", "Invalid accident_date: not-a-date"),
    ({**GOOD, "accident_date": "2024-02-30"}, "validate", "Invalid accident_date: 2024-02-30"),
    ({**GOOD, "accident_date": ""}, None, None),
    ({**GOOD, "accident_date": None}, None, None),
    ({**GOOD, "accident_date": 5}, "validate", "Invalid accident_date: 5"),
    (without("accident_date"), None, None),
    ({**GOOD, "coverage_type": "  "}, "validate", "Empty coverage_type"),
    ({**GOOD, "coverage_type": None}, "validate", "Empty coverage_type"),
    ({**GOOD, "coverage_type": 5}, "unknown", "Unexpected error: coverage_type is not text"),
    ({**GOOD, "coverage_type": "boat"}, "validate", "Unknown coverage_type: boat"),
    ({**GOOD, "timestamp": "yesterday"}, "unknown", "Unexpected error: invalid timestamp yesterday"),
    (without("timestamp"), None, None),
]


def test_first_failing_rule_wins(spark):
    got = judge(spark, *[c[0] for c in CASES])
    for n, (event, kind, reason) in enumerate(CASES):
        assert got[n] == (kind, reason), event


def test_event_time_and_enrichment(spark):
    offset = {**GOOD, "timestamp": "2024-01-01T10:05:00+02:00"}
    now = F.lit(datetime(2024, 3, 1)).cast("timestamp")
    rows = ev.valid_events(ev.validate(texts(spark, GOOD, offset, without("timestamp")), now), StreamConfig(), now)
    got = {r["n"]: r for r in rows.withColumn("s", F.date_format("event_time", "MM-dd HH:mm")).collect()}
    assert [got[n]["s"] for n in range(3)] == ["01-01 10:05", "01-01 08:05", "03-01 00:00"]
    assert got[0]["validation_status"] == "valid" and got[0]["pipeline_version"] == "0.1.0"


def test_dead_letter_keeps_the_whole_text(spark):
    row = ev.dead_letters(ev.validate(texts(spark, "x" * 5000))).first()
    assert row["raw_data"] == "x" * 5000 and row["error_type"] == "parse" and row["processing_timestamp"] is not None


def test_amounts_are_shown_in_digits(spark):
    shown = {-20000000.0: "-20000000.0", -0.5: "-0.5", 0.0: "0.0", -1234.125: "-1234.125"}
    rows = spark.createDataFrame([(n,) for n in shown], "n double").select("n", ev._plain_number(F.col("n")).alias("s")).collect()
    assert {r["n"]: r["s"] for r in rows} == shown


def test_text_is_parsed_once(spark):
    dead = ev.dead_letters(ev.validate(texts(spark, GOOD).repartition(2)))
    plan = dead._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson(") + plan.count("parse_json(") == 1


def intake(spark, *events):
    rows = ev.intake_validate_all(texts(spark, *events), date(2024, 6, 1)).collect()
    return {r["n"]: (r["validation_status"], r["reason"]) for r in rows}


def test_intake_names_every_error(spark):
    got = intake(
        spark,
        GOOD,
        without("claim_id", "accident_date"),
        {**GOOD, "estimated_amount": -1000, "accident_date": "soon", "coverage_type": ""},
        {**GOOD, "estimated_amount": "abc"},
        {**GOOD, "estimated_amount": "12.5"},
        {**GOOD, "accident_date": "2024-06-02"},
        "nonsense",
    )
    assert got[0] == ("valid", "") and got[4] == ("valid", "")
    assert got[1] == ("invalid", "missing required field: claim_id; missing required field: accident_date")
    assert got[2][1] == (
        "estimated_amount must be positive, got -1000.0; accident_date is not a valid ISO date: soon; coverage_type is empty"
    )
    assert got[3][1] == "estimated_amount is not a number: abc"
    assert got[5][1] == "accident_date is in the future: 2024-06-02"
    assert got[6][1] == "JSON parse error"


def test_intake_routes(spark):
    valid, invalid = ev.intake_route(ev.intake_validate_all(texts(spark, GOOD, without("claim_id")), date(2024, 6, 1)))
    assert valid.count() == 1 and invalid.first()["validation_errors"] == ["missing required field: claim_id"]


def test_envelopes(spark):
    data = base64.b64encode(json.dumps(GOOD).encode()).decode()
    rows = [(json.dumps({"message": {"data": data, "messageId": "1", "attributes": {"a": "b"}}}),), ("{}",), ('{"message": {"data": "%%"}}',)]
    got = ev.open_envelopes(spark.createDataFrame(rows, "envelope string")).collect()
    assert json.loads(got[0]["value"]) == GOOD and got[0]["message_id"] == "1" and got[0]["error"] is None
    assert got[1]["error"] == "no message" and got[2]["error"] == "data is not base64"


def at(amount, stamp, coverage="hogar_robo", claim="c1", policy="POL-1"):
    return {**GOOD, "estimated_amount": amount, "timestamp": f"2024-01-01T{stamp}Z", "coverage_type": coverage, "claim_id": claim, "policy_id": policy}


def summary(spark, events, window="1 hour"):
    rows = ev.window_summary(ev.valid_events(ev.validate(texts(spark, *events))), window).collect()
    return sorted((r["claim_count"], r["total_amount_mxn"], r["avg_amount_mxn"], r["min_amount_mxn"], r["max_amount_mxn"]) for r in rows)


def test_one_window(spark):
    assert summary(spark, [at(10000, "10:05:00"), at(20000, "10:30:00"), at(30000, "10:55:00")]) == [(3, 60000, 20000, 10000, 30000)]


def test_two_hours_and_half_hours(spark):
    assert [r[0] for r in summary(spark, [at(1, "10:15:00"), at(1, "11:15:00")])] == [1, 1]
    assert [r[0] for r in summary(spark, [at(1, "10:00:00"), at(1, "10:20:00"), at(1, "10:40:00")], "30 minutes")] == [1, 2]


def test_dedup_per_window(spark):
    events = [at(1, "10:05:00", claim="dup-1"), at(2, "10:06:00", claim="dup-1"), at(3, "10:07:00", claim="unique-1"), at(4, "11:07:00", claim="dup-1")]
    rows = ev.dedup_events(ev.valid_events(ev.validate(texts(spark, *events))), "1 hour", ["event_time", "n"]).collect()
    assert sorted((r["claim_id"], r["n"]) for r in rows) == [("dup-1", 0), ("dup-1", 3), ("unique-1", 2)]


def test_missing_coverage_counts_as_unknown(spark):
    parsed = ev.batch_parse(texts(spark, {"estimated_amount": 50000.0, "timestamp": "2024-01-01T00:00:00"}, {"processing_timestamp": "2024-01-01T01:00:00Z"}, "{", "[]", {"timestamp": "x"}))
    got = [(r["coverage_type"], float(r["estimated_amount"])) for r in ev.batch_key_amount(parsed).orderBy("event_time").collect()]
    assert got == [("unknown", 50000.0), ("unknown", 0.0)]
    assert sorted(r["error_reason"] for r in ev.batch_dead_letters(parsed).collect()) == ["invalid timestamp: x", "not JSON", "not an object"]


def test_sessions_match_brute_force(spark):
    import random

    rng = random.Random(5)
    stamps = sorted((rng.choice("ab"), rng.randint(0, 40_000)) for _ in range(120))
    rows = [(k, datetime.fromtimestamp(1_700_000_000 + s, timezone.utc), 1.0) for k, s in stamps]
    df = spark.createDataFrame(rows, "policy_id string, event_time timestamp, estimated_amount double")
    want = []
    for key in "ab":
        last = None
        for k, s in stamps:
            if k == key:
                if last is None or s - last >= 1800:
                    want.append([key, 0])
                want[-1][1] += 1
                last = s
    got = sorted((r["policy_id"], r["claim_count"]) for r in ev.session_summary(df).collect())
    assert got == sorted(map(tuple, want))


def test_repeat_claims(spark):
    rows = [("p", datetime(2024, 1, d, 12)) for d in (1, 1, 31)] + [("p", datetime(2024, 4, 1)), ("q", datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "policy_id string, event_time timestamp")
    got = [(r["policy_id"], str(r["claim_date"]), r["claims_in_period"]) for r in ev.repeat_claims(df).orderBy("claim_date").collect()]
    assert got == [("p", "2024-01-01", 2), ("p", "2024-01-31", 3)]


@pytest.mark.parametrize("bad", [{"window_seconds": 0}, {"allowed_lateness_seconds": -1}, {"early_firing_seconds": 0}])
def test_options_are_checked(bad):
    with pytest.raises(ValueError):
        StreamConfig(**bad)


def test_endpoints_are_required():
    with pytest.raises(ValueError):
        StreamConfig(output_path="o").require_endpoints()
    with pytest.raises(ValueError):
        StreamConfig(input_path="i").require_endpoints()
