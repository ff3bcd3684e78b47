"""Stateful operators over several batches, each after a restart from the checkpoint."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lossline.config import StreamConfig
from lossline.operators import events as ev
from lossline.session import configure_state_store
from lossline.streaming import keyed, panes, queries as streams, sinks

START = datetime(2024, 1, 1, 10)
SCHEMA = "event_id long, claim_id string, policy_id string, coverage_type string, estimated_amount long, event_time timestamp, arrival_ts timestamp, value string"


def event(n, minutes, policy="p", amount=1, coverage="hogar_robo"):
    return (n, f"c{n}", policy, coverage, amount, START + timedelta(minutes=minutes), START + timedelta(minutes=n), f"v{n}")


def table(spark, events):
    return spark.createDataFrame(events, SCHEMA).withColumn("estimated_amount", F.col("estimated_amount").cast("decimal(28,6)"))


class Arriving:
    """A folder of events that grows; the query is started anew for every part and stops when it has read it."""

    def __init__(self, spark, folder):
        configure_state_store(spark)
        self.spark, self.folder = spark, folder

    def run(self, build, parts, mode="append", sink=None):
        sink = sink or sinks.append_batches(str(self.folder / "out"))
        for part in parts:
            rows = table(self.spark, part)
            rows.write.mode("append").parquet(str(self.folder / "in"))
            built = build(self.spark.readStream.schema(rows.schema).parquet(str(self.folder / "in")))
            streams.run_available(built, sink, str(self.folder / "checkpoint"), mode)
        return self.spark.read.schema(built.schema.add(sinks.BATCH, "long")).parquet(str(self.folder / "out"))


def parts_of(events, n, seed=0):
    """In order of arrival, the rows of a part in any order."""
    size = -(-len(events) // n)
    parts = [events[i : i + size] for i in range(0, len(events), size)]
    for part in parts:
        random.Random(seed).shuffle(part)
    return parts


@pytest.mark.parametrize("batches", [3])
def test_late_arrivals(spark, tmp_path, batches):
    draw = random.Random(1)
    events = [event(n, n - (draw.randint(0, 20) if draw.random() < 0.3 else 0)) for n in range(60)]
    on_time, late = str(tmp_path / "on-time"), str(tmp_path / "late")
    sink = sinks.route_late(on_time, late)
    order = ["arrival_ts", "event_id"]
    box = Arriving(spark, tmp_path)
    box.spark = spark
    (tmp_path / "out").mkdir()
    box.run(lambda e: keyed.with_lateness(e, F.col("event_id") % 2, order), parts_of(list(events), batches), sink=sink)
    whole = table(spark, events)
    got = {(r.claim_id, r.lateness_seconds) for r in spark.read.parquet(late).collect()}
    batch = ev.late_arrivals(whole, order, shard=F.col("event_id") % 2)
    assert got == {(r.claim_id, r.lateness_seconds) for r in batch.collect()} and got
    others = {r.claim_id for r in spark.read.parquet(on_time).collect()}
    assert others == {e[1] for e in events} - {c for c, _ in got}


@pytest.mark.parametrize("batches", [3])
def test_repeat_claims(spark, tmp_path, batches):
    draw = random.Random(2)
    events = [event(n, (n + draw.randint(0, 3)) * 60 * 12, f"p{draw.randrange(4)}") for n in range(160)]
    cfg = StreamConfig(allowed_lateness_seconds=5 * 86_400)
    found = Arriving(spark, tmp_path).run(lambda e: keyed.repeat_claims(e, cfg, 7, 3), parts_of(list(events), batches), "update")
    last = sinks.latest(found, ["policy_id", "claim_date"]).drop(sinks.BATCH)
    want = ev.repeat_claims(table(spark, events), 7, 3)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, want.collect())) != []


def test_repeat_claims_forget_old_days(spark):
    """State holds the days that the watermark still needs, and none of a policy without claims for that long."""

    class State:
        def __init__(self):
            self.held, self.timers = {}, []

        iterator = lambda s: iter([((k,), (v,)) for k, v in s.held.items()])
        containsKey = lambda s, k: k[0] in s.held
        updateValue = lambda s, k, v: s.held.__setitem__(k[0], v[0])
        removeKey = lambda s, k: s.held.pop(k[0])
        clear = lambda s: s.held.clear()
        registerTimer = lambda s, at: s.timers.append(at)

    class Now:
        day = 0
        getCurrentWatermarkInMs = lambda s: s.day * 86_400_000
        getExpiryTimeInMs = getCurrentWatermarkInMs

    state, now, processor = State(), Now(), keyed.RepeatProcessor(30, 2)
    processor.handle = processor.days = state
    most = 0
    for day in range(100, 400):
        now.day = day - 1
        list(processor.handleInputRows(("p",), [type("R", (), {"day": day, "n": 1})], now))
        most = max(most, len(state.held))
    assert most <= 33
    now.day = 399 + 30
    assert list(processor.handleExpiredTimer(("p",), None, now)) == [] and state.held
    now.day = 399 + 31
    list(processor.handleExpiredTimer(("p",), None, now))
    assert not state.held and max(state.timers) == 430 * 86_400_000


@pytest.mark.parametrize("batches", [3])
def test_sessions(spark, tmp_path, batches):
    """Late events join sessions and bring two of them together; open ones stay in state."""
    draw = random.Random(3)
    events = [event(n, n * 7 - draw.randint(0, 50), f"p{draw.randrange(3)}", n) for n in range(150)]
    last = [event(1000, 5000, "end"), event(1001, 9000, "end")]
    cfg = StreamConfig(allowed_lateness_seconds=7200)
    found = Arriving(spark, tmp_path).run(lambda e: keyed.sessions(e, cfg, gap_seconds=1800), [*parts_of(list(events), batches), last])
    want = ev.session_summary(table(spark, events + last[:1]), "policy_id", 1800)
    assert sorted(map(tuple, found.drop(sinks.BATCH).collect())) == sorted(map(tuple, want.collect())) != []


def test_sessions_need_no_call_per_key_and_merge_before_the_shuffle(spark, tmp_path):
    configure_state_store(spark)
    rows = table(spark, [event(n, n // 50, "hot") for n in range(400)] + [event(900, 30 + 7, "hot"), event(901, 900, "end")])
    rows.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = streams.run_available(
        keyed.sessions(stream, StreamConfig(allowed_lateness_seconds=60)), sinks.append_batches(str(tmp_path / "out")), str(tmp_path / "checkpoint")
    )
    plan = query._jsq.explainInternal(False)
    assert "SessionWindowStateStoreSave" in plan and "TransformWithState" not in plan and plan.count("MergingSessions") >= 2
    found = spark.read.parquet(str(tmp_path / "out"))
    # The last event of the first stretch is 30 minutes before the next: a whole gap apart.
    assert sorted((r.policy_id, r.claim_count) for r in found.collect()) == [("hot", 1), ("hot", 400)]


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    events = spark.range(20_000).select(
        F.lit("p").alias("policy_id"), F.lit(1).cast("decimal(28,6)").alias("estimated_amount"), F.timestamp_seconds(F.col("id") % 600).alias("event_time")
    )
    rows = keyed.reduced(events.repartition(2), {"policy_id": F.col("policy_id")}, "policy_id string").collect()
    assert sum(r.n for r in rows) == 20_000 and len(rows) <= 6 and all(r.total == r.n for r in rows)


def test_versions_at_event_time(spark, tmp_path):
    configure_state_store(spark)
    versions = [("p", START, START + timedelta(hours=2), "old"), ("p", START + timedelta(hours=2), START + timedelta(days=9), "new"),
                ("q", START + timedelta(days=8), START + timedelta(days=9), "later")]
    known = spark.createDataFrame(versions, "policy_id string, valid_from timestamp, valid_to timestamp, segment string")
    known.write.parquet(str(tmp_path / "versions"))
    cfg = StreamConfig(allowed_lateness_seconds=60)

    def build(events):
        arriving = spark.readStream.schema(known.schema).parquet(str(tmp_path / "versions"))
        return keyed.enrich_with_versions(events, arriving, cfg, how="left").select("claim_id", "segment")

    parts = [[event(1, 0), event(2, 119), event(3, 1, "unknown")], [event(4, 120), event(5, -5)], [event(6, 60 * 24 * 9), event(7, 60 * 24 * 9 + 5)]]
    rows = Arriving(spark, tmp_path).run(build, parts).collect()
    assert Counter((r.claim_id, r.segment) for r in rows) >= Counter({("c1", "old"): 1, ("c2", "old"): 1, ("c4", "new"): 1, ("c3", None): 1})
    assert {r.claim_id: r.segment for r in rows}.get("c6") is None


def test_pane_totals_beyond_64_bits_of_millionths(spark, tmp_path):
    events = [event(n, 5, amount=5_000_000_000_000) for n in range(6)]
    cfg = StreamConfig()
    rows = Arriving(spark, tmp_path).run(lambda e: panes.pane_summary(e, cfg), parts_of(events, 2), "update").orderBy("claim_count").collect()
    assert [(r.claim_count, r.total_amount_mxn) for r in rows] == [(3, 1.5e13), (6, 3e13)]


def test_upserted_windows(spark, tmp_path):
    """One row per window after any number of batches; a batch that runs again changes nothing, other days are not touched."""
    path = str(tmp_path / "t")
    sink = sinks.upsert_batches(path, ["w", "c"], "w")
    batch = lambda *rows: spark.createDataFrame([(START + timedelta(days=d), c, n) for d, c, n in rows], "w timestamp, c string, n int")
    sink(batch((0, "a", 1), (0, None, 2), (1, "a", 3)), 0)
    other = sorted(f.name for f in (tmp_path / "t" / "w_day=2024-01-02").glob("*.parquet"))
    for _ in range(2):
        sink(batch((0, "a", 5), (0, "b", 6)), 1)
        sink(batch((0, None, 9)).limit(0), 2)
        rows = {((r.w - START).days, r.c): r.n for r in spark.read.parquet(path).collect()}
        assert rows == {(0, "a"): 5, (0, "b"): 6, (0, None): 2, (1, "a"): 3}
    assert sorted(f.name for f in (tmp_path / "t" / "w_day=2024-01-02").glob("*.parquet")) == other
