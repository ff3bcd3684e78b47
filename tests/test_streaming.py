"""Streaming operators on small files with controlled arrival."""

from __future__ import annotations

import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lossline.config import StreamConfig
from lossline.operators import events as ev
from lossline.session import configure_state_store
from lossline.streaming import panes, queries as streams, sinks


def event(amount, stamp, coverage="hogar_robo", claim="c"):
    return {"claim_id": claim, "policy_id": "POL-1", "accident_date": "2024-01-01", "estimated_amount": amount,
            "coverage_type": coverage, "timestamp": f"2024-01-01T{stamp}:00Z"}


class Inbox:
    """Files of JSON lines, read one per batch in the order they were written."""

    def __init__(self, spark, folder, window=3600, lateness=3600):
        self.spark, self.count = spark, 0
        self.cfg = StreamConfig(window, lateness, input_path=str(folder / "in"), output_path=str(folder / "out"))
        self.folder = folder
        os.makedirs(self.cfg.input_path)

    def put(self, *events):
        path = f"{self.cfg.input_path}/{self.count:03d}.json"
        with open(path, "w") as out:
            out.writelines((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in events)
        os.utime(path, (1_700_000_000 + self.count * 10,) * 2)
        self.count += 1

    def judged(self):
        return ev.validate(streams.event_text_stream(self.spark, self.cfg, files_per_batch=1))

    def valid(self):
        return ev.valid_events(self.judged(), self.cfg)

    def run(self, stream, mode="append"):
        out = self.cfg.output_path
        streams.run_available(stream, sinks.append_batches(out), str(self.folder / "checkpoint"), mode)
        return self.spark.read.schema(stream.schema).option("basePath", out).parquet(out)


def test_panes(spark, tmp_path):
    configure_state_store(spark)
    box = Inbox(spark, tmp_path)
    box.put(event(100, "10:05"), event(200, "10:30"))
    box.put(event(300, "10:40"))
    box.put(event(1, "11:10", "vida_individual"))
    box.put(event(50, "10:50"))
    box.put(event(1, "13:30", "vida_individual"))
    box.put(event(7, "10:55"), event(7, "12:20", "hogar_incendio"))
    rows = box.run(panes.pane_summary(box.valid(), box.cfg), "update")
    home = rows.filter("coverage_type = 'hogar_robo'").orderBy("claim_count", "batch_id").collect()
    got = [(r["pane_timing"], r["claim_count"], r["total_amount_mxn"]) for r in home]
    assert got == [("EARLY", 2, 300.0), ("EARLY", 3, 600.0), ("ON_TIME", 3, 600.0), ("LATE", 4, 650.0)]
    fire = [(r["pane_timing"], r["claim_count"]) for r in rows.filter("coverage_type = 'hogar_incendio'").collect()]
    assert fire == [("LATE", 1)]
    life = {(str(r["window_start"])[11:13], r["pane_timing"]) for r in rows.filter("coverage_type = 'vida_individual'").collect()}
    assert ("11", "ON_TIME") in life and ("13", "EARLY") in life
    assert rows.select("firing_id").distinct().count() == rows.count()


def test_final_windows_and_lateness(spark, tmp_path):
    box = Inbox(spark, tmp_path, lateness=600)
    box.put(event(100, "10:05"), event(200, "10:55"))
    box.put(event(1, "11:05"))
    box.put(event(50, "10:59"))  # late, within the allowed lateness
    box.put(event(1, "11:30"))
    box.put(event(1, "11:31"))
    box.put(event(7, "10:58"))  # too late
    box.put(event(1, "13:00"))
    rows = box.run(streams.windowed(box.valid(), box.cfg)).orderBy("window_start").collect()
    assert [(r["claim_count"], r["total_amount_mxn"]) for r in rows] == [(3, 350.0), (3, 3.0)]


def test_updates_accumulate(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    box.put(event(10, "10:05"))
    box.put(event(20, "10:15"))
    rows = box.run(streams.windowed(box.valid(), box.cfg), "update").orderBy("batch_id").collect()
    assert [r["total_amount_mxn"] for r in rows] == [10.0, 30.0]


def test_dedup_per_window(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    box.put(event(1, "10:05", claim="dup-1"), event(2, "10:10", claim="unique-1"))
    box.put(event(3, "10:20", claim="dup-1"), event(4, "11:20", claim="dup-1"))
    rows = box.run(streams.deduplicated(box.valid(), box.cfg).drop("window")).collect()
    assert sorted((r["claim_id"], float(r["estimated_amount"])) for r in rows) == [("dup-1", 1.0), ("dup-1", 4.0), ("unique-1", 2.0)]


def test_routes_and_repeated_batches(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    box.put(event(1, "10:05"), "not json", event(-5, "10:06"), event(2, "10:07", "auto_colision"))
    valid, dead, motor = (str(tmp_path / n) for n in ("valid", "dead", "motor"))
    sink = sinks.route_batches(valid, dead, {motor: {"coverage_type": ["auto_colision"]}})
    streams.run_available(box.judged(), sink, str(tmp_path / "checkpoint"))
    again = ev.validate(spark.read.text(box.cfg.input_path))
    sink(again, 0)  # the same batch once more must not add rows
    count = lambda p: spark.read.parquet(p).count()
    assert (count(valid), count(dead), count(motor)) == (2, 2, 1)
    assert {r["error_type"] for r in spark.read.parquet(dead).collect()} == {"parse", "validate"}


def test_sessions(spark, tmp_path):
    box = Inbox(spark, tmp_path, lateness=60)
    box.put(event(1, "10:00"), event(2, "10:20"), event(3, "11:30"))
    box.put(event(9, "15:00"))
    rows = box.run(streams.sessions(box.valid(), box.cfg)).collect()
    assert sorted((r["claim_count"], r["total_amount_mxn"]) for r in rows) == [(1, 3.0), (2, 3.0)]


def test_late_arrivals(spark):
    rows = [("a", 0, 0), ("b", 600, 1), ("c", 300, 2), ("d", 700, 3), ("e", 100, 4)]
    df = spark.createDataFrame(
        [(c, datetime.fromtimestamp(1_700_000_000 + s), datetime.fromtimestamp(1_700_001_000 + n), n, c) for c, s, n in rows],
        "claim_id string, event_time timestamp, arrival_ts timestamp, event_id int, value string",
    )
    got = {r["claim_id"]: r["lateness_seconds"] for r in ev.late_arrivals(df, ["arrival_ts", "event_id"]).collect()}
    assert got == {"c": 300, "e": 600}


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        streams.kafka_stream(spark, "localhost:1", "claims")


def test_continuous_start_and_stop(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    box.put(event(1, "10:05"))
    cfg = StreamConfig(early_firing_seconds=1)
    query = streams.start(streams.windowed(box.valid(), box.cfg), sinks.append_batches(box.cfg.output_path), str(tmp_path / "cp"), cfg)
    until = time.time() + 60
    while query.lastProgress is None and time.time() < until:
        time.sleep(0.5)
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(box.cfg.output_path).agg(F.sum("claim_count")).first()[0] == 1
