"""Panes: early, on-time and late results of each window, every one over all data so far.

Structured Streaming drops rows behind its watermark before a stateful operator sees them.
The watermark of this operator therefore trails the newest event by the allowed lateness plus one
window, and the point up to which input counts as complete (``complete_to``) is kept that much ahead
of it. Windows close at complete_to = window end and are forgotten the allowed lateness later.

Events are reduced to one row per window, coverage and Arrow batch before the shuffle, so a
coverage that holds most events does not send them all to one task, and the state of a
window is one row of totals. Money stays decimal, so no total depends on the order of arrival or leaves its range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lossline.config import StreamConfig
from lossline.streaming.keyed import AMOUNT, reduced

_PANE = (
    f"coverage_type STRING, window_end_ms BIGINT, n BIGINT, total {AMOUNT}, low {AMOUNT}, high {AMOUNT}, "
    "pane_timing STRING, firing_id STRING"
)
_STATE = f"n BIGINT, total {AMOUNT}, low {AMOUNT}, high {AMOUNT}, fired BOOLEAN"


class PaneProcessor(StatefulProcessor):
    """Totals of one (coverage, window); fires a pane per batch with new data and one on time."""

    def __init__(self, window_ms: int, lateness_ms: int):
        self.window_ms = window_ms
        self.lateness_ms = lateness_ms
        self.ahead_ms = window_ms + lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", _STATE)

    def close(self) -> None:
        pass

    def _complete_to(self, timer_values) -> int:
        watermark = timer_values.getCurrentWatermarkInMs()
        return watermark + self.ahead_ms if watermark > 0 else 0

    @staticmethod
    def _pane(key, totals, timing: str) -> Row:
        coverage, end = key
        n, total, low, high = totals
        identity = hashlib.sha1(f"{coverage}|{end}|{timing}|{n}".encode()).hexdigest()
        return Row(
            coverage_type=coverage,
            window_end_ms=end,
            n=n,
            total=total,
            low=low,
            high=high,
            pane_timing=timing,
            firing_id=identity,
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end = key[1]
        complete_to = self._complete_to(timerValues)
        if complete_to > end + self.lateness_ms:
            return
        held = self.totals.get() if self.totals.exists() else None
        if held is None:
            n, total, low, high, fired = 0, 0, None, None, complete_to >= end
            for due in {end - self.ahead_ms, end + self.lateness_ms - self.ahead_ms}:
                self.handle.registerTimer(due)
        else:
            n, total, low, high, fired = held
            if not fired and complete_to >= end:
                yield self._pane(key, (n, total, low, high), "ON_TIME")
                fired = True
        for part in rows:
            n, total = n + part.n, total + part.total
            low, high = part.low if low is None else min(low, part.low), part.high if high is None else max(high, part.high)
        self.totals.update((n, total, low, high, fired))
        yield self._pane(key, (n, total, low, high), "LATE" if fired else "EARLY")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = key[1]
        if not self.totals.exists():
            return
        n, total, low, high, fired = self.totals.get()
        if not fired:
            self.totals.update((n, total, low, high, True))
            yield self._pane(key, (n, total, low, high), "ON_TIME")
        if expiredTimerInfo.getExpiryTimeInMs() >= end + self.lateness_ms - self.ahead_ms:
            self.totals.clear()


def pane_summary(events: DataFrame, cfg: StreamConfig) -> DataFrame:
    """Pane rows of a stream of valid events (event_time, coverage_type, estimated_amount)."""
    window_ms, lateness_ms = cfg.window_seconds * 1000, cfg.allowed_lateness_seconds * 1000
    end = F.unix_millis(F.window("event_time", cfg.window)["end"])
    keys = {"coverage_type": F.col("coverage_type"), "window_end_ms": end}
    partial = reduced(events, keys, "coverage_type STRING, window_end_ms BIGINT").withWatermark(
        "event_time", f"{cfg.window_seconds + cfg.allowed_lateness_seconds} seconds"
    )
    fired = partial.groupBy("coverage_type", "window_end_ms").transformWithState(
        statefulProcessor=PaneProcessor(window_ms, lateness_ms),
        outputStructType=_PANE,
        outputMode="Update",
        timeMode="EventTime",
    )
    money = lambda name: F.col(name).cast("decimal(28,6)")
    total = money("total")
    return fired.select(
        F.timestamp_millis(F.col("window_end_ms") - window_ms).alias("window_start"),
        F.timestamp_millis("window_end_ms").alias("window_end"),
        "coverage_type",
        F.col("n").alias("claim_count"),
        F.round(total, 2).cast("double").alias("total_amount_mxn"),
        F.round(total / F.col("n"), 2).cast("double").alias("avg_amount_mxn"),
        F.round(money("low"), 2).cast("double").alias("min_amount_mxn"),
        F.round(money("high"), 2).cast("double").alias("max_amount_mxn"),
        "pane_timing",
        "firing_id",
    )
