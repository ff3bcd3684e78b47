"""Stateful operators with state per key: late arrivals, repeat claims, sessions, and policy versions at event time.

Events that only count or add up are reduced to one row per key and Arrow batch before the shuffle, so a key that
holds most events does not send them all to one task. State is bounded by event time: days and sessions that no event ahead
of the watermark can reach are forgotten.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lossline.config import StreamConfig

AMOUNT = "decimal(38,6)"
_DAY_MS = 86_400_000
#: What a reduced row says of its events; event_time is that of the last one.
REDUCED = f"n BIGINT, total {AMOUNT}, low {AMOUNT}, high {AMOUNT}, first TIMESTAMP, event_time TIMESTAMP"


def reduced(events: DataFrame, keys: dict[str, Column], kinds: str) -> DataFrame:
    """One row per key and Arrow batch; keys by name, their types as DDL. Sums are exact decimals."""
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                said = [("amount", "count"), ("amount", "sum"), ("amount", "min"), ("amount", "max"), ("event_time", "min"), ("event_time", "max")]
                said[0] = ("event_time", "count")
                summed = pa.Table.from_batches([batch]).group_by(names).aggregate(said)
                order = [*names, "event_time_count", *[f"{c}_{how}" for c, how in said[1:]]]
                yield from summed.select(order).rename_columns([*names, "n", "total", "low", "high", "first", "event_time"]).combine_chunks().to_batches()

    narrow = events.select(*[c.alias(n) for n, c in keys.items()], F.col("estimated_amount").cast(AMOUNT).alias("amount"), "event_time")
    return narrow.mapInArrow(run, f"{kinds}, {REDUCED}")


# --- late arrivals ----------------------------------------------------------------------------

LATE = "claim_id STRING, event_time TIMESTAMP, arrival_ts TIMESTAMP, value STRING, lateness_seconds BIGINT"


class LateProcessor(StatefulProcessor):
    """Of one arrival shard the latest event time so far; every event comes out with how far it is behind."""

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "us BIGINT")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable", ignore_index=True)
        seconds = batch["event_time"].astype("datetime64[us]").astype("int64")
        held = self.newest.get()[0] if self.newest.exists() else None
        before = seconds.cummax().shift(1)
        before = before.fillna(seconds if held is None else held)
        if held is not None:
            before = before.clip(lower=held)
        # Whole seconds of both instants, as the batch form counts them.
        late = (before.astype("int64") // 1_000_000 - seconds // 1_000_000).where(seconds < before)
        self.newest.update((max(int(seconds.max()), held if held is not None else int(seconds.max())),))
        out = batch[["claim_id", "event_time", "arrival_ts", "value"]].copy()
        out["lateness_seconds"] = late.astype("Int64")
        yield out


def with_lateness(events: DataFrame, shard: Column, order: list[str]) -> DataFrame:
    """Events (claim_id, event_time, arrival_ts, value) with lateness_seconds: how far behind the latest event that
    arrived before in the same shard; null if none was later.

    A shard is what arrives in one order, such as a partition of the source; its rows of one batch are put in that order in
    one task, so the batch size over the shards bounds its memory. State is one number per shard.
    """
    picked = events.select(shard.alias("shard"), *dict.fromkeys(["claim_id", "event_time", "arrival_ts", "value", *order]))
    return picked.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=LateProcessor(order), outputStructType=LATE, outputMode="Append", timeMode="None"
    )


# --- repeat claims ------------------------------------------------------------------------------


class RepeatProcessor(StatefulProcessor):
    """Claims per day of one policy, as far back as a day to come can reach.

    Every call to the state is a round trip, so the days of a policy are one entry (day, claims, day, claims, ...): it is read
    once and written once per batch.
    """

    def __init__(self, days: int, at_least: int):
        self.span, self.at_least = days, at_least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("claims_by_day", "part INT", "claims ARRAY<BIGINT>")

    def close(self) -> None:
        pass

    def _held(self) -> dict[int, int]:
        return {int(day): int(n) for _, (flat,) in self.days.iterator() for day, n in zip(flat[::2], flat[1::2])}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._held()
        changed = set()
        for part in rows:
            held[part.day] = held.get(part.day, 0) + part.n
            changed.add(part.day)
        oldest = timerValues.getCurrentWatermarkInMs() // _DAY_MS - self.span
        self.days.updateValue((0,), ([x for day, n in held.items() if day >= oldest for x in (day, n)],))
        self.handle.registerTimer((max(held) + self.span + 1) * _DAY_MS)
        for day in sorted(held):
            if any(day - self.span <= c <= day for c in changed):
                total = sum(n for d, n in held.items() if day - self.span <= d <= day)
                if total >= self.at_least:
                    yield Row(policy_id=key[0], day=day, claims=held[day], claims_in_period=total)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        newest = max(self._held(), default=None)
        if newest is None or expiredTimerInfo.getExpiryTimeInMs() >= (newest + self.span + 1) * _DAY_MS:
            self.days.clear()
        return iter(())


def repeat_claims(events: DataFrame, cfg: StreamConfig, days: int = 30, at_least: int = 2) -> DataFrame:
    """Per policy and day of a claim the claims of that and the `days` days before, if at_least; in update mode, so the
    last row of a policy and day counts.

    Claims may be as late as the allowed lateness. Of a policy the days within `days` of the watermark are held, none
    once the watermark has passed its last claim by more.
    """
    keys = {"policy_id": F.col("policy_id"), "day": F.unix_date(F.to_date("event_time"))}
    daily = reduced(events, keys, "policy_id STRING, day INT").withWatermark("event_time", cfg.lateness)
    found = daily.groupBy("policy_id").transformWithState(
        statefulProcessor=RepeatProcessor(days, at_least),
        outputStructType="policy_id STRING, day INT, claims BIGINT, claims_in_period BIGINT",
        outputMode="Update",
        timeMode="EventTime",
    )
    return found.select("policy_id", F.date_from_unix_date("day").alias("claim_date"), "claims", "claims_in_period")


# --- sessions -----------------------------------------------------------------------------------


def sessions(events: DataFrame, cfg: StreamConfig, key: str = "policy_id", gap_seconds: int = 1800) -> DataFrame:
    """Closed sessions per key: events less than the gap apart belong together; nothing is said of open ones.

    With the settings of session.configure_state_store, the sessions of each task's events are what is shuffled and merged
    in state.
    """
    # Spark joins windows that touch; a microsecond less keeps events apart that are a whole gap apart.
    window = F.session_window("event_time", f"{gap_seconds * 1_000_000 - 1} microseconds")
    closed = events.withWatermark("event_time", cfg.lateness).groupBy(key, window.alias("s")).agg(
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("last_event"),
        F.count("*").alias("claim_count"),
        F.round(F.sum(F.col("estimated_amount").cast(AMOUNT)), 2).cast("double").alias("total_amount_mxn"),
    )
    return closed.drop("s")


# --- policy versions ------------------------------------------------------------------------------


def enrich_with_versions(events: DataFrame, versions: DataFrame, cfg: StreamConfig, longest: str = "366 days", how: str = "inner") -> DataFrame:
    """Events with the version of their policy that is valid at event time.

    versions: policy_id, valid_from, valid_to (exclusive) and what a version says; no version lasts longer than `longest`.
    Both streams have a watermark, so an event is held until no version can begin before it any more, a version until no
    event can fall into it. With how="left", events of unknown policies come out then, without a version.
    """
    left = events.withWatermark("event_time", cfg.lateness).alias("e")
    names = [c for c in versions.columns if c not in ("policy_id", "valid_from", "valid_to")]
    right = versions.select(
        F.col("policy_id").alias("_policy"), F.col("valid_from").alias("valid_from"), F.col("valid_to").alias("_to"), *names
    ).withWatermark("valid_from", cfg.lateness)
    valid = (
        (F.col("policy_id") == F.col("_policy"))
        & (F.col("event_time") >= F.col("valid_from"))
        & (F.col("event_time") < F.col("_to"))
        & (F.col("event_time") < F.col("valid_from") + F.expr(f"INTERVAL {longest}"))
    )
    return left.join(right, valid, {"left": "leftOuter"}.get(how, how)).drop("_policy", "_to")
