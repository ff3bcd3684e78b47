"""Cost of steps that a reviewer found to grow too fast: how often state is called, input is read, and how wide a batch is."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lossline.functions import ordering
from lossline.operators import events as ev, features
from lossline.plans import queries_events
from lossline.plans.catalog import Data
from lossline.session import configure
from lossline.streaming import keyed, queries as streams


def test_repeat_claims_write_state_once_a_batch():
    class State:
        held, calls, timers = {}, 0, []

        def called(self, result=None):
            self.calls += 1
            return result

        iterator = lambda s: s.called(iter([((k,), (v,)) for k, v in s.held.items()]))
        updateValue = lambda s, k, v: s.called(s.held.__setitem__(k[0], v[0]))
        registerTimer = lambda s, at: s.called(s.timers.append(at))

    class Now:
        getCurrentWatermarkInMs = lambda s: 0

    state, processor = State(), keyed.RepeatProcessor(30, 2)
    processor.handle = processor.days = state
    days = [type("R", (), {"day": day, "n": 1}) for day in range(100, 120)]
    first = list(processor.handleInputRows(("p",), days, Now()))
    assert state.calls == 3  # read, write, timer
    assert [(r.day, r.claims_in_period) for r in first] == [(day, day - 99) for day in range(101, 120)]
    again = list(processor.handleInputRows(("p",), days[-1:], Now()))
    assert [(r.day, r.claims, r.claims_in_period) for r in again] == [(119, 2, 21)]


def _events(spark, folder, n):
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=i), i % 7, "click", 1.5, None) for i in range(n)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/events.parquet")
    return Data(spark, str(folder))


def _batches(d, seen):
    def sink(batch, batch_id):
        seen[batch_id] = ({r.event_id for r in batch.select("event_id").collect()}, batch.rdd.getNumPartitions())

    streams.run_available(queries_events._parted_stream(d, 3).select("event_id"), sink, d.scratch("checkpoint"))
    return [seen[b] for b in sorted(seen)]


def test_a_part_of_the_stream_is_read_by_several_tasks(spark, tmp_path):
    found = _batches(_events(spark, tmp_path, 300), {})
    good = {i for i in range(300) if i % 29 and i % 31 and i % 37 and i % 41}
    assert [ids for ids, _ in found] == [{i for i in good if i % 3 == part} for part in range(3)]
    assert min(tasks for _, tasks in found) > 1


def test_a_tiny_table_still_comes_in_three_batches(spark, tmp_path):
    found = _batches(_events(spark, tmp_path, 4), {})
    assert [ids for ids, _ in found] == [{3}, {1}, {2}]


def test_count_trigger_reads_its_events_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(value):
        read.add(1)
        return value

    amount = F.udf(seen, "decimal(28,6)")(F.col("id").cast("decimal(28,6)"))
    events = spark.range(200).select(F.col("id").alias("event_id"), amount.alias("estimated_amount"), F.lit("x" * 50).alias("value"))
    fired = ev.count_trigger(events, ["event_id"], 90).orderBy("firing").collect()
    assert [(r.firing, r.claim_count, r.min_amount_mxn) for r in fired] == [(0, 90, 0.0), (1, 90, 90.0), (2, 20, 180.0)]
    assert read.value == 200


def _payments(spark):
    rows = [(k, (i * 7) % 5, i, None if i % 9 == 0 else i) for k in (None, 1, 2, 3) for i in range(3 if k == 2 else 12)]
    rows += [(1, None, 99, 5), (1, 2, 98, 1)]
    return spark.createDataFrame(rows, "claim long, day int, id long, amount int").selectExpr("claim", "day", "id", "CAST(amount AS decimal(16,2)) AS amount")


def test_running_totals_of_long_and_short_keys(spark):
    df, spec = _payments(spark), ("claim", ["day", "id"], "amount", "total", "n")
    want = sorted(map(str, ordering._running_by_day(df, *spec).collect()))
    for long_key in (0, 12, 100):
        short, long = ordering.keyed_running_parts(df, *spec, long_key=long_key)
        few, many = short.collect(), long.collect()
        assert sorted(map(str, few + many)) == want
        assert short.schema.simpleString() == long.schema.simpleString()
        assert (not few) == (long_key == 0) and (not many) == (long_key == 100)


def test_short_claims_are_dealt_out_once(spark, capsys):
    short, _ = ordering.keyed_running_parts(_payments(spark), "claim", ["day", "id"], "amount", "total", "n")
    claims = spark.range(5).withColumnRenamed("id", "claim").hint("merge")
    short.join(claims, "claim").explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 3  # rows per claim, payments, claims; the join deals no payments out again


def test_a_task_counts_few_keys(spark):
    """Keys alone are few bytes in a shuffle; they are cut into small tasks, whatever the least number of partitions."""
    configure(spark)
    counted = spark.range(8_000_000).selectExpr("hash(id) * 4294967296 + id AS k").groupBy("k").count()
    assert max(r["count"] for r in counted.groupBy(F.spark_partition_id()).count().collect()) < 1_800_000


def _risks(spark, premiums, holders):
    policies = [(i, p, None if i == 7 else i % 4, 1.0 * i, 10.0) for i, p in enumerate(premiums)]
    experience = spark.createDataFrame(policies, "policy_id long, annual_premium int, policyholder_id long, total_incurred double, earned_premium double")
    experience = experience.selectExpr("*", "'auto' AS coverage_type", "1000 * policy_id AS deductible", "'not read' AS policy_status")
    return experience, spark.createDataFrame(holders, "policyholder_id long, current_age int, state_code string, occupation string, gender string")


def test_risk_segments_join_policies_once(spark):
    """The policies come from a join, which is to run once, whatever is worked out from them."""
    read = spark.sparkContext.accumulator(0)

    def seen(value):
        read.add(1)
        return value

    holders = [(0, 20, "A", "x", "F"), (1, 40, "B", "y", "M"), (1, 40, "B", "z", "M"), (2, 70, None, "x", "F"), (9, 30, "A", "y", "M")]
    experience, people = _risks(spark, [5, 3, None, 3, 8, 1, 4, 2, 9, 6], holders)
    experience = experience.withColumn("total_incurred", F.udf(seen, "double")("total_incurred"))
    rows = features.feat_risk_segments(experience, people).collect()
    # Policies 0, 1, 2, 4, 5, 6, 8, 9 have a holder, those of holder 1 two; the quarters count each once, nulls first.
    quarters = {2: "Q1", 5: "Q1", 1: "Q2", 6: "Q2", 0: "Q3", 9: "Q3", 4: "Q4", 8: "Q4"}
    want = [(i, quarters[i], o) for i in quarters for h, _, _, o, _ in holders if h == i % 4]
    assert sorted((r.policy_id, r.premium_band, r.occupation) for r in rows) == sorted(want)
    # Losses by state: A (0, 4, 8) 0.4, B (1, 5, 9) 0.5, none (2, 6) 0.4 and before A as a null.
    assert {(r.state_code, r.state_risk_group) for r in rows} == {("A", "medium"), ("B", "high"), (None, "high")}
    assert read.value <= 10
