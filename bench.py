"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from lossline.plans import catalog

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
QUERIES = (
    "run_layers",
    "rpt_loss_triangle",
    "rpt_claim_frequency",
    "fct_claims",
    "int_claim_payments_cumulative",
    "chain_ladder_ultimate",
    "bi_geo_risk",
    "dq_claims_rules",
    "dq_referential",
    "ord_running_sum",
    "batch_hourly_summary",
    "str_dead_letters",
    "stream_final_only",
    "model_training_set",
    "eval_lift_table",
    "glm_pure_premium",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lossline-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lossline-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    built = catalog.queries()
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in QUERIES:
        begun = time.perf_counter()
        built[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "lossline_headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
