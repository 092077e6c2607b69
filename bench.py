"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_ONLY`` a comma-joined choice.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tesselar.plans import views
from tesselar.plans.queries import BLOCKS, QUERIES, RANK
from tesselar.plans.train import TrainingParams, train_factors

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "ratings_scan blocks_write stratum_select block_cogroup block_error model_error init_factors "
    "fill_missing_factors dsgd_update sgd_update_sequential tumbling_alarm breach_counters "
    "scaling_decisions policy_actions health_state evict_first_failure active_members "
    "round_robin_assign last_minute_rps load_log_scan stream_metric_alarm"
).split()


def build_session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tesselar-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    spark = build_session()
    only = os.environ.get("BENCH_ONLY")
    names = only.split(",") if only else [*HEADLINE, "train"]
    seconds: dict[str, float] = {}
    details: dict[str, float] = {}
    # Start the JVM code paths and the Python workers before the clock.
    QUERIES["dsgd_update"](spark, SF_DIR).count()
    for name in names:
        started = time.perf_counter()
        if name == "train":
            params = TrainingParams(rank=RANK, blocks=BLOCKS, epochs=5)
            log = train_factors(views.ratings(spark, SF_DIR), params)[1].orderBy("iteration").collect()
            per_epoch = (log[-1]["seconds"] - log[0]["seconds"]) / (len(log) - 1)
            details = {"train_epoch_seconds": round(per_epoch, 3), "rmse": round(log[-1]["rmse"], 6)}
        else:
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                **details,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
