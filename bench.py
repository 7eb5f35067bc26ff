"""Time the headline queries; prints one JSON line.

Each query is run once to warm up and then timed, written to a sink that
discards its rows, so that every column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import UTC, datetime

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from landfall import FrameSource, TableSpec, Target, prepare  # noqa: E402
from landfall.contracts.leads import lead_contracts  # noqa: E402
from landfall.queries import QUERIES  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "2"))
HEADLINE = (
    "new_rows_by_content_key",
    "new_rows_by_tally",
    "new_rows_deduped",
    "new_rows_null_keys",
    "new_rows_small_batch",
    "content_key_wide",
    "content_key_long_text",
    "content_key_sha3",
    "content_key_strict",
    "distinct_content",
    "clean_by_contract",
    "lead_assignment_contract",
    "parse_decimal",
    "parse_double",
    "parse_boolean",
    "parse_timestamp",
    "parse_date",
    "json_or_null",
    "range_clean_timestamp",
    "clamp_future",
    "conform_rename_fill",
    "append_result",
    "overwrite_result",
    "idempotent_rerun",
    "warehouse_follows_landing",
    "run_report",
)


def plan_widest(spark: SparkSession) -> float:
    """Seconds to build and plan the widest contract over text columns, without running it."""
    contract = lead_contracts("bench")["lead"]
    raw = spark.createDataFrame([], ", ".join(f"`{name}` string" for name in contract.raw_names))
    spec = TableSpec(
        "lead", FrameSource(raw), "BENCH", contract=contract, warehouse=Target(format="noop")
    )
    started = time.perf_counter()
    prepare(spark, spec, datetime.now(UTC))._jdf.queryExecution().executedPlan()
    return time.perf_counter() - started


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    home = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", home)
        .config("spark.sql.warehouse.dir", f"{home}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(min(run(name) for _ in range(ROUNDS)), 3)
    planning = min(plan_widest(spark) for _ in range(ROUNDS + 1))
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "planning": {"contract of 101 columns": round(planning, 3)},
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
