"""Times headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8). Each
query is run once to warm up and then three times into a ``noop`` sink; the middle time
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.compare import local_session
from checks.queries import LINE_KEY, QUERIES, lineitem
from strata.functions.hashing import record_hash, surrogate_key
from strata.operators import quality
from strata.operators.dedupe import latest_per_key
from strata.operators.merge import merge_scd1
from strata.operators.quality import Rule
from strata.sources import raw
from strata.streaming.watermark import incremental_slice, watermark_bounds

RUNS = 3

PROBE_RULES = [
    Rule(f"R{i}", text, text, quality.QUARANTINE)
    for i, text in enumerate(
        (
            "l_quantity > 5",
            "l_discount <= 0.09",
            "l_tax < 0.08",
            "l_extendedprice > 1000",
            "l_orderkey IS NOT NULL",
            "l_returnflag <> 'R'",
            "l_linenumber < 7",
        )
    )
]


def floor_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(lineitem(spark, folder), LINE_KEY, "l_shipdate")


def floor_hash(spark: SparkSession, folder: str) -> DataFrame:
    df = lineitem(spark, folder)
    return df.withColumns({"record_hash": record_hash(df), "line_key": surrogate_key("l_orderkey")})


def floor_merge(spark: SparkSession, folder: str) -> DataFrame:
    orders = raw.table(spark, folder, "orders")
    target = orders.filter(F.col("o_orderkey") % 3 != 0)
    source = orders.filter(F.col("o_orderkey") % 2 == 0)
    return merge_scd1(target, source, ["o_orderkey"], compare=None)


def floor_quality(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Counts of all rules and the good rows: two passes whatever the number of rules."""
    classified = quality.classify(lineitem(spark, folder), PROBE_RULES)
    return [quality.rule_counts(classified, PROBE_RULES), quality.good_rows(classified)]


def floor_watermark(spark: SparkSession, folder: str) -> DataFrame:
    pending = incremental_slice(lineitem(spark, folder), "l_shipdate", "1998-01-01")
    return watermark_bounds(pending, "l_shipdate")


FLOORS = {
    "floor_dedupe": floor_dedupe,
    "floor_hash": floor_hash,
    "floor_merge": floor_merge,
    "floor_quality": floor_quality,
    "floor_watermark": floor_watermark,
}
HEADLINE = (
    "silver_service_order",
    "silver_repair_job",
    "silver_vehicle_daily_usage",
    "fact_service_order",
    "fact_repair_job",
    "dim_date",
    "dedupe_counts",
    "merge_scd1",
    "merge_measured",
    "merge_actions",
    "dq_good",
    "dq_results",
    "incremental_slice",
    "workflow_rollup",
    "latest_runs",
    "gold_row_counts",
    "silver_load_merge",
    "gold_load_merge",
    "gold_load_incremental",
    "stream_silver",
)


def run_once(query, spark: SparkSession, folder: str) -> float:
    start = time.perf_counter()
    result = query(spark, folder)
    for df in result if isinstance(result, list) else [result]:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(chosen: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    queries = {**FLOORS, **{name: QUERIES[name] for name in HEADLINE}}
    times = {}
    for name in chosen or queries:
        query = queries.get(name) or QUERIES[name]
        run_once(query, spark, folder)
        times[name] = round(statistics.median(run_once(query, spark, folder) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
