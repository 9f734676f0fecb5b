"""Time the headline queries and print one JSON line.

Input is ``$BENCH_SF_DIR`` (default sf0.1), run on ``local[$BENCH_CPUS]``.
Each query runs twice, result rows written to Spark's no-op sink; the faster
run counts.  Shuffle bytes are those of that run, as Spark reports them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from evenkeel import reconcile  # noqa: E402
from queries import QUERIES  # noqa: E402
from queries.registry import table  # noqa: E402

HEADLINE = (
    "reconcile_flagship", "reconcile_hash", "reconcile_exact", "reconcile_anti_inner", "reconcile_identical",
    "reconcile_summary", "reconcile_composite_key", "reconcile_repeated_rows", "reconcile_duplicates", "reconcile_filtered",
    "reconcile_from_snapshot", "reconcile_coerced", "diff_by_type", "diff_by_column", "normalise_values",
    "filter_pk_range", "filter_pk_set_table", "filter_date_range", "apply_mapping_derived", "enrich_many",
    "null_handling", "fill_mode", "dialect_coercion", "scalar_numeric_rules", "schema_diff", "not_null_check",
    "check_key_unique", "check_join_fanout", "csv_roundtrip", "upsert_merge", "reconcile_skip_equal", "reconcile_saved_sides",
    "upsert_partitions", "enrich_hot_key",
)


def identical(strategy):
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders")
        return reconcile(orders, orders, "o_orderkey", strategy=strategy).summary

    return run


def shuffled_bytes(spark) -> int:
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="evenkeel-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    runs = {n: QUERIES[n] for n in HEADLINE}
    runs |= {f"identical_{s}": identical(s) for s in ("hash", "exact", "anti")}

    seconds, shuffled = {}, {}
    for name, fn in runs.items():
        for _ in range(2):
            bytes_before, start = shuffled_bytes(spark), time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if took < seconds.get(name, float("inf")):
                seconds[name] = round(took, 3)
                time.sleep(0.05)  # let the last task metrics arrive
                shuffled[name] = shuffled_bytes(spark) - bytes_before
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "shuffle_bytes": shuffled,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
