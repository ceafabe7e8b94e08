"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Warm session, one warm-up run, median of 3 timed runs per key (each run
fully materialises the result with a no-op write). The DuckDB time of the
same oracle SQL is reported next to it. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "split_counts",           # scan -> label encode -> exact rank per class -> split -> counts
    "stratified_split_exact",
    "day_partition",          # exact global numbering
    "clean_article",          # regex chain + NFKC UDF over all pages
    "text_length_profile",
    "word_count_box",         # exact distributed quantiles
    "build_vocab",
    "encode_truncate_pad",
    "train_nb",
    "score_nb",               # train + score, the flagship model path
    "classification_report",
    "confidence_box",
    "early_stop",
    "daily_predictions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = os.environ.get("BENCH_KEYS")
    keys = keys.split(",") if keys else HEADLINE

    from lectern.plans.oracle_check import duckdb_con
    from lectern.plans.registry import ORACLE, QUERIES, load_all
    from lectern.session import get_session

    load_all()
    spark = get_session(f"local[{cpus}]", app_name="lectern-bench",
                        conf={"spark.sql.shuffle.partitions": str(max(int(cpus) * 2, 8)),
                              "spark.driver.memory": "16g"})
    con = duckdb_con(sf_dir)

    def run_spark(key: str) -> float:
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def run_duck(key: str) -> float:
        t0 = time.perf_counter()
        con.sql(ORACLE[key]).fetchall()
        return time.perf_counter() - t0

    spark_times, duck_times = {}, {}
    for key in keys:
        run_spark(key)  # warm-up
        spark_times[key] = round(statistics.median(run_spark(key) for _ in range(runs)), 3)
        if key in ORACLE:
            run_duck(key)
            duck_times[key] = round(statistics.median(run_duck(key) for _ in range(runs)), 3)
        print(f"# {key}: spark {spark_times[key]}s duckdb {duck_times.get(key)}s", file=sys.stderr, flush=True)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum of per-query median wall time (warm, median of %d)" % runs,
        "value": round(sum(spark_times.values()), 3),
        "unit": "sec",
        "queries": spark_times,
        "duckdb_queries": duck_times,
        "duckdb_value": round(sum(duck_times.values()), 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
