"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and forces full evaluation
with the ``noop`` sink (every row and column computed, nothing collected).
Every query runs ``$BENCH_REPEATS`` times (default 2, each run rebuilds the
plan from the files; nothing is cached between runs); ``queries`` holds the
fastest run of each, ``first_run`` the first.  Prints one JSON line:
{"metric", "value" (sum of fastest seconds), "unit", "queries", "sf",
"repeats", "stat", "first_run", "first_run_total"}.

Driver-side time spent building a plan (e.g. the one-row max-day and the
top-10 list jobs) is included in each query's time.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwise import queries as Q  # noqa: E402
from cartwise.session import get_spark  # noqa: E402

def feature_job(spark, sf_dir):
    """E2 without the store: all three tables from the fused build."""
    from cartwise.plans.feature_job import build_feature_tables
    tables = build_feature_tables(Q._tx(spark, sf_dir), Q._products(spark, sf_dir), Q.FEATURE_DATE)
    for df in tables.values():
        df.write.format("noop").mode("overwrite").save()


EXTRA = {"feature_job": feature_job}


def plan_shape_comparison(spark, sf_dir) -> dict:
    """The original per-window plan shape vs the single pass, same session.

    Household x commodity grain over all commodities, all four windows; the
    original shape is the literal recipe of tests/test_entity_stack.py
    (per window: bounds job, 14 count(distinct), days-since aggregate,
    anchor join; windows chained by left joins).  Not part of ``value``.
    """
    from pyspark.sql import functions as F

    from cartwise.functions.dates import resolve_windows
    from cartwise.operators.features import window_features
    from tests.test_entity_stack import naive

    keys = ["household_key", "commodity_desc"]
    tx = Q._asof_normalized(spark, sf_dir)

    def timed(build):
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    def original_shape():
        out = tx.select(*keys).distinct()
        for w in resolve_windows(tx.agg(F.max("day")).first()[0]):
            out = out.join(naive(tx, keys, w), keys, "left")
        return out

    def single_pass():
        return window_features(tx, keys, resolve_windows(tx.agg(F.max("day")).first()[0]))

    return {"grain": "household_commodity", "windows": 4,
            "original_shape_sec": timed(original_shape), "single_pass_sec": timed(single_pass)}

HEADLINE = (
    "feature_job",
    "household_features",
    "commodity_features",
    "household_commodity_features",
    "get_features_household_commodity_90d",
    "top_commodities",
    "labels",
    "training_set",
    "scoring_set",
    "metric_roc_auc",
    "model_promotion",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up, not timed: JVM class loading, JIT and first code generation.
    # It runs the feature job on the smallest data set (a different
    # directory), so no result or cached data of the timed runs exists yet.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        feature_job(spark, warm)
    else:
        Q.REGISTRY["day_bounds"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    runs: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(repeats):
        for name in names:
            t0 = time.perf_counter()
            if name in EXTRA:
                EXTRA[name](spark, sf_dir)
            else:
                Q.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(round(time.perf_counter() - t0, 3))
    times = {n: min(v) for n, v in runs.items()}
    comparison = plan_shape_comparison(spark, sf_dir) if os.environ.get("BENCH_COMPARE", "1") == "1" else None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "repeats": repeats, "stat": "min",
                      "first_run": {n: v[0] for n, v in runs.items()},
                      "first_run_total": round(sum(v[0] for v in runs.values()), 3),
                      "plan_shape_comparison": comparison}))
    spark.stop()


if __name__ == "__main__":
    main()
