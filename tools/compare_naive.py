"""Time the per-window recipe (the original plan shape) against the
single-pass build, on the same data and session.

usage: python tools/compare_naive.py [sf_dir] [grain]

The naive side is the literal recipe from tests/test_entity_stack.py: per
window an eager bounds job, one aggregate with 14 count(distinct), a second
days-since aggregate and an anchor join; the four windows chained by left
joins.  Both sides produce the same 376 metrics; both are forced with the
noop sink.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cartwise import queries as Q  # noqa: E402
from cartwise.functions.dates import resolve_windows  # noqa: E402
from cartwise.operators.features import window_features  # noqa: E402
from cartwise.session import get_spark  # noqa: E402
from tests.test_entity_stack import naive  # noqa: E402

GRAINS = {"household": ["household_key"], "commodity": ["commodity_desc"],
          "household_commodity": ["household_key", "commodity_desc"]}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = GRAINS[sys.argv[2] if len(sys.argv) > 2 else "household_commodity"]
    spark = get_spark("local[8]", 16)
    tx = Q._asof_normalized(spark, sf_dir)
    tx.write.format("noop").mode("overwrite").save()  # warm-up

    def run(build):
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 2)

    def naive_plan():
        out = tx.select(*keys).distinct()
        for w in resolve_windows(tx.agg(F.max("day")).first()[0]):  # one bounds job per window
            out = out.join(naive(tx, keys, w), keys, "left")
        return out

    def single_pass():
        return window_features(tx, keys, resolve_windows(tx.agg(F.max("day")).first()[0]))

    res = {"naive": [], "single_pass": []}
    for _ in range(2):
        res["naive"].append(run(naive_plan))
        res["single_pass"].append(run(single_pass))
    print(json.dumps({"sf_dir": sf_dir, "keys": keys, "seconds": res}))
    spark.stop()


if __name__ == "__main__":
    main()
