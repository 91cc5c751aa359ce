"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``. Every query starts from the test tables; nothing is
kept between queries.
"""

from __future__ import annotations

import json
import os
import time

from kinmatch.plans.queries import QUERIES
from kinmatch.session import local_session

HEADLINE = (
    "normalize_series",
    "exact_name",
    "block_name",
    "block_addr",
    "block_all",
    "pair_features",
    "link_lists",
    "threshold_sweep",
    "stratified_sample",
    "validation_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, max(8, int(cores) if cores.isdigit() else 8))
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        table = QUERIES[name](spark, sf_dir)
        table.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "record linkage headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
