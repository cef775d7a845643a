"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from checks.catalogue import CHECKS
from fieldmark import get_session

HEADLINES = [
    "fs_place_history",
    "fs_market_risk",
    "fs_policy_economics",
    "fs_insurer_risk",
    "fs_rate_reference",
    "fs_portfolio",
    "silver_policies",
    "w1_deduplicate",
    "j3_district_fallback",
    "d5_training_set",
    "a19_numeric_summary",
    "e_all_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINES:
        best = None
        for _ in range(2):
            began = time.time()
            # The work itself: rounding and date text only serve the comparison with SQL.
            CHECKS[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.time() - began
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)
    result = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
