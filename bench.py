"""Time headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import time

from bazaarlens.session import local_session
from bazaarlens.plans import all_queries

HEADLINE = [
    "cre1_summary",
    "cre3_active",
    "cre9_percentiles",
    "vid1_hashtag_category",
    "vid2_leaderboard",
    "vid5_dictionary",
    "pur2_category_dict",
    "tag0_videos",
    "tag0_creators",
    "tag14_cascade",
    "mkt2_merge",
    "mkt5_share",
    "qc1_drift",
    "mon5_summary",
    "ss2_share",
    "liv9_product",
    "liv15_matrix",
    "cod2_score",
    "dq3_profile",
    "ded1_latest",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # the first query of a session also pays for starting the engine
    spark.read.parquet(f"{sf}/region.parquet").count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        all_queries.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/"))}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
