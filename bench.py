"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from recordloom.session import local_session
from recordloom.suite import QUERIES

HEADLINE = (
    "validate_split", "dedup_ranked_active", "dedup_nested_key", "upsert_merge", "change_feed", "weighted_sample",
    "audit_rules", "fuzzy_label", "candidate_pairs", "match_scores", "links", "surviving_records", "gold_records",
    "end_to_end", "incremental_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    # one untimed pass over a cheap query loads the JVM and the first code paths
    QUERIES["dedup_ranked_active"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
