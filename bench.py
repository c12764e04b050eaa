"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores. Every
query runs whole into Spark's no-op sink; the time is the best of three runs after one
warm-up of the session.
"""

from __future__ import annotations

import json
import os
import time

from gradin.queries import QUERIES
from gradin.session import local_session

HEADLINES = (
    "silver_teams",
    "silver_players",
    "silver_scorers",
    "silver_played",
    "silver_standings",
    "dedupe_single_key",
    "dedupe_composite_key",
    "distinct_after_union",
    "flatten_matches",
    "flatten_standings",
    "dim_venue",
    "dim_calendar",
    "fact_match",
    "check_primary_key",
    "check_foreign_key",
    "orphans_set_null",
    "constraint_report",
    "bronze_ingest",
    "layered_run",
)
RUNS = 3


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_linenumber").count().collect()
    times = {
        name: round(min(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
        for name in HEADLINES
    }
    spark.stop()
    line = {
        "metric": "headline queries, total seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
