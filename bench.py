"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of the tables (default sf0.1), BENCH_CPUS the number of local
cores (default 8). Every query runs once to warm up, then three times; the median counts.
A query is written to Spark's no-op sink, so all its rows are produced.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyloom.plans.queries import QUERIES  # noqa: E402
from tallyloom.session import local_session  # noqa: E402

HEADLINES = (
    "sheet_catalog",
    "column_profile",
    "typed_table_profile",
    "duplicate_rows",
    "document_duplicates",
    "quality_issues",
    "changed_sources",
    "tracker_upsert",
    "board_specs",
    "spec_variants",
    "merge_items",
    "merge_properties",
    "merge_fields",
    "apply_thresholds",
    "quarantine_delta",
)
RUNS = 3


def timed(query, spark, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name in HEADLINES:
        timed(QUERIES[name], spark, sf_dir)
        seconds[name] = round(statistics.median(timed(QUERIES[name], spark, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
