"""Time the headline queries and print one JSON line.

Each query runs twice and the shorter time counts, so that start-up of the JVM's
compiler is not charged to whichever query comes first.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from keeprule.plans.queries import QUERIES
from keeprule.session import build_session

HEADLINE = (
    "flag_table",
    "flag_totals",
    "case_holds",
    "expired_by_cluster_policy",
    "expired_dense",
    "assignment_diff",
    "assignment_diff_named",
    "ids_export",
    "snapshot_lookup",
    "id_batches",
    "sorted_ids",
    "sorted_assignments",
    "event_failures",
    "shell_dump_rows",
    "growth_by_month",
    "chunk_inventory",
    "purge_dry_run",
    "ingested_table",
    "incremental_flags",
)


def run(query, spark, folder: str) -> float:
    """Seconds to compute every row and column of the result."""
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "keeprule-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["full_scan"], spark, folder)
    seconds = {name: round(min(run(QUERIES[name], spark, folder) for _ in range(2)), 3) for name in names}
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
