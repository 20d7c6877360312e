"""Run every query against its SQL: ``python tests/check_all.py FOLDER [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

import __spark_entry__ as driver
from compare import connect, differences
from keeprule.session import build_session


def main(folder: str, *names: str) -> int:
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = driver.queries(), driver.oracle_sql()
    connection = connect(folder)
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in sql:
                problem = differences(queries[name](spark, folder), connection, sql[name])
            else:
                queries[name](spark, folder).write.format("noop").mode("overwrite").save()
                problem = None
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed; without SQL: {sorted(set(queries) - set(sql))}; without query: {sorted(set(sql) - set(queries))}")
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(*sys.argv[1:])))
