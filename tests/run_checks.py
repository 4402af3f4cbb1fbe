"""Compare queries with their SQL: python tests/run_checks.py [sf_dir] [name part ...]."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from florametrics.session import build_session  # noqa: E402
from florametrics_queries import ORACLES, QUERIES  # noqa: E402
from tests.compare import connect, difference, duck_rows, spark_rows  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session("checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name, fn in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            got = spark_rows(fn(spark, sf))
            spent = time.time() - start
            problem = difference(got, duck_rows(con, ORACLES[name])) if name in ORACLES else None
            if not got[1]:
                problem = problem or "no rows"
        except Exception as e:  # noqa: BLE001
            spent, problem, got = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}", ([], [])
            if "-v" in parts:
                traceback.print_exc()
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {spent:6.2f}s {len(got[1]):7d} rows {problem or ''}"
              f"{'' if name in ORACLES else ' (rows only)'}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
