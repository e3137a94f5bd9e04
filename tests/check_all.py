"""Run registered queries against DuckDB: ``python tests/check_all.py [sf] [name-part ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

import __spark_entry__ as entry_module  # noqa: E402
from compare import differences, oracle  # noqa: E402

from riskloom.session import local_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = oracle(sf), entry_module.oracle_sql(), 0
    for name, run in entry_module.queries().items():
        if len(argv) > 1 and not any(part in name for part in argv[1:]):
            continue
        start, spent = time.time(), 0.0
        try:
            df = run(spark, sf)
            rows = df.collect()
            spent = time.time() - start
            if name in sqls:
                problem = differences(df, rows, con, sqls[name])
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                state, problem = f"rows only {len(rows)} {rows[:2]}", None
        except Exception as error:
            traceback.print_exc(limit=3)
            state, problem = f"ERROR {str(error)[:600]}", error
        failed += problem is not None
        print(f"{name:28s} {spent:6.2f}s {state}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
