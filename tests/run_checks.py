"""Compare all (or the named) queries: python tests/run_checks.py SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, duck  # noqa: E402
from triangulum.session import local_session  # noqa: E402


def main() -> int:
    sf, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = duck(sf), entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in sql:
                problems = compare(df, con, sql[name])
            else:
                n = len(df.collect())
                problems = [] if n else ["no rows"]
        except Exception as exc:  # report and go on
            problems = [f"{type(exc).__name__}: {str(exc)[:600]}"]
            if names:
                traceback.print_exc()
        mark = "ok  " if not problems else "FAIL"
        failed += bool(problems)
        print(f"{mark} {name:32s} {time.time() - start:6.2f}s {'sql' if name in sql else 'rows'} {'; '.join(problems)}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
