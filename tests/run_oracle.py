"""Run every registered query in Spark and its oracle in DuckDB; print one line per query.

Usage: python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as E  # noqa: E402
from bidscope.session import get_session  # noqa: E402
from tests.compare import assert_same, duck  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = get_session("local[8]")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            if name not in sqls:
                n = fn(spark, sf).count()
                print(f"ROWS  {name:34s} {n:6d} (no oracle) {time.time() - t:5.1f}s", flush=True)
                continue
            n = assert_same(fn(spark, sf), con, sqls[name], name)
            print(f"OK    {name:34s} {n:6d} {time.time() - t:5.1f}s", flush=True)
        except AssertionError as e:
            bad += 1
            print(f"FAIL  {name:34s} {str(e)[:1500]}", flush=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {name:34s} {type(e).__name__}: {str(e)[:800]}", flush=True)
            traceback.print_exc(limit=2)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
