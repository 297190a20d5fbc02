"""Run every registered query against its oracle (what the driver's correctness gate does).

Usage: python tests/run_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

import __spark_entry__ as E  # noqa: E402
from fathom.session import build_session  # noqa: E402
from oracle_util import compare, duck  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = build_session(cpus=8)
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                r = compare(df, con, sqls[name])
            else:
                r = f"(no oracle) rows={df.count()}"
                r = None if df.count() >= 0 else r
        except Exception as e:  # report and continue
            r = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        bad += r is not None
        print(f"{'OK  ' if r is None else 'FAIL'} {name} {time.time() - t0:.1f}s" + ("" if r is None else "\n   " + r),
              flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
