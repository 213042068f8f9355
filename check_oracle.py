"""Compare every registered query with its DuckDB oracle: ``python check_oracle.py [sf_dir] [name...]``."""

import sys
import time

from mailframe.plans import ORACLE_SQL, QUERIES
from mailframe.session import get_session
from tests.oracle_compare import compare, duck

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        try:
            df = QUERIES[n](spark, sf_dir)
            if n in ORACLE_SQL:
                ok, msg = compare(df, con, ORACLE_SQL[n])
            else:
                ok, msg = True, f"{df.count()} rows (no oracle)"
        except Exception as e:  # report and go on
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} {time.time()-t:6.2f}s {msg}", flush=True)
    print("failures:", bad)
