"""Compare registered queries with their DuckDB oracle: python tests/run_oracle.py [sf_dir] [keys...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from vigiframe.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
keys = sys.argv[2:]
spark = build_session()
Q, O = E.queries(), E.oracle_sql()
con = duck(sf)
bad = 0
for k in (keys or sorted(Q)):
    t = time.time()
    if k not in O:
        try:
            n = Q[k](spark, sf).count()
            print(f"{k:28s} NO-SQL rows={n} {time.time()-t:.1f}s", flush=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{k:28s} ERROR {type(e).__name__}: {str(e)[:300]}", flush=True)
        continue
    try:
        r = compare(spark, Q[k], O[k], sf, con)
    except Exception as e:  # noqa: BLE001
        bad += 1
        print(f"{k:28s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
        continue
    status = "OK " if r["ok"] else "BAD"
    bad += 0 if r["ok"] else 1
    extra = "" if r["ok"] else f" cols={r['spark_cols']} vs {r['oracle_cols']} diff={r.get('diff')}"
    print(f"{k:28s} {status} rows={r['spark_rows']}/{r['oracle_rows']} {time.time()-t:.1f}s{extra[:900]}", flush=True)
print("FAILED", bad, "of", len(keys or Q))
