"""CLI: python tests/run_oracle.py [sf_dir] [key ...] — prints one line per key."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_harness import compare  # noqa: E402

from contrail.session import local_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(E.queries())
    spark = local_session(8)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys:
        t = time.time()
        try:
            r = compare(spark, k, qs[k], sqls[k], sf)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        r["sec"] = round(time.time() - t, 2)
        bad += not r["ok"]
        print(json.dumps(r, default=str), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
