"""CLI: python tests/check_oracle.py [sf_dir] [name ...] - run queries vs oracle.

Set ORACLE_JSON=<path> to also write the per-query results as one JSON object."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from burnup.session import get_session  # noqa: E402

if __name__ == "__main__":
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = get_session("oracle-check", "local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    results = {}
    for name in names or list(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sqls:
                r = compare(df, sqls[name], con)
            else:
                r = {"rows_spark": df.count(), "oracle": "none"}
        except Exception as e:  # noqa: BLE001
            r = {"error": repr(e)[:800]}
        r["sec"] = round(time.time() - t, 2)
        ok = r.get("values_match", "oracle" in r)
        bad += not ok
        results[name] = r
        print(("OK  " if ok else "BAD ") + name, json.dumps(r, default=str)[:1500], flush=True)
    print("failures:", bad)
    if os.environ.get("ORACLE_JSON"):
        with open(os.environ["ORACLE_JSON"], "w") as f:
            json.dump({"sf_dir": sf_dir, "failures": bad, "queries": results}, f, default=str, indent=1)
