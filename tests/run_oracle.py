"""Run every registered query against its oracle: ``python tests/run_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_harness import compare, duck_connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from scorecast.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck_connect(sf_dir)
    qs = entry.queries()
    sqls = entry.oracle_sql()
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sqls:
                res = compare(df, con, sqls[name])
            else:
                res = {"ok": True, "rows_spark": df.count(), "rows_only": True}
        except Exception as e:  # report and continue
            res = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:800]}"}
        res["sec"] = round(time.time() - t0, 2)
        spark.catalog.clearCache()
        results[name] = res
        print(name, json.dumps(res, default=str), flush=True)
    bad = [k for k, v in results.items() if not v["ok"]]
    print("FAILED:", bad)
    print(f"{len(results) - len(bad)}/{len(results)} ok")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
