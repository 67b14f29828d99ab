"""Run every registered job and its SQL twin on one table folder.

    python tests/run_oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402

from lakegraph.session import get_spark  # noqa: E402


def main():
    args = [a for a in sys.argv[1:] if a != "--plain"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    only = set(args[1:])
    if "--plain" in sys.argv:      # a bare session, as an outside caller would build it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                r = compare(df, con, sqls[name])
            else:
                r = {"spark_rows": df.count(), "ok": None}
        except Exception as e:  # noqa: BLE001
            r = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
            traceback.print_exc()
        r["sec"] = round(time.time() - t, 2)
        bad += r.get("ok") is False
        print(name, json.dumps(r), flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main()
