"""Run registered queries against their DuckDB oracles: python tests/check_oracle.py [sf_dir] [names...]"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle import compare  # noqa: E402
from tillbook.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(E.queries())
if os.environ.get("TILLBOOK_PLAIN_SESSION"):       # a session as the driver builds it
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
else:
    spark = local_session(8)
qs, sql = E.queries(), E.oracle_sql()
bad = 0
for n in names:
    t = time.time()
    try:
        df = qs[n](spark, sf)
        if n in sql:
            ok, msg = compare(df, sf, sql[n])
        else:
            ok, msg = True, f"{df.count()} rows (no oracle)"
    except Exception as e:  # noqa: BLE001
        ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {n:36s} {time.time()-t:6.2f}s {msg}", flush=True)
print("failures:", bad)
