"""Run registered queries beside their SQL: ``python check_queries.py [folder] [name ...]``."""

import sys
import time
import traceback

from stratiform.queries import oracles, queries
from stratiform.session import local_session
from tests.compare import connect, differences

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
names = sys.argv[2:]
spark = local_session(8)
spark.sparkContext.setLogLevel("ERROR")
con = connect(folder)
sql = oracles()
bad = 0
for name, fn in queries().items():
    if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
        continue
    began = time.time()
    try:
        frame = fn(spark, folder)
        found = differences(frame, con, sql[name]) if name in sql else [f"(no SQL) {frame.count()} rows"]
    except Exception as exc:
        found = [f"{type(exc).__name__}: {str(exc)[:900]}"]
        if "-v" in sys.argv:
            traceback.print_exc()
    ok = not found or found[0].startswith("(no SQL)")
    bad += not ok
    print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - began:.2f}s", *found, sep="\n      " if not ok else " ")
print("failures:", bad)
