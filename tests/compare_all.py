"""Run every registered query against its oracle: python tests/compare_all.py [sf_dir] [names...]"""
import json, sys, tempfile, time, os
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from ledgerloom.session import build_session
import __spark_entry__ as E
from tests.harness import duck, compare

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session("local[8]", extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerloom-compare-")})
con = duck(sf)
q, o = E.queries(), E.oracle_sql()
bad = 0
for name in (names or sorted(q)):
    t = time.time()
    try:
        df = q[name](spark, sf)
        if name in o:
            r = compare(df, con, o[name])
        else:
            r = {"spark_rows": df.count(), "oracle": "none", "match": None}
    except Exception as e:
        r = {"error": repr(e)[:600], "match": False}
    r["sec"] = round(time.time() - t, 2)
    if r.get("match") is False:
        bad += 1
    print(name, json.dumps(r, default=str), flush=True)
print("MISMATCHES", bad)
