"""CLI: python tests/run_oracle.py [sf_dir] [name-prefix...] -- prints one line per query."""

import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from encore.plans.registry import load_all  # noqa: E402
from encore.session import build_session  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
prefixes = sys.argv[2:]
spark = build_session("local[8]", 8)
con = duck(sf)
bad = 0
for name, q in sorted(load_all().items()):
    if prefixes and not any(name.startswith(p) for p in prefixes):
        continue
    t = time.time()
    if q.sql is None:
        n = q.build(spark, sf).count()
        print(f"ROWS  {name}: {n} rows ({time.time()-t:.1f}s)")
        continue
    try:
        probs, ns, nd = compare(spark, con, q.build, q.sql, sf)
    except Exception as e:  # report and continue
        probs, ns, nd = [f"ERROR {type(e).__name__}: {str(e)[:800]}"], -1, -1
    bad += bool(probs)
    print(f"{'OK  ' if not probs else 'FAIL'}  {name}: spark={ns} duck={nd} ({time.time()-t:.1f}s) {' | '.join(probs)}")
print(f"failures: {bad}")
