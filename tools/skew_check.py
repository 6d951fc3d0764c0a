"""Hot-key check: a third of the sf0.1 call items on one base key; keep-first and
ordinals by ranges of (key, order), and with the final order in one exchange, must agree.

Usage: python tools/skew_check.py
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402
from cellsmith.session import local_session, scratch_path  # noqa: E402
from cellsmith.sources import fixtures as fx  # noqa: E402
from cellsmith.plans import jobs  # noqa: E402
from cellsmith.operators import keys as K  # noqa: E402
from cellsmith.operators.ranges import ordered_keys  # noqa: E402
spark = local_session("8", 8)
p = scratch_path(spark, "skew-items")
items, _ = jobs.call_items(fx.call_docs(spark, "/root/testdata/sf0.1"))
# a third of all items share one base key
skewed = items.withColumn("base", F.when(F.xxhash64("details_id", "id") % 3 == 0, F.lit("HOT_")).otherwise(F.col("base")))
skewed.write.parquet(p)
df = spark.read.parquet(p)
print("rows", df.count(), "hot rows", df.where("base = 'HOT_'").count(), flush=True)
noop = lambda d: d.write.format("noop").mode("overwrite").save()
order = list(jobs.CALL_ORDER)
def numbered(): return K.unique_sequence_key(df, "base", ["peer_number", "time"], order, "rowkey", "")
def ordered(): return ordered_keys(df, "base", order, ["peer_number", "time"], "")
for f in (numbered, ordered):
    noop(f())
for i in range(2):
    for f in (numbered, ordered):
        t0 = time.perf_counter(); noop(f()); print(f.__name__, round(time.perf_counter() - t0, 2), flush=True)
a, b = numbered(), ordered()
b = b.select(*a.columns)
print("same rows:", a.count() == b.count(), a.exceptAll(b).count() == 0, b.exceptAll(a).count() == 0)
