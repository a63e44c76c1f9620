"""Run the range numbering with task failures injected, in its own session.

Tasks that read the sorted partitions fail on their first attempt (the failure is raised from
an Arrow pass put behind them); Spark retries them.  Prints the result as JSON so the
caller can compare it with a clean run.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import sparkdeck.operators.ordered as ordered  # noqa: E402
from sparkdeck.session import get_session  # noqa: E402

inject = sys.argv[1] == "inject"
spark = get_session("local[4,4]", app="retry-test", shuffle_partitions=8)   # 4 attempts per task

if inject:
    original = ordered.placed

    def failing(batches):
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        yield from batches

    def failing_placed(*args, **rest):
        rows = original(*args, **rest)
        return rows.mapInArrow(failing, rows.schema)

    ordered.placed = failing_placed

df = spark.range(20000).select(F.col("id"), (F.col("id") % 7).alias("g"), (F.col("id") * 31 % 101).alias("v"))
out = ordered.rank_within(df, ["g"], [("v", False)], name="rk", strategy="scan", num_partitions=8)
rows = sorted((r.id, r.rk) for r in out.collect())
print(json.dumps(rows))
spark.stop()
