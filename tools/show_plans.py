"""Print the final (post-AQE) physical plans of the key queries, for review.

    python tools/show_plans.py [sf_dir] > plans.txt

Each query is executed once (collect) so that the adaptive plan is final; long expression lists
are shortened to keep the operator tree readable.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from daybook.plans import registered  # noqa: E402
from daybook.session import build_session  # noqa: E402

KEYS = [
    "daily_running_full",
    "daily_running_incremental",
    "stg_delete_insert",
    "partition_pruned_scan",
    "daily_arrow_batches_lines",
    "daily_arrow_grouped_lines",
    "avg_order_value",
]


def shorten(plan: str) -> str:
    out = []
    for line in plan.split("+- == Initial Plan ==")[0].splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        limit = 700 if "FileScan" in line else 170  # keep scan filters and read schema visible
        if len(line) > limit:
            line = line[:limit - 3] + "..."
        out.append(line)
    return "\n".join(out)


def key_index_lookup(spark, sf_dir: str) -> str:
    """The upsert's moved-order lookup through the bucketed key index (broadcast off, as at scale)."""
    import tempfile

    from pyspark.sql import functions as F

    from daybook import schemas as S
    from daybook.operators import staging
    from daybook.sources import adapters as A
    from daybook.sources.warehouse import KEY_HASH, Warehouse

    wh = Warehouse(spark, tempfile.mkdtemp(prefix="daybook-plans-"), key_index=True, key_buckets=16)
    staged = staging.stage_v2(A.events_source(spark, sf_dir))
    wh.write_full("stg_orders_v2", staged, S.ORDER_DATE)
    tbl, n = wh.ensure_key_index("stg_orders_v2", S.ORDER_ID)
    keys = staging.stage_v2(A.events_source(spark, sf_dir), A.EVENTS_FROM_DATE).select(S.ORDER_ID)
    keys = keys.select(F.xxhash64(S.ORDER_ID).alias(KEY_HASH)).repartition(n, KEY_HASH).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    q = spark.table(tbl).join(keys, KEY_HASH, "left_semi").select(S.ORDER_DATE).distinct()
    q.collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return shorten(q._jdf.queryExecution().executedPlan().toString())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    for key in KEYS:
        df = registered.QUERIES[key](spark, sf_dir)
        df.collect()
        print(f"### {key}\n")
        print("```")
        print(shorten(df._jdf.queryExecution().executedPlan().toString()))
        print("```\n")
    print("### staging upsert: moved-order lookup through the key index\n")
    print("```")
    print(key_index_lookup(spark, sf_dir))
    print("```\n")


if __name__ == "__main__":
    main()
