"""Write the formatted physical plans of the headline reports to docs/plans/.

    python tools/dump_plans.py [/root/testdata/sf0.1]

Two shapes per report: ``<name>.local.txt`` as planned on the given folder,
and ``<name>.large.txt`` with automatic broadcast joins off -- the plan the same code gets
when every table is too big to broadcast.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

HEADLINE = ["share_by_type_top5", "heaviest_products", "top_customers_metrics", "monthly_trend", "monthly_share",
            "weekly_moving_average", "year_over_year", "retention_matrix", "rfm_segments",
            "returning_customer_transactions", "products_never_ordered"]


def main(argv):
    src = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from ledgerlens.plans.registry import QUERIES
    from ledgerlens.session import local_session
    spark = local_session(8)
    out = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out, exist_ok=True)
    for shape in ("local", "large"):
        large = shape == "large"
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if large else "10485760")
        for name in HEADLINE:
            df = QUERIES[name](spark, src)
            text = df._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
            with open(os.path.join(out, f"{name}.{shape}.txt"), "w") as fh:
                fh.write(text)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
