"""Print the physical plans of the heavy operators as a large run would get
them: broadcasts disabled, so the sort-merge / skew-split strategies show.

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import schemas, session  # noqa: E402
from tidemark.operators import checks, facts, reports, scd  # noqa: E402
from tidemark.operators.extract import extract  # noqa: E402
from tidemark.plans import scenario  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session.build_session()
    sc = scenario.get(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.BROADCAST_MAX_ROWS = 0
    st = sc.state2
    plans = {
        "extract (pushed window, pruned columns)": extract(
            sc.v2.order_line, sc.report2.low_water, sc.report2.high_water, ["order_line_id", "customer_id"]),
        "classify_type2 (one exchange, partial aggregation)": scd.classify_type2(
            st.dim_customer, sc.v2.customer.select("customer_id", *schemas.CUSTOMER_ATTRIBUTES),
            "customer_id", schemas.CUSTOMER_ATTRIBUTES),
        "as_at_join (sort-merge with range residual)": facts.as_at_join(
            sc.v2.order_line, st.dim_customer).select("order_line_id", "customer_sk"),
        "segment_revenue (per-key partial sums before the join)": reports.segment_revenue(
            st.fact_order_line, st.dim_customer),
        "history_multi_current": checks.history_multi_current(st.dim_customer, "customer_id"),
    }
    for title, df in plans.items():
        print("=" * 8, title)
        df.explain("formatted")


if __name__ == "__main__":
    main()
