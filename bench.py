"""Benchmark: the two-load scenario and the heavy operators at one scale factor.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints one JSON line. Operators are forced with the ``noop`` sink (full
evaluation, nothing collected) or, for small results, ``collect``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import schemas  # noqa: E402
from tidemark.operators import checks, dates, facts, reports, scd  # noqa: E402
from tidemark.plans import scenario  # noqa: E402
from tidemark.plans.publish import Warehouse  # noqa: E402
from tidemark.plans.run import read_state, run  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402
from tidemark.sources import fixtures  # noqa: E402


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = build_session(app="tidemark-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    spark.range(1).collect()  # JVM warm-up outside the timings
    t0 = time.perf_counter()
    v1, v2 = scenario.materialise_sources(spark, sf_dir)  # building the sources is no part of the loads
    build = round(time.perf_counter() - t0, 3)
    start, end = scenario.calendar_range(spark, sf_dir)
    wh = Warehouse(spark, scratch_path(spark, "bench-warehouse"))
    r1 = timed("load1_cold", lambda: run(spark, wh, v1, run_ts=scenario.RUN1_TS, date_start=start,
                                          date_end=end, run_id="load1", keep_staging=True))
    r2 = timed("load2_incremental", lambda: run(spark, wh, v2, run_ts=scenario.RUN2_TS, date_start=start,
                                                 date_end=end, run_id="load2", keep_staging=True))
    st = read_state(wh)

    # Fact-scale as-at resolution: every v2 line against the versioned dimension.
    timed("as_at_join", lambda: _noop(facts.stage_facts(v2.order_line, st.dim_customer)))
    # Type 2 classification of the whole v2 customer source against the dimension.
    timed("scd2_classify", lambda: _noop(scd.classify_type2(
        st.dim_customer, v2.customer.select("customer_id", *schemas.CUSTOMER_ATTRIBUTES),
        "customer_id", schemas.CUSTOMER_ATTRIBUTES)))
    # Delete-then-insert merge of the load-2 staged facts into the whole fact.
    timed("fact_merge", lambda: _noop(facts.merge_facts(st.fact_order_line, r2.details["stg_fact"],
                                                        loaded_at=datetime(2026, 1, 2))))
    timed("validate_history", lambda: checks.validate_history(st.dim_customer, "customer_id").collect())
    defective = fixtures.planted_defects(st.dim_customer)
    timed("history_overlaps_defective", lambda: checks.history_overlaps(defective, "customer_id").collect())
    timed("segment_revenue", lambda: reports.segment_revenue(st.fact_order_line, st.dim_customer).collect())
    timed("audit_as_at", lambda: checks.audit_as_at(st.fact_order_line, st.dim_customer, v2.order_line).collect())
    timed("dim_date", lambda: _noop(dates.calendar(spark, start, end)))

    facts_rows = st.fact_order_line.count()
    print(json.dumps({
        "metric": "two_load_scenario_plus_operators",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "rows": {"fact_order_line": facts_rows, "load2_read": r2.facts_read,
                 "load1_read": r1.facts_read},
        "load_phases": {"load1": r1.timings, "load2": r2.timings},
        "build_sources_sec": build,
        "load2_rewritten_rows": r2.appended,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
