"""Registered queries: one per operator, each over the two-load scenario built
from the given tables (see ``plans/scenario.py``).

Output typing is chosen so that results compare the same way whichever client
reads them: money is its exact decimal's unscaled value as BIGINT (price 1.5 at
scale 4 is 15000), dates are text, and validity bounds are text ('yyyy-MM-dd HH:mm:ss'), since the open end
9999-12-31 23:59:59 is outside what nanosecond timestamps can hold.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.expressions import null_safe_difference
from tidemark.operators import checks, control, facts, reports, scd
from tidemark.operators.extract import extract, high_water_frame
from tidemark.plans import scenario
from tidemark.plans.publish import Warehouse
from tidemark.plans.run import read_state, run
from tidemark.session import scratch_path, stage
from tidemark.sources import fixtures

_TEXT_TS = ("valid_from", "valid_to")


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = (c * 10 ** f.dataType.scale).cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif f.name in _TEXT_TS:
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _sc(spark: SparkSession, sf_dir: str) -> scenario.Scenario:
    return scenario.get(spark, sf_dir)


def _rows(df: DataFrame, metrics: dict) -> DataFrame:
    """One aggregate of ``df`` as rows (metric, n)."""
    each = [F.struct(F.lit(name).alias("metric"), F.coalesce(n, F.lit(0)).cast("long").alias("n")) for name, n in metrics.items()]
    return df.agg(F.array(*each).alias("rows")).select(F.explode("rows").alias("r")).select("r.metric", "r.n")


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _actions(classified: DataFrame, **names: str | None) -> DataFrame:
    """(metric, n): how many staged keys had each action; 0 for a metric without one."""
    return _rows(classified, {m: F.count_if(F.col("action") == a) if a else F.lit(0) for m, a in names.items()})


def _type1_stats(report) -> DataFrame:
    return _actions(report.details["type1"].classified, inserted=scd.NEW, updated=scd.CHANGED, versioned=None, unchanged=None)


def _type2_stats(report) -> DataFrame:
    return _actions(report.details["type2"].classified, inserted=scd.NEW, updated=None, versioned=scd.CHANGED, unchanged=scd.UNCHANGED)


def _fact_stats(report, before, after, inferred: bool = True) -> DataFrame:
    """(metric, n) of a load's facts: its staged rows beside the fact before, and the members it lacked."""
    staged, known = report.details["stg_fact"], before.fact_order_line.select("order_line_id", F.lit(True).alias("_known"))
    rows = _rows(staged.join(known, "order_line_id", "left"), {
        "read": F.count(F.lit(1)), "inserted": F.count_if(F.col("_known").isNull()), "updated": F.count_if(F.col("_known"))})
    if not inferred:
        return rows
    return rows.unionByName(facts.inferred_members(report.details["stg_lines"], after.dim_customer).select(
        F.lit("inferred").alias("metric"), F.col("inferred").alias("n")))


def _marks(store: DataFrame, names: dict) -> DataFrame:
    """(label, watermark) of some streams, by one aggregate; the epoch for one that never ran."""
    epoch = F.lit(schemas.EPOCH.isoformat(" ")).cast(schemas.TS)
    each = [F.struct(F.lit(label).alias("label"), F.coalesce(F.max(F.when(F.col("stream") == s, F.col("watermark"))), epoch).alias("watermark"))
            for label, s in names.items()]
    return store.agg(F.array(*each).alias("rows")).select(F.explode("rows").alias("r")).select("r.label", "r.watermark")


# --- extraction and control ---------------------------------------------------

def q_extract_customer(spark, sf_dir):
    return present(_sc(spark, sf_dir).report2.details["stg_customer"])


def q_extract_product(spark, sf_dir):
    return present(_sc(spark, sf_dir).report2.details["stg_product"])


def q_extract_order_line(spark, sf_dir):
    return present(_sc(spark, sf_dir).report2.details["stg_lines"])


def q_high_water(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        high_water_frame(v.all()).select(F.lit(i).alias("source_version"), "high_water")
        for i, v in ((1, sc.v1), (2, sc.v2))])


def q_watermark_window(spark, sf_dir):
    """(case, low_water, high_water): cold start, warm start with the default
    lookback, warm start with zero lookback."""
    sc = _sc(spark, sf_dir)
    named = lambda df, name: df.select(F.lit(name).alias("label"), F.col(df.columns[-1]).alias("at"))
    moments = _union([named(_marks(sc.state1.etl_watermark, {"mark": schemas.SALES_STREAM}), "mark"),
                      named(high_water_frame(sc.v1.all()), "first"), named(high_water_frame(sc.v2.all()), "second")])
    at = {k: F.max(F.when(F.col("label") == k, F.col("at"))) for k in ("mark", "first", "second")}
    epoch = F.lit(schemas.EPOCH.isoformat(" ")).cast(schemas.TS)
    window = lambda case, low, high: F.struct(F.lit(case).alias("window_case"), low.alias("low_water"), high.alias("high_water"))
    return moments.agg(F.array(
        window("cold", control.low_water(epoch, schemas.DEFAULT_LOOKBACK), at["first"]),
        window("lookback_2d", control.low_water(at["mark"], schemas.DEFAULT_LOOKBACK), at["second"]),
        window("lookback_0", control.low_water(at["mark"], timedelta(0)), at["second"])).alias("w")).select(F.explode("w").alias("w")).select("w.*")


def q_watermark_get(spark, sf_dir):
    store = _sc(spark, sf_dir).state2.etl_watermark
    return _marks(store, {s: s for s in (schemas.SALES_STREAM, "inventory")}).withColumnRenamed("label", "stream")


def q_watermark_commit(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        st.etl_watermark.select(F.lit(i).alias("load_no"), "stream", "watermark")
        for i, st in ((1, sc.state1), (2, sc.state2))])


def q_watermark_reset(spark, sf_dir):
    store = _sc(spark, sf_dir).state2.etl_watermark
    steps = {"before": store, "reset_stream": control.reset(store, schemas.SALES_STREAM), "reset_all": control.reset(store)}
    return _union([_marks(df, {step: schemas.SALES_STREAM}) for step, df in steps.items()]).withColumnRenamed("label", "step")


def q_run_log(spark, sf_dir):
    log = reports.run_log_report(_sc(spark, sf_dir).state2.etl_run_log)
    return log.drop("run_id", "started_at")


def q_run_log_failed(spark, sf_dir):
    """The log of a load that the NOT NULL rules stop: some order lines have no quantity."""
    sc = _sc(spark, sf_dir)
    if "failed" not in sc.extra:
        broken = F.when(F.col("order_id").endswith("00"), F.lit(None)).otherwise(F.col("quantity")).cast("int")
        source = fixtures.SourceSnapshot(sc.v1.customer, sc.v1.product, sc.v1.order_line.withColumn("quantity", broken))
        wh = Warehouse(spark, scratch_path(spark, "failed"))
        try:
            run(spark, wh, source, run_ts=scenario.RUN1_TS, date_start=sc.date_start, date_end=sc.date_end, run_id="broken")
        except facts.FactNullError:
            sc.extra["failed"] = read_state(wh)
    st = sc.extra["failed"]
    return reports.run_log_report(st.etl_run_log).select("stream", "low_water", "high_water", "rows_read", "status")


#: (column of the load report, its source, its metric there).
_REPORT = [(f"{who}_{m}", who, m) for who in ("customer", "product") for m in ("inserted", "versioned", "updated", "unchanged")] + [
    ("facts_read", "facts", "read"), ("facts_inserted", "facts", "inserted"), ("facts_restated", "facts", "updated"),
    ("inferred_members", "facts", "inferred")]


def q_load_report(spark, sf_dir):
    """Both loads' reports, from their classified and staged rows and the published history."""
    sc = _sc(spark, sf_dir)
    none = scenario.empty_state(sc)
    out = []
    for load_no, report, before, after in ((1, sc.report1, none, sc.state1), (2, sc.report2, sc.state1, sc.state2)):
        parts = {"customer": _type2_stats(report), "product": _type1_stats(report), "facts": _fact_stats(report, before, after),
                 "history": checks.validate_history(after.dim_customer, "customer_id").withColumnRenamed("check", "metric")}
        long = _union([df.select(F.lit(who).alias("who"), "metric", "n", F.lit(None).cast(schemas.TS).alias("at")) for who, df in parts.items()])
        log = after.etl_run_log.where((F.col("run_id") == report.run_id) & (F.col("status") == schemas.STATUS_SUCCESS))
        long = long.unionByName(log.select(F.lit("log").alias("who"), F.lit("high_water").alias("metric"), F.lit(0).cast("long").alias("n"), F.col("high_water").alias("at")))
        pick = lambda who, metric: F.max(F.when((F.col("who") == who) & (F.col("metric") == metric), F.col("n")))
        problems = checks.problem_text(lambda check: pick("history", check))
        out.append(long.agg(F.max("at").alias("high_water"), *[pick(who, m).alias(name) for name, who, m in _REPORT],
                            problems.alias("history")).withColumn("load_no", F.lit(load_no)))
    return _union(out)


# --- dimensions -----------------------------------------------------------------

def q_dim_date(spark, sf_dir):
    return present(_sc(spark, sf_dir).state2.dim_date)


def q_unknown_member(spark, sf_dir):
    return present(_sc(spark, sf_dir).state1.dim_customer.where(F.col("sk") == schemas.UNKNOWN_SK))


def q_null_safe_diff(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    s = sc.report2.details["stg_customer"].alias("s")
    t = scd.current_versions(sc.state1.dim_customer).alias("t")
    j = s.join(t, F.col("s.customer_id") == F.col("t.customer_id"))
    return j.select(F.col("s.customer_id").alias("customer_id"),
                    null_safe_difference(schemas.CUSTOMER_ATTRIBUTES, "t", "s").alias("differs"))


def _classified(spark, sf_dir, kind):
    d = _sc(spark, sf_dir).report2.details
    return d["type2"].classified if kind == 2 else d["type1"].classified


def q_scd1_changed(spark, sf_dir):
    return _classified(spark, sf_dir, 1).where(F.col("action") == scd.CHANGED).select("product_id")


def q_scd1_new(spark, sf_dir):
    return _classified(spark, sf_dir, 1).where(F.col("action") == scd.NEW).select("product_id")


def q_scd1_stats(spark, sf_dir):
    return _type1_stats(_sc(spark, sf_dir).report2)


def q_scd1_load(spark, sf_dir):
    return present(_sc(spark, sf_dir).state2.dim_product.drop("updated_at"))


def q_scd2_current(spark, sf_dir):
    return present(scd.current_versions(_sc(spark, sf_dir).state2.dim_customer))


def q_scd2_changed(spark, sf_dir):
    return _classified(spark, sf_dir, 2).where(F.col("action") == scd.CHANGED).select("customer_id")


def q_scd2_new(spark, sf_dir):
    return _classified(spark, sf_dir, 2).where(F.col("action") == scd.NEW).select("customer_id")


def q_scd2_stats(spark, sf_dir):
    return _type2_stats(_sc(spark, sf_dir).report2)


def q_surrogate_keys(spark, sf_dir):
    return _sc(spark, sf_dir).state1.dim_customer.where(F.col("sk") != schemas.UNKNOWN_SK).select("customer_id", "sk")


def q_scd2_closed(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    closed = sc.state2.dim_customer.where(
        ~F.col("is_current") & (F.col("valid_to") == F.lit(sc.report2.high_water.isoformat(" ")).cast(schemas.TS)))
    return present(closed)


def q_scd2_opened(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    prior = sc.state1.dim_customer.select("sk")
    return present(sc.state2.dim_customer.join(prior, "sk", "left_anti"))


def q_scd2_load(spark, sf_dir):
    return present(_sc(spark, sf_dir).state2.dim_customer)


def q_scd2_wide_target(spark, sf_dir):
    """A Type 2 load into a target with a further column, null on the rows it opens."""
    sc = _sc(spark, sf_dir)
    if "wide" not in sc.extra:
        wide = sc.state1.dim_customer.withColumn("note", F.lit("kept"))
        sc.extra["wide"] = scd.load_type_2(wide, sc.report2.details["stg_customer"], "customer_id",
                                           schemas.CUSTOMER_ATTRIBUTES, effective_at=sc.report2.high_water)
    return present(sc.extra["wide"].dimension)


def q_dim_as_at(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    hw = sc.report2.high_water
    parts = [present(scd.as_at(sc.state2.dim_customer, m)).withColumn("moment", F.lit(label))
             for label, m in (("before_change", hw - timedelta(days=1)), ("after_change", hw + timedelta(days=1)))]
    return parts[0].unionByName(parts[1])


# --- facts ----------------------------------------------------------------------

def q_as_at_join(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    resolved = facts.as_at_join(sc.report2.details["stg_lines"], sc.state2.dim_customer)
    return resolved.select("order_line_id", "customer_sk")


def q_fact_stage(spark, sf_dir):
    return present(_sc(spark, sf_dir).report2.details["stg_fact"])


def q_inferred_members(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    return facts.inferred_members(sc.report1.details["stg_lines"], sc.state1.dim_customer)


def q_fact_stats(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    return _fact_stats(sc.report2, sc.state1, sc.state2)


def q_fact_load(spark, sf_dir):
    return present(_sc(spark, sf_dir).state2.fact_order_line.drop("loaded_at"))


def _reload(spark, sf_dir):
    """A third load on the unchanged v2 source (built once, on request)."""
    sc = _sc(spark, sf_dir)
    if "reload" not in sc.extra:
        sc.extra["reload"] = run(spark, sc.warehouse, sc.v2, run_ts=scenario.RUN3_TS,
                                 date_start=sc.date_start, date_end=sc.date_end, run_id="reload",
                                 keep_staging=True)
    return sc.extra["reload"]


def q_reload_stats(spark, sf_dir):
    """Idempotence: reloading an unchanged source re-reads the lookback window
    but inserts and versions nothing."""
    r = _reload(spark, sf_dir)
    named = lambda df, names: df.where(F.col("metric").isin(*names)).select(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("metric")].alias("metric"), "n")
    return _union([
        named(_type2_stats(r), {"inserted": "customers_inserted", "versioned": "customers_versioned", "unchanged": "customers_unchanged"}),
        named(_type1_stats(r), {"inserted": "products_inserted", "updated": "products_updated"}),
        named(_fact_stats(r, _sc(spark, sf_dir).state2, None, inferred=False), {"read": "facts_read", "inserted": "facts_inserted", "updated": "facts_restated"})])


def q_lookback_catches(spark, sf_dir):
    """Lines re-read only thanks to the lookback whose values changed since
    load 1 (the back-dated corrections a zero lookback would miss)."""
    sc = _sc(spark, sf_dir)
    low_zero, high = scenario.zero_lookback_window(sc)
    with_lookback = sc.report2.details["stg_lines"]
    zero = extract(sc.v2.order_line, low_zero, high, ["order_line_id"])
    only_lookback = with_lookback.join(zero, "order_line_id", "left_anti")
    before = sc.v1.order_line.select("order_line_id", F.col("quantity").alias("quantity_v1"))
    return (only_lookback.join(before, "order_line_id")
            .where(F.col("quantity") != F.col("quantity_v1"))
            .select("order_line_id", "quantity_v1", F.col("quantity").alias("quantity_v2")))


# --- validation and audits ------------------------------------------------------

def _defective(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    if "defective" not in sc.extra:
        sc.extra["defective"] = stage(fixtures.planted_defects(sc.state2.dim_customer), "defective_dim")
    return sc.extra["defective"]


def q_history_multi_current(spark, sf_dir):
    return checks.history_multi_current(_defective(spark, sf_dir), "customer_id")


def q_history_no_current(spark, sf_dir):
    return checks.history_no_current(_defective(spark, sf_dir), "customer_id")


def q_history_overlaps(spark, sf_dir):
    return checks.history_overlaps(_defective(spark, sf_dir), "customer_id")


def q_history_inverted(spark, sf_dir):
    return present(checks.history_inverted(_defective(spark, sf_dir)).select(
        "sk", "customer_id", "valid_from", "valid_to"))


def q_validate_history(spark, sf_dir):
    return checks.validate_history(_defective(spark, sf_dir), "customer_id")


def q_validate_history_clean(spark, sf_dir):
    return checks.validate_history(_sc(spark, sf_dir).state2.dim_customer, "customer_id")


def q_history_after_reload(spark, sf_dir):
    """A full validation of the dimension after a third load."""
    sc = _sc(spark, sf_dir)
    after = _reload(spark, sf_dir).details["manifest"]
    return checks.validate_history(read_state(sc.warehouse, after).dim_customer, "customer_id")


def q_audit_duplicates(spark, sf_dir):
    """Repeated keys of every published table and of every source."""
    sc = _sc(spark, sf_dir)
    tables = {f"{t}.{k}": (getattr(sc.state2, t), k) for t, (k,) in schemas.PRIMARY_KEYS.items()}
    tables |= {"src_customer.customer_id": (sc.v2.customer, "customer_id"),
               "src_product.product_id": (sc.v2.product, "product_id"),
               "src_order_line.order_line_id": (sc.v2.order_line, "order_line_id")}
    return reduce(DataFrame.unionByName, [checks.audit_duplicates(df, key, name) for name, (df, key) in tables.items()])


def q_audit_conditions(spark, sf_dir):
    """Conditional counts: successful loads, and products renamed in place."""
    st = _sc(spark, sf_dir).state2
    return reduce(DataFrame.unionByName, [
        df.agg(F.count_if(where).alias("n")).select(F.lit(name).alias("check"), "n") for name, df, where in (
            ("successful_loads", st.etl_run_log, F.col("status") == schemas.STATUS_SUCCESS),
            ("renamed_products", st.dim_product, F.col("product_name").like("%(v2)")))])


def q_audit_not_null(spark, sf_dir):
    st = _sc(spark, sf_dir).state2
    return reduce(DataFrame.unionByName, [
        checks.audit_not_null(st.dim_customer, schemas.NOT_NULL["dim_customer"], "dim_customer"),
        checks.audit_not_null(st.dim_date, schemas.NOT_NULL["dim_date"], "dim_date"),
        checks.audit_not_null(st.fact_order_line, schemas.NOT_NULL["fact_order_line"], "fact_order_line"),
    ])


def q_audit_orphans(spark, sf_dir):
    st = _sc(spark, sf_dir).state2
    return checks.audit_orphans(st.fact_order_line, st.dim_customer)


def q_audit_unknown(spark, sf_dir):
    return checks.audit_unknown(_sc(spark, sf_dir).state2.fact_order_line)


def q_audit_as_at(spark, sf_dir):
    sc = _sc(spark, sf_dir)
    return checks.audit_as_at(sc.state2.fact_order_line, sc.state2.dim_customer, sc.v2.order_line)


# --- reports --------------------------------------------------------------------

def q_table_counts(spark, sf_dir):
    st = _sc(spark, sf_dir).state2
    return reports.table_counts({"dim_customer": st.dim_customer, "dim_product": st.dim_product,
                                 "dim_date": st.dim_date, "fact_order_line": st.fact_order_line})


def q_customers_with_history(spark, sf_dir):
    return reports.customers_with_history(_sc(spark, sf_dir).state2.dim_customer)


def q_segment_revenue(spark, sf_dir):
    st = _sc(spark, sf_dir).state2
    return present(reports.segment_revenue(st.fact_order_line, st.dim_customer))


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
