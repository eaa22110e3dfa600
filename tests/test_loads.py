"""End to end: loads over the given tables (sf0.001) through the publishing layer."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_SF
from tidemark import schemas
from tidemark.operators import checks, reports
from tidemark.operators.facts import FactNullError
from tidemark.plans import scenario
from tidemark.plans.publish import ConcurrentLoadError, Warehouse
from tidemark.plans.run import read_state, run
from tidemark.plans.setup import initialise
from tidemark.session import scratch_path
from tidemark.sources import fixtures
from tidemark.sources.fixtures import SourceSnapshot


@pytest.fixture(scope="module")
def sc(spark):
    return scenario.get(spark, SMALL_SF)


@pytest.fixture(scope="module")
def reloaded(spark, sc):
    """A third run on the unchanged v2 source: idempotence."""
    before = read_state(sc.warehouse, sc.manifest2)
    report = run(spark, sc.warehouse, sc.v2, run_ts=datetime(2026, 1, 3), date_start=sc.date_start,
                 date_end=sc.date_end, run_id="load3", keep_staging=True)
    return before, report, read_state(sc.warehouse, report.details["manifest"])


def test_load_one_holds_all_of_its_source(sc):
    r = sc.report1
    assert r.dim_customer.inserted == sc.v1.customer.count()
    assert r.dim_product.inserted == sc.v1.product.count()
    assert r.facts_inserted == r.facts_read == sc.v1.order_line.count()
    assert sc.state1.fact_order_line.count() == r.facts_read


def test_third_load_of_the_same_source_is_a_no_op(reloaded):
    before, report, after = reloaded
    assert report.dim_customer.inserted == 0 and report.dim_customer.versioned == 0
    assert report.facts_inserted == 0 and report.facts_read == report.facts_updated
    assert after.dim_customer.count() == before.dim_customer.count()
    cols = [c for c in before.fact_order_line.columns if c != "loaded_at"]
    assert before.fact_order_line.select(cols).exceptAll(after.fact_order_line.select(cols)).count() == 0
    assert after.fact_order_line.select(cols).exceptAll(before.fact_order_line.select(cols)).count() == 0


def test_line_ids_are_a_key_of_source_and_fact(sc):
    for table in (sc.v2.order_line, sc.state2.fact_order_line):
        assert checks.audit_duplicates(table, "order_line_id").collect()[0]["n"] == 0


def test_customer_counts_add_up_to_the_changed_rows(sc):
    stats = sc.report2.dim_customer
    assert stats.versioned > 0
    changed = sc.v2.customer.where(F.col("updated_at") > F.lit("2001-01-01").cast("timestamp_ntz")).count()
    assert stats.versioned + stats.unchanged + stats.inserted == changed


def test_products_have_one_row_each_with_the_new_name(sc):
    stats = sc.report2.dim_product
    renamed = sc.v2.product.where(F.col("product_name").like("%(v2)")).count()
    late = sc.v2.product.join(sc.v1.product, "product_id", "left_anti")
    assert stats.inserted == late.count() > 0
    assert stats.updated == renamed - late.where(F.col("product_name").like("%(v2)")).count()
    dim = sc.state2.dim_product
    assert dim.count() == sc.v2.product.count()
    assert dim.where(F.col("product_name").like("%(v2)")).count() == renamed


def test_every_row_of_lineitem_is_in_the_fact(sc):
    assert sc.report2.facts_updated > 0
    assert sc.state2.fact_order_line.count() == sc.v2.order_line.count()
    assert sc.v2.order_line.count() == sc.spark.read.parquet(f"{SMALL_SF}/lineitem.parquet").count()


def test_fact_quantities_equal_the_last_snapshot(sc):
    src = sc.v2.order_line.select("order_line_id", F.col("quantity").alias("src_qty"))
    fact = sc.state2.fact_order_line.join(src, "order_line_id")
    assert fact.where(F.col("quantity") != F.col("src_qty")).count() == 0


def test_without_lookback_some_quantities_are_stale(spark, sc):
    wh = Warehouse(spark, scratch_path(spark, "strict"))
    run(spark, wh, sc.v1, lookback=timedelta(0), run_ts=datetime(2026, 1, 1), date_start=sc.date_start,
        date_end=sc.date_end)
    run(spark, wh, sc.v2, lookback=timedelta(0), run_ts=datetime(2026, 1, 2), date_start=sc.date_start,
        date_end=sc.date_end)
    src = sc.v2.order_line.select("order_line_id", F.col("quantity").alias("src_qty"))
    fact = read_state(wh).fact_order_line.join(src, "order_line_id")
    assert fact.where(F.col("quantity") != F.col("src_qty")).count() > 0


def test_as_at_keys_of_staged_and_kept_facts(sc):
    """Every fact resolved in a load points at the version live at its order
    time. Facts are kept as booked: a load-1 fact whose customer is versioned
    later, effective before the order time, keeps its old key unless re-read."""
    stg = sc.report2.details["stg_fact"].withColumn("loaded_at", F.lit(None).cast("timestamp_ntz"))
    assert checks.audit_as_at(stg, sc.state2.dim_customer, sc.v2.order_line).collect()[0]["n"] == 0
    n = checks.audit_as_at(sc.state2.fact_order_line, sc.state2.dim_customer, sc.v2.order_line).collect()[0]["n"]
    hw2 = F.lit(sc.report2.high_water.isoformat(" ")).cast("timestamp_ntz")
    changed = sc.report2.details["type2"].classified.where(F.col("action") == "changed").select("customer_id")
    kept = sc.state1.fact_order_line.join(sc.report2.details["stg_fact"].select("order_line_id"),
                                          "order_line_id", "left_anti")
    expected = (kept.join(sc.v1.order_line.select("order_line_id", "customer_id", "order_ts"), "order_line_id")
                .join(changed, "customer_id").where(F.col("order_ts") >= hw2).count())
    assert n == expected


def test_customer_keys_of_facts_exist(sc):
    assert checks.audit_orphans(sc.state2.fact_order_line, sc.state2.dim_customer).collect()[0]["n"] == 0


def test_histories_are_clean(sc):
    assert sc.report1.history_problems == [] and sc.report2.history_problems == []
    assert checks.history_problems(sc.state2.dim_customer, "customer_id") == []


def test_log_has_two_successes(sc):
    log = sc.state2.etl_run_log
    assert log.where(F.col("status") == "SUCCESS").count() == 2


def test_facts_of_known_customers_resolve_to_a_real_member(sc):
    """Customers present at load 1 open at the beginning of time, so none of
    their facts lands on Unknown; only customers absent from the dimension do
    (they are the inferred members, counted)."""
    fact = sc.state1.fact_order_line
    unknown = fact.where(F.col("customer_sk") == schemas.UNKNOWN_SK).count()
    assert unknown == sc.report1.inferred_members
    known = sc.v1.customer.select("customer_id")
    lines = sc.v1.order_line.join(known, "customer_id").select("order_line_id")
    assert fact.join(lines, "order_line_id").where(F.col("customer_sk") == schemas.UNKNOWN_SK).count() == 0


def test_inferred_members_are_counted_and_not_re_resolved_unless_re_read(sc):
    assert sc.report1.inferred_members > 0
    assert sc.state2.fact_order_line.where(F.col("customer_sk") == -1).count() == sc.report1.inferred_members


def test_revenue_covers_the_segments(sc):
    rows = reports.segment_revenue(sc.state2.fact_order_line, sc.state2.dim_customer).collect()
    segments = {r["segment"] for r in rows}
    assert len(segments - {"Unknown"}) >= 4


def test_date_dimension_covers_the_calendar(sc):
    dd = sc.state2.dim_date
    assert dd.count() == (sc.date_end - sc.date_start).days + 1
    jan1 = dd.where(F.col("date_key") == int(sc.date_start.strftime("%Y%m%d"))).collect()[0]
    assert jan1["month_name"] == "January" and jan1["quarter"] == 1
    assert jan1["day_of_week"] == sc.date_start.isoweekday()
    assert jan1["day_name"] == sc.date_start.strftime("%A")
    assert jan1["is_weekend"] == (sc.date_start.isoweekday() >= 6)


def without_quantities(source):
    """The snapshot with the quantity of some order lines lost."""
    lost = F.when(F.col("order_id").endswith("7"), F.lit(None)).otherwise(F.col("quantity")).cast("int")
    return SourceSnapshot(source.customer, source.product, source.order_line.withColumn("quantity", lost))


def test_null_facts_stop_the_load_and_a_retry_succeeds(spark, sc):
    wh = Warehouse(spark, scratch_path(spark, "failing"))
    days = {"date_start": sc.date_start, "date_end": sc.date_end}
    run(spark, wh, sc.v1, run_ts=datetime(2026, 1, 1), **days)
    before = read_state(wh)
    n = before.dim_customer.count()
    with pytest.raises(FactNullError, match="quantity"):
        run(spark, wh, without_quantities(sc.v2), run_ts=datetime(2026, 1, 2), **days)
    after = read_state(wh)
    assert after.dim_customer.count() == n
    assert after.etl_watermark.collect()[0]["watermark"] == sc.report1.high_water
    statuses = sorted(r["status"] for r in after.etl_run_log.collect())
    assert statuses[0].startswith("FAILED: NULL in staged facts") and statuses[1:] == ["SUCCESS"]
    retry = run(spark, wh, sc.v2, run_ts=datetime(2026, 1, 2), **days)
    assert (retry.facts_read, retry.facts_updated) == (sc.report2.facts_read, sc.report2.facts_updated)


def test_a_validation_error_stops_the_load_and_nothing_stale_is_carried_on(spark, sc, monkeypatch):
    wh = Warehouse(spark, scratch_path(spark, "unvalidated"))
    days = {"date_start": sc.date_start, "date_end": sc.date_end}
    run(spark, wh, sc.v1, run_ts=datetime(2026, 1, 1), **days)

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(checks, "validation_counts_by", broken)
        with pytest.raises(OSError, match="no space"):
            run(spark, wh, sc.v2, run_ts=datetime(2026, 1, 2), **days)
    assert run(spark, wh, sc.v2, run_ts=datetime(2026, 1, 3), **days).history_problems == []
    assert checks.history_problems(read_state(wh).dim_customer, "customer_id") == []


def test_folders_of_a_dead_load_are_never_read_and_a_stale_base_is_refused(spark, sc):
    wh = Warehouse(spark, scratch_path(spark, "dead-load"))
    first = initialise(wh)
    wh.append(first, "dim_customer", sc.state1.dim_customer, "dead")  # written, never committed
    assert wh.manifest() == first and read_state(wh).dim_customer.count() == 1
    done = wh.commit(first, "next")
    assert done.seq == first.seq + 1 and wh.manifest().seq == done.seq
    with pytest.raises(ConcurrentLoadError):
        wh.commit(first, "late")


def test_keys_longer_than_the_padding_stay_whole(spark, tmp_path):
    for t in ("customer", "nation", "part", "orders", "lineitem"):
        df = spark.read.parquet(f"{SMALL_SF}/{t}.parquet").limit(300 if t != "nation" else 25)
        for c in ("c_custkey", "p_partkey", "o_custkey", "l_partkey"):
            if c in df.columns:
                df = df.withColumn(c, F.col(c) + 1_234_567_890_000)
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    for version in (1, 2):
        for df, key in ((fixtures.src_customer(spark, str(tmp_path), version), "customer_id"), (fixtures.src_product(spark, str(tmp_path), version), "product_id")):
            ids = [r[0] for r in df.select(key).collect()]
            assert ids and len(set(ids)) == len(ids) and {len(i) for i in ids} == {5 + 13}


def test_second_load_writes_only_what_changes(sc):
    r, m1, m2 = sc.report2, sc.manifest1, sc.manifest2
    c, p = r.dim_customer, r.dim_product
    assert r.appended == {"dim_customer": c.inserted + 2 * c.versioned, "dim_product": p.inserted + p.updated,
                          "fact_order_line": r.facts_read}
    gone = {t: m2.written(f"{t}-gone") - m1.written(f"{t}-gone") for t in r.appended}
    assert gone == {"dim_customer": c.versioned, "dim_product": p.updated, "fact_order_line": r.facts_updated}
    assert all(set(m1.runs[t]) < set(m2.runs[t]) for t in r.appended)  # runs are added, none rewritten
    for t in ("dim_customer", "dim_product", "fact_order_line", "dim_date"):
        assert m2.live(t) == sc.warehouse.read(t, m2).count()


def test_compaction_keeps_the_rows(spark, sc):
    for table in ("dim_customer", "dim_product", "fact_order_line"):
        before = sc.warehouse.read(table, sc.manifest2)
        packed = sc.warehouse.compact(sc.manifest2, table, "compact")
        after = sc.warehouse.read(table, packed)
        assert len(packed.runs[table]) == 1 and packed.written(f"{table}-gone") == 0 and packed.live(table) == before.count()
        assert before.exceptAll(after).count() == after.exceptAll(before).count() == 0


def test_a_load_compacts_when_superseded_rows_abound(spark, sc, monkeypatch):
    from tidemark.plans import run as module
    monkeypatch.setattr(module, "COMPACT_SHARE", 0.0)
    wh = Warehouse(spark, scratch_path(spark, "compacting"))
    for src, ts in ((sc.v1, datetime(2026, 1, 1)), (sc.v2, datetime(2026, 1, 2))):
        last = run(spark, wh, src, run_ts=ts, date_start=sc.date_start, date_end=sc.date_end).details["manifest"]
    assert {len(last.runs[t]) for t in ("dim_customer", "dim_product", "fact_order_line")} == {1}
    cols = [c for c in sc.state2.fact_order_line.columns if c != "loaded_at"]
    assert read_state(wh).fact_order_line.select(cols).exceptAll(sc.state2.fact_order_line.select(cols)).count() == 0
    assert read_state(wh).dim_customer.exceptAll(sc.state2.dim_customer).count() == 0


def test_tables_not_loaded_yet_are_empty_frames_of_their_schema(spark):
    state = read_state(Warehouse(spark, scratch_path(spark, "nothing")))
    assert state.fact_order_line.dtypes == schemas.empty(spark, schemas.FACT_ORDER_LINE).dtypes
    assert all(df.isEmpty() for df in vars(state).values())


def test_initialise_is_idempotent_and_seeds_the_unknown_member(spark):
    wh = Warehouse(spark, scratch_path(spark, "init"))
    first = initialise(wh)
    second = initialise(wh)
    assert second == first
    dim = read_state(wh).dim_customer.collect()
    assert [(r["sk"], r["customer_id"]) for r in dim] == [(-1, "UNKNOWN")]
    assert read_state(wh).fact_order_line.count() == 0


def test_surrogate_keys_do_not_depend_on_shuffle_partitions(spark, sc):
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        wh = Warehouse(spark, scratch_path(spark, "one-partition"))
        for src, ts in ((sc.v1, datetime(2026, 1, 1)), (sc.v2, datetime(2026, 1, 2))):
            run(spark, wh, src, run_ts=ts, date_start=sc.date_start, date_end=sc.date_end)
        single = read_state(wh).dim_customer
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    cols = ["sk", "customer_id", "segment", "valid_from", "valid_to", "is_current"]
    assert single.select(cols).exceptAll(sc.state2.dim_customer.select(cols)).count() == 0
    assert sc.state2.dim_customer.select(cols).exceptAll(single.select(cols)).count() == 0


def test_incremental_validation_matches_a_full_validation(spark, sc):
    """A back-dated edit arriving with an unchanged high-water mark closes the
    version opened at that mark at the same instant (an empty window); the
    per-bucket validation of the touched buckets must report it like a full
    pass does."""
    wh = Warehouse(spark, scratch_path(spark, "revalidate"))
    for src, ts in ((sc.v1, datetime(2026, 1, 1)), (sc.v2, datetime(2026, 1, 2))):
        run(spark, wh, src, run_ts=ts, date_start=sc.date_start, date_end=sc.date_end)
    victim = (sc.report2.details["type2"].classified.where(F.col("action") == "changed")
              .orderBy("customer_id").first()["customer_id"])
    edited = sc.v2.customer.withColumn(
        "segment", F.when(F.col("customer_id") == victim, F.lit("EDITED")).otherwise(F.col("segment"))).withColumn(
        "updated_at", F.when(F.col("customer_id") == victim, F.lit(sc.report2.high_water.isoformat(" ")).cast("timestamp_ntz"))
        .otherwise(F.col("updated_at")))
    third = run(spark, wh, SourceSnapshot(edited, sc.v2.product, sc.v2.order_line), run_ts=datetime(2026, 1, 3),
                date_start=sc.date_start, date_end=sc.date_end)
    assert third.details["manifest"].seq > 0
    full = checks.history_problems(read_state(wh).dim_customer, "customer_id")
    assert third.history_problems == full == ["1 row(s) with valid_to on or before valid_from"]


def test_a_run_removes_its_staging_unless_asked_to_keep_it(spark, sc, monkeypatch):
    from tidemark.plans import run as module
    from tidemark.session import path_exists, stage, staging
    created = []
    plain = module.delete_paths
    monkeypatch.setattr(module, "delete_paths", lambda s, paths: (created.extend(paths), plain(s, paths)))
    wh = Warehouse(spark, scratch_path(spark, "tidy"))
    with staging() as outer:
        other = stage(spark.range(3), "someone_elses")
        run(spark, wh, sc.v1, run_ts=datetime(2026, 1, 1), date_start=sc.date_start, date_end=sc.date_end)
        assert len(outer) == 1 and other.count() == 3
    assert created and not any(path_exists(spark, p) for p in created)
    assert read_state(wh).fact_order_line.count() == sc.report1.facts_read
