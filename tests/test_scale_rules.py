"""Rules that keep a load's cost down: key filters, one scan per source, overlaps by ranks, lazy reports."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import DIM_SCHEMA, END_OF_TIME, SMALL_SF
from tidemark import schemas, session
from tidemark.functions.expressions import null_safe_difference, quote_identifier
from tidemark.operators import checks, extract, facts, joins
from tidemark.plans import scenario
from tidemark.plans.queries import QUERIES
from tidemark.sources import fixtures

DAY0 = datetime(2000, 1, 1)


def test_rows_with_keys_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") % 5000).alias("k"), "id").unionAll(
        spark.createDataFrame([(None, -1), ("", -2)], "k string, id bigint"))
    keys = spark.range(0, 6000, 3).select(F.concat(F.lit("k"), "id").alias("key")).unionAll(spark.createDataFrame([(None,), ("",)], "key string"))
    expected = sorted(r["id"] for r in rows.join(keys, F.col("k") == F.col("key"), "left_semi").collect())
    assert sorted(r["id"] for r in joins.rows_with_keys(rows, "k", session.stage(keys), "key").collect()) == expected
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 10)
    for bits in (1 << 27, 64):  # a filter as small as one row lets more through, the result is the same
        monkeypatch.setattr(joins, "FILTER_BITS", bits)
        assert sorted(r["id"] for r in joins.rows_with_keys(rows, "k", session.stage(keys), "key").collect()) == expected


def test_the_filter_comes_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 10)
    dim = session.stage(spark.range(50_000).select(F.col("id").cast("string").alias("customer_id")))
    keys = session.stage(spark.range(100).select(F.col("id").cast("string").alias("customer_id")))
    marked = dim.withColumn("_slot", F.pmod(F.xxhash64("customer_id"), F.lit(joins.FILTER_BITS)))
    bits = joins.key_filter(keys, "customer_id")
    passed = marked.join(bits, (F.shiftright("_slot", 6) == F.col("_word")) & (F.getbit("_bits", F.col("_slot").bitwiseAND(F.lit(63)).cast("int")) == 1), "left_semi")
    assert 100 <= passed.count() < 200 and bits.count() <= 100
    plan = joins.rows_with_keys(dim, "customer_id", keys)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "getbit" in plan


def test_a_window_is_one_scan_and_closes_at_what_it_read(spark):
    ts = lambda d: DAY0 + timedelta(days=d)
    a = spark.createDataFrame([("x", ts(1)), ("y", ts(5)), ("z", None)], "k string, updated_at timestamp_ntz")
    b = spark.createDataFrame([("p", ts(3))], "k string, updated_at timestamp_ntz")
    (sa, sb), high = extract.staged_window([a, b], ts(2), ts(2), ts(99))
    assert high == ts(5) and [r["k"] for r in sa.collect()] == ["y"] and sb.count() == 1
    (sa, sb), high = extract.staged_window([a, b], ts(6), ts(6), ts(99))  # idle: the window stays at the mark
    assert high == ts(6) and sa.isEmpty() and sb.isEmpty()
    assert extract.staged_window([a.limit(0), b.limit(0)], schemas.EPOCH, schemas.EPOCH, ts(99))[1] == ts(99)


def test_fifty_thousand_inverted_rows_of_one_key(spark):
    """Row i spans [i, i + 1] backwards: it touches its two neighbours and itself."""
    n = 50_000
    hours = lambda c: F.timestamp_add("HOUR", c.cast("int"), F.lit(DAY0.isoformat(" ")).cast("timestamp_ntz"))
    dim = spark.range(n).select(F.col("id").alias("sk"), F.lit("hot").alias("customer_id"), F.lit("n").alias("customer_name"), F.lit("s").alias("segment"),
                                F.lit("c").alias("country"), hours(F.col("id") + 1).alias("valid_from"), hours(F.col("id")).alias("valid_to"), F.lit(False).alias("is_current"))
    live = spark.createDataFrame([(n, "hot", "n", "s", "c", datetime(1900, 1, 1), END_OF_TIME, True)], DIM_SCHEMA)
    began = time.time()
    got = checks.history_overlaps(dim.unionByName(live), "customer_id").collect()
    # By the definition a.from < b.to and b.from < a.to: each inverted row overlaps the live one, both ways.
    assert [(r["customer_id"], r["overlapping_pairs"]) for r in got] == [("hot", 2 * n)]
    assert time.time() - began < 60


def test_names_with_quotes_and_backticks(spark):
    name = 'a"b`c d'
    assert quote_identifier(name) == '`a"b``c d`'
    left = spark.createDataFrame([(1, "x"), (2, None)], ["id", name])
    right = spark.createDataFrame([(1, "x"), (2, "y")], ["id", name])
    joined = left.alias("l").join(right.alias("r"), F.col("l.id") == F.col("r.id"))
    got = joined.select(F.col("l.id"), null_safe_difference([name], "l", "r").alias("d")).collect()
    assert sorted(map(tuple, got)) == [(1, False), (2, True)]
    assert spark.sql(f"SELECT {quote_identifier(name)} AS v FROM {{df}}", df=left).count() == 2


def test_lines_are_shuffled_once_and_written_once(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 10)
    with session.staging() as written:
        lines = fixtures.lines(spark, SMALL_SF)
    assert not written  # no table between the numbering and the join
    lineitem, orders = (spark.read.parquet(f"{SMALL_SF}/{t}.parquet") for t in ("lineitem", "orders"))
    assert lines.count() == lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).count()
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1 and "Exchange hashpartitioning(l_orderkey#, l_linenumber" not in plan
    even = sorted(map(tuple, lines.collect()))
    monkeypatch.setattr(joins, "HOT_MIN_ROWS", 8)  # some orders count as hot: the other plan, the same rows
    hot = fixtures.lines(spark, SMALL_SF)
    assert sorted(map(tuple, hot.select(*lines.columns).collect())) == even


def test_a_load_writes_its_facts_once_and_sources_share_their_lines(spark):
    sc = scenario.get(spark, SMALL_SF)
    assert sorted(sc.v1.order_line.inputFiles()) == sorted(sc.v2.order_line.inputFiles())
    staged, fact = sc.report1.details["stg_fact"], sc.state1.fact_order_line
    assert sorted(staged.inputFiles()) == sorted(fact.inputFiles()) and staged.count() == fact.count()


def test_nothing_is_shuffled_for_an_empty_table(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 10)
    empty = session.with_known_rows(spark.createDataFrame([], "k string"), 0)
    plan = joins.rows_with_keys(empty, "k", session.stage(spark.range(100).select(F.col("id").cast("string").alias("k"))))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString() and plan.columns == ["k"]


@pytest.mark.parametrize("name", ["scd1_stats", "scd2_stats", "fact_stats", "reload_stats", "load_report", "watermark_get", "watermark_window",
                                  "watermark_reset", "validate_history", "validate_history_clean"])
def test_reports_are_planned_from_tables(spark, name):
    plan = QUERIES[name](spark, SMALL_SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "LocalRelation" not in plan.replace("LocalRelation <empty>", "")
