"""Operator tests: edges of the behaviour contract and brute-force checks of
the distributed algorithms (overlap counting, dense keys, skew splitting)."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import DIM_SCHEMA, END_OF_TIME
from tidemark import schemas
from tidemark.functions.expressions import net_amount
from tidemark.operators import checks, dates, extract, facts, joins, keys, scd


def test_net_amount_rounds_once(spark):
    df = spark.createDataFrame([(7, Decimal("1.0358"), Decimal("0.0002"))],
                               "q int, p decimal(18,4), d decimal(9,4)")
    naive = df.select((F.col("q") * F.col("p") * (1 - F.col("d"))).cast("decimal(18,4)").alias("x")).first()[0]
    once = df.select(net_amount(F.col("q"), F.col("p"), F.col("d")).alias("x")).first()[0]
    assert once == Decimal("7.2491")
    assert naive == Decimal("7.2492")  # the double rounding the cast order avoids


def _random_dim(seed, keys=6, rows=40):
    rnd = random.Random(seed)
    out = []
    for sk in range(rows):
        a, b = rnd.randint(0, 12), rnd.randint(0, 12)
        if rnd.random() < 0.7:
            a, b = min(a, b), max(a, b)
        base = datetime(2020, 1, 1)
        out.append((sk, f"K{rnd.randint(0, keys - 1)}", "n", "s", "c", base + timedelta(days=a),
                    base + timedelta(days=b), rnd.random() < 0.5))
    return out


def _brute_overlaps(rows):
    per = {}
    for a in rows:
        for b in rows:
            if a[1] == b[1] and a[0] != b[0] and a[5] < b[6] and b[5] < a[6]:
                per[a[1]] = per.get(a[1], 0) + 1
    return per


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("parts", [1, 3])
def test_overlap_count_matches_the_pairwise_definition(spark, seed, parts):
    rows = _random_dim(seed)
    dim = spark.createDataFrame(rows, DIM_SCHEMA)
    expected = _brute_overlaps(rows)
    got = {r[0]: r[1] for r in checks.history_overlaps(dim, "customer_id", num_partitions=parts).collect()}
    assert got == expected
    assert checks.history_overlap_total(dim, "customer_id", num_partitions=parts) == sum(expected.values())


def test_overlap_count_with_one_hot_key_spanning_partitions(spark):
    rows = [(i, "HOT", "n", "s", "c", datetime(2020, 1, 1) + timedelta(days=i),
             datetime(2020, 1, 1) + timedelta(days=i + 3), False) for i in range(60)]
    dim = spark.createDataFrame(rows, DIM_SCHEMA)
    expected = _brute_overlaps(rows)["HOT"]
    assert checks.history_overlap_total(dim, "customer_id", num_partitions=7) == expected
    got = checks.history_overlaps(dim, "customer_id", num_partitions=7).collect()
    assert [(r[0], r[1]) for r in got] == [("HOT", expected)]


@pytest.mark.parametrize("parts", [1, 8])
def test_dense_keys_match_a_global_row_number(spark, parts):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), f"k{rnd.randint(0, 10**6):07d}-{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "grp int, k string")
    out = keys.assign_dense_keys(df, ["grp", "k"], 41, "sk", num_partitions=parts)
    got = {(r["grp"], r["k"]): r["sk"] for r in out.collect()}
    expected = {key: 42 + i for i, key in enumerate(sorted(rows))}
    assert got == expected


def _join_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_skew_safe_join_equals_a_plain_join(spark, monkeypatch, how):
    monkeypatch.setattr(joins, "HOT_MIN_ROWS", 10)
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"c{i}", i % 7) for i in range(300)],
                                 "id int, k string, t int")
    right = spark.createDataFrame([("hot", 0, 3), ("hot", 3, 9), ("c3", 0, 9), ("zz", 0, 1)],
                                  "rk string, lo int, hi int")

    def res():
        return (F.col("t") >= F.col("lo")) & (F.col("t") < F.col("hi"))

    plain = left.join(right, (F.col("k") == F.col("rk")) & res(), how)
    hot = joins.hot_keys(left, ["k"])
    assert hot is not None and [r[0] for r in hot.collect()] == ["hot"]
    # broadcast_rows=0 forces the split path; 1 forces salting of the hot part
    for bound in (0, 1):
        split = joins.skew_safe_join(left, right, ["k"], ["rk"], how, residual=res, broadcast_rows=bound)
        assert _join_rows(split) == _join_rows(plain)


def test_type1_overwrites_inserts_and_keeps_equal_rows(spark):
    target = spark.createDataFrame(
        [("P1", "a", "x", Decimal("1.0000"), datetime(2020, 1, 1)),
         ("P2", None, "y", Decimal("2.0000"), datetime(2020, 1, 1))], schemas.DIM_PRODUCT)
    staging = spark.createDataFrame(
        [("P1", "a", "x", Decimal("1.0000")), ("P2", "b", "y", Decimal("2.0000")),
         ("P3", "c", "z", None)], "product_id string, product_name string, category string, unit_cost decimal(18,4)")
    res = scd.load_type_1(target, staging, "product_id", schemas.PRODUCT_ATTRIBUTES, loaded_at=datetime(2026, 1, 1))
    assert (res.stats.updated, res.stats.inserted, res.stats.unchanged) == (1, 1, 0)
    rows = {r["product_id"]: r for r in res.dimension.collect()}
    assert rows["P1"]["updated_at"] == datetime(2020, 1, 1)      # untouched
    assert rows["P2"]["product_name"] == "b" and rows["P2"]["updated_at"] == datetime(2026, 1, 1)
    assert rows["P3"]["unit_cost"] is None and len(rows) == 3


def test_type1_rejects_duplicate_staged_keys(spark):
    target = spark.createDataFrame([], schemas.DIM_PRODUCT)
    staging = spark.createDataFrame([("P1", "a", "x", None), ("P1", "b", "x", None)],
                                    "product_id string, product_name string, category string, unit_cost decimal(18,4)")
    with pytest.raises(scd.StagingKeyError):
        scd.load_type_1(target, staging, "product_id", schemas.PRODUCT_ATTRIBUTES, loaded_at=datetime(2026, 1, 1))


def test_as_at_join_uses_unknown_for_gaps_but_counts_only_absent_keys_as_inferred(spark):
    dim = spark.createDataFrame([
        (1, "C1", "n", "s", "c", datetime(1900, 1, 1), datetime(2020, 1, 1), False),
        (2, "C1", "n", "t", "c", datetime(2021, 1, 1), END_OF_TIME, True)], DIM_SCHEMA)
    lines = spark.createDataFrame([
        ("L1", "C1", datetime(2019, 6, 1)), ("L2", "C1", datetime(2020, 6, 1)),
        ("L3", "C1", datetime(2021, 1, 1)), ("L4", "C9", datetime(2021, 1, 1))],
        "order_line_id string, customer_id string, order_ts timestamp_ntz")
    got = {r[0]: r[1] for r in facts.as_at_join(lines, dim).select("order_line_id", "customer_sk").collect()}
    assert got == {"L1": 1, "L2": -1, "L3": 2, "L4": -1}
    assert facts.inferred_members(lines, dim).first()[0] == 1


def test_fact_merge_is_delete_then_insert_and_idempotent(spark):
    fact = spark.createDataFrame([("A", 1), ("B", 2)], "order_line_id string, quantity int") \
        .withColumn("loaded_at", F.lit("2020-01-01").cast("timestamp_ntz"))
    stg = spark.createDataFrame([("B", 5), ("C", 1)], "order_line_id string, quantity int")
    once = facts.merge_facts(fact, stg, datetime(2026, 1, 1))
    twice = facts.merge_facts(once, stg, datetime(2026, 1, 1))
    assert sorted((r[0], r[1]) for r in once.collect()) == [("A", 1), ("B", 5), ("C", 1)]
    assert sorted(once.collect()) == sorted(twice.collect())


def test_extract_window_is_open_below_and_closed_above(spark):
    t = [datetime(2026, 1, d) for d in (1, 2, 3)]
    src = spark.createDataFrame([(i, ts) for i, ts in enumerate(t)], "id int, updated_at timestamp_ntz")
    ids = sorted(r[0] for r in extract.extract(src, t[0], t[2]).collect())
    assert ids == [1, 2]


def test_extract_pushes_the_window_into_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.createDataFrame([(1, datetime(2026, 1, 1), "x")], "id int, updated_at timestamp_ntz, v string") \
        .write.parquet(path)
    df = extract.extract(spark.read.parquet(path), datetime(2025, 1, 1), datetime(2026, 6, 1), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "updated_at" in plan.split("PushedFilters")[1][:300]
    assert "ReadSchema: struct<id:int,updated_at:timestamp_ntz>" in plan


def test_high_water_is_the_greatest_mark_or_the_run_time_when_empty(spark):
    a = spark.createDataFrame([(datetime(2026, 1, 1),)], "updated_at timestamp_ntz")
    b = spark.createDataFrame([(datetime(2026, 2, 1),)], "updated_at timestamp_ntz")
    empty = spark.createDataFrame([], "updated_at timestamp_ntz")
    assert extract.high_water([a, b, empty], datetime(2030, 1, 1)) == datetime(2026, 2, 1)
    assert extract.high_water([empty], datetime(2030, 1, 1)) == datetime(2030, 1, 1)


def test_calendar_includes_both_ends_and_iso_weekdays(spark):
    cal = dates.calendar(spark, "2026-11-30", "2026-12-06")
    rows = {r["full_date"]: r for r in cal.collect()}
    assert len(rows) == 7
    thu = rows[date(2026, 12, 3)]
    assert (thu["date_key"], thu["day_of_week"], thu["day_name"], thu["is_weekend"]) == (20261203, 4, "Thursday", False)
    assert rows[date(2026, 12, 6)]["day_of_week"] == 7 and rows[date(2026, 12, 6)]["is_weekend"] is True
    assert thu["month_name"] == "December" and thu["quarter"] == 4


def test_date_dimension_adds_only_missing_days(spark):
    first = dates.build_dim_date(spark.createDataFrame([], schemas.DIM_DATE), "2026-01-01", "2026-01-10")
    again = dates.build_dim_date(first, "2026-01-05", "2026-01-15")
    assert again.count() == 15
    assert checks.audit_duplicates(again, "date_key").first()["n"] == 0


def test_unknown_member_is_seeded_once(spark):
    dim = scd.seed_unknown_member(spark.createDataFrame([], schemas.DIM_CUSTOMER))
    again = scd.seed_unknown_member(dim)
    row = again.collect()
    assert len(row) == 1 and row[0]["sk"] == -1 and row[0]["customer_id"] == "UNKNOWN"
    assert row[0]["segment"] == "Unknown" and row[0]["valid_to"] == END_OF_TIME


def test_dense_key_plan_has_no_single_partition_window(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    out = keys.assign_dense_keys(df, ["k"], 0, "sk", num_partitions=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_overlapping_versions_fan_out_the_as_at_join_and_are_caught(spark):
    dim = spark.createDataFrame([
        (1, "C1", "n", "s", "c", datetime(1900, 1, 1), END_OF_TIME, True),
        (2, "C1", "n", "t", "c", datetime(2000, 1, 1), END_OF_TIME, True)], DIM_SCHEMA)
    lines = spark.createDataFrame(
        [("L1", "O1", datetime(2001, 1, 1), "C1", "P1", 1, Decimal("1.0000"), Decimal("0.0000"), datetime(2001, 1, 1))],
        schemas.SRC_ORDER_LINE)
    staged = facts.stage_facts(lines, dim)
    assert staged.count() == 2 and facts.duplicate_keys(staged) == 1


def test_small_staged_side_prefilters_a_large_right_before_joining(spark):
    from tidemark.session import stage
    left = stage(spark.createDataFrame([(1, "a", 2), (2, "b", 5), (3, "zz", 1)], "id int, k string, t int"))
    right = spark.createDataFrame([(f"k{i}", 0, 9) for i in range(20)] + [("a", 0, 3), ("b", 6, 9)],
                                  "rk string, lo int, hi int")

    def res():
        return (F.col("t") >= F.col("lo")) & (F.col("t") < F.col("hi"))

    plain = left.join(right, (F.col("k") == F.col("rk")) & res(), "left")
    got = joins.skew_safe_join(left, right, ["k"], ["rk"], "left", residual=res, broadcast_rows=5)
    assert _join_rows(got) == _join_rows(plain)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed,parts", [(4, None), (5, 4)])
def test_per_group_validation_counts_add_up_to_the_pairwise_definition(spark, seed, parts):
    rows = _random_dim(seed, keys=9, rows=60)
    dim = spark.createDataFrame(rows, DIM_SCHEMA)
    per_key = _brute_overlaps(rows)

    def group_of(key):
        return F.substring(key, 2, 1).cast("int") % 3

    got = checks.validation_counts_by(dim, "customer_id", group_of, num_partitions=parts)
    expected = {}
    for k, n in per_key.items():
        g = int(k[1:]) % 3
        expected[g] = expected.get(g, 0) + n
    assert {g: c["overlapping_pairs"] for g, c in got.items() if c["overlapping_pairs"]} == expected
    totals = {r["check"]: r["n"] for r in checks.validate_history(dim, "customer_id").collect()}
    for check in totals:
        assert sum(c[check] for c in got.values()) == totals[check]


def test_latest_per_key_keeps_the_newest_row_of_each_key(spark):
    df = spark.createDataFrame([
        ("C1", "old", datetime(2026, 1, 1)), ("C1", "new", datetime(2026, 1, 3)),
        ("C2", "only", datetime(2026, 1, 2)), ("C1", "mid", datetime(2026, 1, 2))],
        "customer_id string, customer_name string, updated_at timestamp_ntz")
    out = {r["customer_id"]: r["customer_name"] for r in scd.latest_per_key(df, "customer_id").collect()}
    assert out == {"C1": "new", "C2": "only"}
    assert scd.latest_per_key(df, "customer_id").columns == df.columns


def test_wide_attributes_are_not_broadcast(spark, monkeypatch):
    from tidemark import session
    from tidemark.operators import scd
    target = spark.createDataFrame([(f"P{i}", "x" * 400, datetime(2020, 1, 1)) for i in range(60)],
                                   "id string, name string, updated_at timestamp_ntz")
    staging = spark.createDataFrame([(f"P{i}", "y" * 400) for i in range(0, 90, 2)], "id string, name string")
    plain = _join_rows(scd.load_type_1(target, staging, "id", ["name"], loaded_at=datetime(2020, 2, 1)).dimension)
    monkeypatch.setattr(session, "BROADCAST_MAX_BYTES", 10)
    wide = scd.load_type_1(target, staging, "id", ["name"], loaded_at=datetime(2020, 2, 1))
    assert not session.fits_broadcast(wide.classified)
    assert _join_rows(wide.dimension) == plain


@pytest.mark.parametrize("name", ['a "quoted" name', 'doubled ""quote', "back`tick", "two``ticks", "with.dot", "`"])
def test_odd_names_are_quoted(spark, name):
    from tidemark.functions.expressions import null_safe_difference, quote_identifier

    left = spark.createDataFrame([(1, "a"), (2, None), (3, None)], ["k", "v"]).withColumnRenamed("v", name)
    right = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], ["k", "v"]).withColumnRenamed("v", name)
    assert left.selectExpr(f"{quote_identifier(name)} AS v").columns == ["v"]
    both = left.alias("l").join(right.alias("r"), "k")
    assert sorted((r.k, r.differs) for r in both.select("k", null_safe_difference([name], "l", "r").alias("differs")).collect()) == [(1, True), (2, True), (3, False)]
