"""The as-at sweep: many versions of one key, gaps, nulls, range partitions, and the join it replaces."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import END_OF_TIME
from tidemark import schemas, session
from tidemark.operators import facts
from tidemark.operators.sweep import as_at_sweep, overlapping_keys

DIM = "sk bigint, customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz"
LINE = "line int, customer_id string, order_ts timestamp_ntz, sk string"
DAY0 = datetime(2000, 1, 1)


def resolved(lines, dim):
    return sorted((r["line"], r["customer_sk"]) for r in facts.as_at_join(lines, dim).collect())


def plain(lines, dim):
    out = []
    for line, key, ts, _ in lines:
        hits = [sk for sk, k, lo, hi in dim if None not in (key, ts, lo, hi) and k == key and lo <= ts < hi]
        out += [(line, sk) for sk in hits] or [(line, schemas.UNKNOWN_SK)]
    return sorted(out)


@pytest.mark.parametrize("seed,rows_per_block", [(0, 10**6), (1, 40), (2, 7)])
def test_sweep_equals_the_definition(spark, monkeypatch, seed, rows_per_block):
    monkeypatch.setattr(session, "ROWS_PER_RANGE_PARTITION", rows_per_block)
    monkeypatch.setattr(facts, "SWEEP_VERSIONS", 4)
    rng = random.Random(seed)
    dim, lines = [], []
    for key, n in (("deep", 60), ("gaps", 30), ("few", 3), ("one", 1), ("clash", 12)):
        at = DAY0
        for _ in range(n):
            width = timedelta(hours=rng.randint(0, 5))  # some windows are empty
            dim.append((len(dim), key, at, at + width))
            at += width + (timedelta(hours=rng.randint(0, 4)) if key == "gaps" else timedelta(0)) - (timedelta(hours=1) if key == "clash" else timedelta(0))
    dim += [(900, "deep", None, END_OF_TIME), (901, "gaps", datetime(1999, 1, 1), datetime(1998, 1, 1)), (902, None, DAY0, END_OF_TIME)]
    for i in range(400):
        key = rng.choice(["deep", "deep", "gaps", "few", "one", "clash", "absent", None])
        lines.append((i, key, None if i % 50 == 0 else DAY0 + timedelta(hours=rng.randint(-5, 160), minutes=rng.choice([0, 0, 30])), "clash"))
    lines += [(1000 + i, "deep", DAY0, "same") for i in range(60)]  # one key and instant
    assert resolved(spark.createDataFrame(lines, LINE), spark.createDataFrame(dim, DIM)) == plain(lines, dim)


def test_one_key_with_ten_thousand_versions(spark, monkeypatch):
    """Each fact meets one version: nothing in the plan makes more rows than events, and gaps stay -1."""
    monkeypatch.setattr(session, "ROWS_PER_RANGE_PARTITION", 20_000)
    hours = lambda c: F.timestamp_add("HOUR", c, F.lit(DAY0.isoformat(" ")).cast("timestamp_ntz"))
    dim = spark.range(10_000).select("id", F.lit("hot").alias("customer_id"), hours(F.col("id").cast("int") * 2).alias("valid_from"),
                                     hours(F.col("id").cast("int") * 2 + 1).alias("valid_to")).withColumnRenamed("id", "sk")
    lines = spark.range(100_000).select(F.col("id").alias("line"), F.lit("hot").alias("customer_id"),
                                        hours((F.col("id") % 20_000).cast("int")).alias("order_ts"))
    out = session.stage(facts.as_at_join(lines, dim))
    assert out.count() == 100_000
    hour = F.col("line") % 20_000
    expected = F.when(hour % 2 == 0, (hour / 2).cast("long")).otherwise(F.lit(-1))
    assert out.where(F.col("customer_sk") != expected).count() == 0
    plan = as_at_sweep(lines, dim, "customer_id", "customer_id", "order_ts")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and plan.count("BroadcastHashJoin") <= 1


def test_overlapping_keys(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_RANGE_PARTITION", 2)
    day = lambda n: DAY0 + timedelta(days=n)
    dim = spark.createDataFrame([(1, "a", day(0), day(9)), (2, "a", day(3), day(3)), (3, "a", day(9), day(12)), (4, "b", day(0), day(5)),
                                 (5, "b", day(4), day(6)), (6, "c", day(0), day(5)), (7, "c", day(0), day(5)), (8, "d", day(5), day(1))], DIM)
    assert sorted(r[0] for r in overlapping_keys(dim, "customer_id").collect()) == ["b", "c"]
