"""Type 2 rules by group: what a staged row does to its key, windows, keys, defects."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import ATTRS, BEGINNING_OF_TIME, DIM_SCHEMA, END_OF_TIME, T1, T2, T3, empty_dim, load, stg
from tidemark.operators import checks, scd

MID = datetime(2026, 2, 11)


def history(spark, *loads):
    """The dimension and stats after loads given as (moment, rows)."""
    dim, stats = empty_dim(spark), None
    for at, rows in loads:
        dim, stats = load(spark, dim, rows, at)
    return dim, stats


def planted(spark, *rows):
    return spark.createDataFrame(rows, DIM_SCHEMA)


# before, after -> (inserted, versioned, unchanged)
@pytest.mark.parametrize("before, after, outcome", [
    (None, ("Nil", "Gold", "PE"), (1, 0, 0)),
    (("Nil", "Gold", "PE"), ("Nil", "Gold", "PE"), (0, 0, 1)),
    (("Nil", "Gold", "PE"), ("Nil", "Iron", "PE"), (0, 1, 0)),
    (("Nil", "Gold", "PE"), ("Nil", "Gold", None), (0, 1, 0)),
    (("Nil", None, "PE"), ("Nil", "Gold", "PE"), (0, 1, 0)),
    (("Nil", None, None), ("Nil", None, None), (0, 0, 1)),
    (("Nil", "", "PE"), ("Nil", None, "PE"), (0, 1, 0)),
])
def test_outcome_of_one_staged_row(spark, before, after, outcome):
    earlier = [(T1, [("K", *before)])] if before else []
    dim, stats = history(spark, *earlier, (T2, [("K", *after)]))
    assert (stats.inserted, stats.versioned, stats.unchanged) == outcome
    assert dim.count() == len(earlier) + outcome[0] + outcome[1]
    live = dim.where("is_current").collect()
    assert [tuple(r[a] for a in ATTRS) for r in live] == [after]
    assert live[0]["valid_from"] == (T2 if outcome[1] else BEGINNING_OF_TIME) and live[0]["valid_to"] == END_OF_TIME


def test_windows_tile_time(spark):
    loads = [(at, [("K", "Nil", level, "PE"), ("L", "Lil", "Same", "PE")]) for at, level in ((T1, "Tin"), (T2, "Gold"), (T3, "Iron"))]
    dim, _ = history(spark, *loads)
    mine = dim.where("customer_id = 'K'").orderBy("valid_from").collect()
    assert [r["valid_from"] for r in mine] == [BEGINNING_OF_TIME, T2, T3]
    assert [r["valid_to"] for r in mine] == [T2, T3, END_OF_TIME]
    assert [r["is_current"] for r in mine] == [False, False, True]
    for moment, level in ((datetime(1950, 6, 1), "Tin"), (T2, "Gold"), (MID, "Gold"), (T3, "Iron"), (datetime(2040, 1, 1), "Iron")):
        assert [r["segment"] for r in scd.as_at(dim, moment).where("customer_id = 'K'").collect()] == [level]
    assert checks.history_problems(dim, "customer_id") == []


def test_surrogate_keys_follow_new_then_changed_in_key_order(spark):
    dim, _ = history(spark, (T1, [("m", "1", "a", "PE"), ("d", "2", "a", "PE")]))
    assert {r["customer_id"]: r["sk"] for r in dim.collect()} == {"d": 1, "m": 2}
    dim, _ = load(spark, dim, [("m", "1", "b", "PE"), ("d", "2", "b", "PE"), ("z", "3", "a", "PE"), ("b", "4", "a", "PE")], T2)
    assert {r["customer_id"]: r["sk"] for r in dim.where("is_current").collect()} == {"b": 3, "z": 4, "d": 5, "m": 6}
    assert dim.select("sk").distinct().count() == dim.count()
    unknown = scd.unknown_member(spark).select(*empty_dim(spark).columns)
    dim, _ = load(spark, unknown, [("d", "2", "a", "PE")], T1)
    assert dim.where("customer_id = 'd'").collect()[0]["sk"] == 0


@pytest.mark.parametrize("rows", [[("d", "1", "a", "PE"), ("d", "2", "a", "PE")], [("d", "1", "a", "PE")] * 2, [(None, "1", "a", "PE")]])
def test_staged_keys_must_be_a_key(spark, rows):
    with pytest.raises(scd.StagingKeyError):
        load(spark, empty_dim(spark), rows, T1)


DEFECTS = {
    "more than one current version": [(1, "K", "n", "s", "c", T1, END_OF_TIME, True), (2, "K", "n", "t", "c", T2, T3, True)],
    "no current version": [(1, "K", "n", "s", "c", T1, T2, False)],
    "2 overlapping": [(1, "K", "n", "s", "c", T1, T3, False), (2, "K", "n", "t", "c", T2, END_OF_TIME, True)],
    "1 row(s) with valid_to on or before valid_from": [(1, "K", "n", "s", "c", T2, T2, False), (2, "K", "n", "t", "c", T2, END_OF_TIME, True)],
}


@pytest.mark.parametrize("message", DEFECTS)
def test_defects_are_named(spark, message):
    assert any(message in p for p in checks.history_problems(planted(spark, *DEFECTS[message]), "customer_id"))


def test_loads_into_defective_histories(spark):
    closed = planted(spark, *DEFECTS["no current version"])
    after, stats = load(spark, closed, [("K", "n", "other", "c")], T3)
    assert (stats.inserted, stats.versioned, stats.no_current, after.count()) == (0, 0, 1, 1)
    double = planted(spark, *DEFECTS["more than one current version"])
    after, stats = load(spark, double, [("K", "n", "s", "c")], T3)
    assert stats.versioned == 1 and after.where("is_current").count() == 1 and after.count() == 3
    # A second change at one mark closes a version where it opened.
    dim, _ = history(spark, *[(at, [("K", "n", level, "c")]) for at, level in ((T1, "x"), (T2, "y"), (T2, "z"))])
    assert checks.history_problems(dim, "customer_id") == ["1 row(s) with valid_to on or before valid_from"]


def test_further_columns_of_a_target_stay(spark):
    dim, _ = history(spark, (T1, [("K", "n", "s", "c"), ("L", "n", "s", "c")]))
    wide = dim.withColumn("owner", F.lit("ops"))
    result = scd.load_type_2(wide, stg(spark, [("K", "n", "t", "c"), ("M", "n", "s", "c")]), "customer_id", ATTRS, effective_at=T2)
    got = {(r["customer_id"], r["segment"]): r["owner"] for r in result.dimension.collect()}
    assert got == {("K", "s"): "ops", ("K", "t"): None, ("L", "s"): "ops", ("M", "s"): None}
    assert {r["owner"] for r in result.closed.collect()} == {"ops"} and result.opened.count() == 2
    flat = spark.createDataFrame([("K", "n", T1, "ops")], "id string, name string, updated_at timestamp_ntz, owner string")
    new = spark.createDataFrame([("K", "m"), ("L", "n")], "id string, name string")
    out = scd.load_type_1(flat, new, "id", ["name"], loaded_at=T2).dimension
    assert sorted(map(tuple, out.collect())) == [("K", "m", T2, "ops"), ("L", "n", T2, None)]


def test_classification_never_sorts_to_aggregate(spark):
    dim, _ = history(spark, (T1, [("K", "n", "s", "c")]))
    for plan in (scd.classify_type2(dim, stg(spark, [("K", "n", "t", "c")]), "customer_id", ATTRS),
                 scd.classify_type1(dim, stg(spark, [("K", "n", "t", "c")]), "customer_id", ATTRS)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in text and "HashAggregate" in text
