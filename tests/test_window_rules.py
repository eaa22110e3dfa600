"""The extract window, the marks it moves, and the run log, as scenarios of runs."""

from datetime import datetime, timedelta

import pytest

from tidemark import schemas
from tidemark.operators import control

MON, TUE, WED = (datetime(2024, 5, d, 6, 30) for d in (6, 7, 8))
NONE, HOUR, WEEK = timedelta(0), timedelta(hours=1), timedelta(days=7)


def play(spark, runs):
    """Runs as (stream, high, lookback, error or None); returns store, log and contexts."""
    store, log, seen = control.empty_watermarks(spark), control.empty_run_log(spark), []
    for stream, high, lookback, error in runs:
        ctx, log = control.begin(store, log, stream, high, lookback=lookback)
        seen.append(ctx)
        if error is None:
            store, log = control.commit(store, log, ctx, rows_read=7, rows_inserted=4, rows_updated=3)
        else:
            log = control.fail(log, ctx, error)
    return store, log, seen


@pytest.mark.parametrize("runs, low, marks", [
    # the low end of the last run, and the marks after it
    ([("a", MON, WEEK, None)], schemas.EPOCH, {"a": MON}),
    ([("a", MON, NONE, None), ("a", TUE, NONE, None)], MON, {"a": TUE}),
    ([("a", MON, NONE, None), ("a", TUE, HOUR, None)], MON - HOUR, {"a": TUE}),
    ([("a", MON, NONE, None), ("a", WED, WEEK, None)], MON - WEEK, {"a": WED}),
    ([("a", MON, NONE, None), ("a", TUE, HOUR, "lost"), ("a", WED, HOUR, None)], MON - HOUR, {"a": WED}),
    ([("a", MON, NONE, "lost"), ("a", TUE, HOUR, None)], schemas.EPOCH, {"a": TUE}),
    ([("a", TUE, NONE, None), ("b", MON, HOUR, None)], schemas.EPOCH, {"a": TUE, "b": MON}),
    ([("a", TUE, NONE, None), ("a", MON, HOUR, None)], TUE - HOUR, {"a": MON}),  # nothing guards against going back
    ([("a", MON, NONE, None), ("a", TUE, NONE, "lost")], MON, {"a": MON}),
])
def test_window_and_marks(spark, runs, low, marks):
    store, log, seen = play(spark, runs)
    assert (seen[-1].low_water, seen[-1].high_water) == (low, runs[-1][1])
    assert {s: control.get_watermark(store, s) for s in marks} == marks
    assert control.get_watermark(store, "never ran") == schemas.EPOCH
    assert log.count() == len(runs) and len({c.run_id for c in seen}) == len(runs)


def test_log_rows(spark):
    _, log, (ok, bad) = play(spark, [("a", MON, NONE, None), ("a", TUE, HOUR, "out of " + "disk" * 99)])
    rows = {r["run_id"]: r for r in log.collect()}
    assert all(len(i) == 12 and int(i, 16) >= 0 for i in rows)
    won, lost = rows[ok.run_id], rows[bad.run_id]
    assert (won["status"], won["rows_read"], won["rows_inserted"], won["rows_updated"]) == ("SUCCESS", 7, 4, 3)
    assert (won["low_water"], won["high_water"]) == (schemas.EPOCH, MON)
    assert lost["status"].startswith("FAILED: out of disk") and len(lost["status"]) == 200
    assert lost["rows_read"] is None and lost["finished_at"] is not None


def test_forgetting_marks(spark):
    store, _, _ = play(spark, [("a", MON, NONE, None), ("b", TUE, NONE, None)])
    one = control.reset(store, "a")
    assert control.get_watermark(one, "a") == schemas.EPOCH and control.get_watermark(one, "b") == TUE
    assert control.reset(store).count() == 0 and control.reset(store, "").count() == 2
