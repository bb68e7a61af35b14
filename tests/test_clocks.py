"""Broken clocks: bounds from hour counts."""

from datetime import datetime, timedelta

from logsieve.operators import clock_bounds, detect_broken_clocks, hour_histogram, merge_histograms
from tests.conftest import explain, log_row, make_logs

T = datetime(2024, 5, 6, 0, 0, 0)
H = int((T - datetime(1970, 1, 1)).total_seconds()) // 3600
LOG = [log_row(T + timedelta(minutes=10 * k)) for k in range(6 * 24 * 3)]


def test_rows_of_1970_and_of_the_future_are_named(spark):
    bad = [log_row(datetime(1970, 1, 1, 0, 0, 5)), log_row(datetime(1971, 1, 1)), log_row(T + timedelta(days=4000))]
    got = detect_broken_clocks(make_logs(spark, [*LOG, *bad, log_row(None)])).orderBy("timestamp").collect()
    assert [r.timestamp for r in got] == [b[0] for b in bad]
    assert [r.broken_bound for r in got] == ["before", "before", "after"]
    assert got[0].bound == T and got[2].bound == T + timedelta(days=3, seconds=-1)


def test_a_log_without_outliers_has_no_bounds(spark):
    df = make_logs(spark, LOG)
    assert clock_bounds(hour_histogram(df)) == clock_bounds(hour_histogram(make_logs(spark, [])))
    assert detect_broken_clocks(df).count() == 0
    assert detect_broken_clocks(make_logs(spark, [])).count() == 0


def test_a_long_quiet_tail_stays(spark):
    """Rows ever rarer, hour by hour, run on without a gap wider than the one to the broken rows."""
    tail = [log_row(T - timedelta(hours=5 * k)) for k in range(1, 60)]
    bad = log_row(datetime(1970, 1, 1))
    got = detect_broken_clocks(make_logs(spark, [*LOG, *tail, bad])).collect()
    assert [r.timestamp for r in got] == [bad[0]]


def test_histograms_of_parts_add_up(spark):
    df = make_logs(spark, [*LOG, log_row(datetime(1970, 1, 1))])
    parts = [hour_histogram(df.where(c)) for c in ("timestamp < '2024-05-07'", "timestamp >= '2024-05-07'")]
    merged = merge_histograms(*parts)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, hour_histogram(df).collect()))
    assert clock_bounds(merged).low == H and clock_bounds(merged).high is None


def test_no_window_over_rows(spark):
    df = make_logs(spark, [*LOG, log_row(datetime(1970, 1, 1))])
    plan = explain(detect_broken_clocks(df))
    assert "Window" not in plan and "Exchange" not in plan and "Join" not in plan
