"""Latency moments merged over days."""

import math
import random
import statistics
from datetime import datetime, timedelta

from logsieve.operators import enrich, latency_moments, merge_moments, read_moments, score_latency, update_moments
from tests.conftest import log_row, make_logs

T = datetime(2024, 5, 6, 8, 0, 0)


def rows_of(seed, days=3, n=400):
    rng = random.Random(seed)
    return [log_row(T + timedelta(days=rng.randrange(days)), service=rng.choice(["a", "b", None]),
                    rt=rng.choice([None, 1_000_000 + rng.randrange(50), rng.randrange(100)])) for _ in range(n)]


def test_three_merged_days_equal_one_pass(spark, tmp_dir):
    rows = rows_of(1) + [log_row(T, service="single", rt=5), log_row(T, service="flat", rt=7), log_row(T, service="flat", rt=7)]
    df = enrich(make_logs(spark, rows))
    for day in ("2024-05-06", "2024-05-07", "2024-05-07", "2024-05-08"):  # one day is run again
        update_moments(df.where(f"date = '{day}'"), f"{tmp_dir}/state")
    states = read_moments(spark, f"{tmp_dir}/state")
    by_service = {}
    for r in rows:
        if r[6] is not None:
            by_service.setdefault(r[2], []).append(r[6])
    got = {r.service: r for r in merge_moments(states, "service").collect()}
    assert set(got) == set(by_service)
    for s, x in by_service.items():
        assert got[s].n == len(x) and math.isclose(got[s]["mean"], statistics.fmean(x))
        assert math.isclose(got[s].m2, statistics.pvariance(x) * len(x), rel_tol=1e-9, abs_tol=1e-6)
    for r in score_latency(df, states).collect():
        x = by_service.get(r.service, [])
        if r.response_time_ms is None or len(x) < 2 or len(set(x)) == 1:
            assert r.latency_z is None
        else:
            assert math.isclose(r.latency_z, (r.response_time_ms - statistics.fmean(x)) / statistics.stdev(x), rel_tol=1e-9, abs_tol=1e-9)


def test_merging_in_any_grouping_is_the_same(spark):
    df = enrich(make_logs(spark, rows_of(2)))
    days = latency_moments(df)
    whole = {r.service: r for r in merge_moments(days, "service").collect()}
    halves = merge_moments(days.where("date < '2024-05-07'"), "service").unionByName(merge_moments(days.where("date >= '2024-05-07'"), "service"))
    for r in merge_moments(halves, "service").collect():
        assert r.n == whole[r.service].n and math.isclose(r.m2, whole[r.service].m2, rel_tol=1e-9)


def test_a_corrected_day_replaces_the_old_one(spark, tmp_dir):
    df = enrich(make_logs(spark, [log_row(T, rt=10), log_row(T, rt=20), log_row(T + timedelta(days=1), rt=90)]))
    update_moments(df, f"{tmp_dir}/state")
    update_moments(enrich(make_logs(spark, [log_row(T, rt=50)])), f"{tmp_dir}/state")
    (r,) = merge_moments(read_moments(spark, f"{tmp_dir}/state"), "service").collect()
    assert (r.n, r["mean"], r.m2) == (2, 70.0, 800.0)


def test_large_latencies_lose_nothing(spark):
    """Sums of squares would cancel: 2,000,000,000 and a few milliseconds more."""
    x = [2_000_000_000 + k for k in range(5)]
    rows = [log_row(T + timedelta(days=k % 2), rt=v) for k, v in enumerate(x)]
    (r,) = merge_moments(latency_moments(enrich(make_logs(spark, rows))), "service").collect()
    assert math.isclose(r.m2, 10.0, rel_tol=1e-6)
