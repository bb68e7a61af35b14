import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logsieve.operators import (
    build_anomaly_report,
    detect_brute_force,
    detect_error_spikes,
    detect_high_latency,
    detect_null_user_ids,
    drop_invalid,
    enrich,
)
from logsieve.sources import read_logs, write_logs_csv
from tests.conftest import SAMPLE_ROWS, assert_high_latency, log_row, make_logs

T0 = datetime(2024, 1, 15, 9, 0, 0)


def _outlier_logs(spark):
    # 11 ordinary rows and one far outlier: the least a service needs for a
    # 3-sigma flag with the sample standard deviation.
    rows = [log_row(T0 + timedelta(seconds=i), service="busy", rt=100) for i in range(11)]
    rows.append(log_row(T0 + timedelta(seconds=11), service="busy", rt=100_000))
    rows.append(log_row(T0, service="single", rt=99_999))
    return make_logs(spark, rows)


class TestHighLatency:
    def test_adds_column(self, sample_df):
        df = detect_high_latency(enrich(sample_df))
        assert df.columns[-1] == "is_high_latency"
        assert len(df.columns) == len(enrich(sample_df).columns) + 1

    def test_sample_has_no_3_sigma_outlier(self, sample_df):
        # With n <= 4 per service the largest possible z is (n-1)/sqrt(n) = 1.5.
        assert detect_high_latency(enrich(sample_df)).filter("is_high_latency").count() == 0

    def test_flags_outlier_and_single_row_service_is_null(self, spark):
        df = detect_high_latency(enrich(_outlier_logs(spark)))
        got = {(r.service, r.response_time_ms): r.is_high_latency for r in df.collect()}
        assert got[("busy", 100_000)] is True
        assert got[("busy", 100)] is False
        assert got[("single", 99_999)] is None

    def test_against_plain_python(self, spark, sample_df):
        for df in (enrich(sample_df), enrich(_outlier_logs(spark))):
            for multiplier in (0.5, 3.0):
                assert_high_latency(detect_high_latency(df, multiplier), multiplier)

    def test_growing_folder_and_nothing_cached(self, spark, tmp_dir):
        src, cached = os.path.join(tmp_dir, "logs"), spark.sparkContext._jsc.getPersistentRDDs().size()
        write_logs_csv(_outlier_logs(spark), src + "/day1")
        logs = lambda: enrich(drop_invalid(read_logs(spark, [src + "/*"])))
        flagged = lambda: sorted(
            r.response_time_ms for r in detect_high_latency(logs()).filter("is_high_latency").collect()
        )
        assert flagged() == [100_000]
        # Day 2 is as slow throughout, so that day 1's outlier is ordinary.
        more = [log_row(T0 + timedelta(days=1, seconds=i), service="busy", rt=100_000) for i in range(40)]
        write_logs_csv(make_logs(spark, more), src + "/day2")
        assert flagged() == []
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached

    def test_shuffle_join_fallback_gives_same_rows(self, spark):
        df = enrich(_outlier_logs(spark))
        a = detect_high_latency(df, max_broadcast_rows=0)
        b = detect_high_latency(df)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    def test_null_service_keeps_rows(self, spark):
        rows = [log_row(T0, service=None), log_row(T0, service=None, rt=300)]
        assert detect_high_latency(enrich(make_logs(spark, rows))).count() == 2


def test_null_users_are_whole_rows(sample_df):
    assert [tuple(r) for r in detect_null_user_ids(sample_df).orderBy("timestamp").collect()] == [
        SAMPLE_ROWS[2], SAMPLE_ROWS[3],
    ]


class TestErrorSpikes:
    def test_threshold_is_inclusive_on_rounded_pct(self, spark):
        w = datetime(2024, 1, 15, 9, 0, 0)
        rows = []
        # a: 1 error of 10 = 10.0 % -> spike. b: 1 of 11 = 9.09 % -> none.
        rows += [log_row(w, service="a", status=500)] + [log_row(w, service="a")] * 9
        rows += [log_row(w, service="b", status=500)] + [log_row(w, service="b")] * 10
        # c: 200 errors of 2001 = 9.995 % -> rounds to 10.0, compared after rounding.
        rows += [log_row(w, service="c", status=500)] * 200 + [log_row(w, service="c")] * 1801
        got = {r.service: r for r in detect_error_spikes(enrich(make_logs(spark, rows))).collect()}
        assert set(got) == {"a", "c"}
        assert got["a"].error_rate_pct == 10.0 and got["a"].is_error_spike is True
        assert got["c"].error_rate_pct == 10.0

    def test_windows_are_epoch_aligned_5_minutes(self, spark):
        rows = [
            log_row(datetime(2024, 1, 15, 9, 4, 59), status=500),
            log_row(datetime(2024, 1, 15, 9, 5, 0), status=500),
        ]
        got = detect_error_spikes(enrich(make_logs(spark, rows))).select("window.start", "window.end", "total").collect()
        assert [(r.start.minute, r.end.minute, r.total) for r in got] == [(0, 5, 1), (5, 10, 1)]

    def test_ordered_by_rate_desc(self, sample_df):
        got = [r.error_rate_pct for r in detect_error_spikes(enrich(sample_df)).collect()]
        assert got == sorted(got, reverse=True) and got == [100.0, 50.0]  # cart, billing


class TestBruteForce:
    def _rows(self, ip, total, failures, code=401):
        return [log_row(T0, ip=ip, status=code)] * failures + [log_row(T0, ip=ip)] * (total - failures)

    def test_boundaries(self, spark):
        rows = []
        rows += self._rows("1.1.1.1", 50, 40)  # exactly 50 and 0.8 -> flagged
        rows += self._rows("2.2.2.2", 49, 49)  # too few requests
        rows += self._rows("3.3.3.3", 2000, 1599, code=403)  # 0.7995 rounds to 0.8 -> flagged
        rows += self._rows("4.4.4.4", 100, 79)  # 0.79 -> not flagged
        got = {r.ip_address: r for r in detect_brute_force(enrich(make_logs(spark, rows))).collect()}
        assert set(got) == {"1.1.1.1", "3.3.3.3"}
        assert got["3.3.3.3"].fail_rate == 0.8 and got["3.3.3.3"].auth_failures == 1599
        assert got["1.1.1.1"].anomaly_type == "BRUTE_FORCE"

    def test_order_by_failures_desc(self, spark):
        rows = self._rows("1.1.1.1", 60, 60) + self._rows("2.2.2.2", 90, 90)
        got = [r.ip_address for r in detect_brute_force(enrich(make_logs(spark, rows))).collect()]
        assert got == ["2.2.2.2", "1.1.1.1"]

    def test_sample_has_none(self, sample_df):
        assert detect_brute_force(enrich(sample_df)).count() == 0


class TestReport:
    def test_sample_report(self, sample_df):
        rows = build_anomaly_report(enrich(sample_df)).collect()
        assert [r.anomaly_flags for r in rows] == [
            "ERROR,,SLOW,NULL_USER_ID", "ERROR,,SLOW,", ",,,NULL_USER_ID", ",,SLOW,", "ERROR,,,",
        ]
        assert [r.anomaly_count for r in rows] == [3, 2, 1, 1, 1]
        assert [(r.service, r.status_code) for r in rows] == [
            ("billing", 500), ("billing", 503), ("billing", 404), ("mail", 200), ("cart", 500),
        ]
        assert rows[0].__fields__ == [
            "timestamp", "service", "endpoint", "ip_address", "status_code",
            "response_time_ms", "anomaly_flags", "anomaly_count",
        ]

    def test_compact_flags(self, sample_df):
        rows = build_anomaly_report(enrich(sample_df), compact=True).collect()
        assert [r.anomaly_flags for r in rows] == ["ERROR,SLOW,NULL_USER_ID", "ERROR,SLOW", "NULL_USER_ID", "SLOW", "ERROR"]

    def test_high_latency_flag_in_report(self, spark):
        rows = build_anomaly_report(enrich(_outlier_logs(spark)), ordered=False).collect()
        assert sorted(r.anomaly_flags for r in rows) == [",,SLOW,", ",HIGH_LATENCY,SLOW,"]

    def test_count_matches_split_of_flags(self, sample_df):
        df = build_anomaly_report(enrich(sample_df))
        check = df.filter(F.size(F.array_remove(F.split("anomaly_flags", ","), "")) != F.col("anomaly_count"))
        assert check.count() == 0


def test_byte_bound_also_forces_shuffle_join(spark):
    from logsieve.operators.joins import attach_small
    from tests.conftest import explain

    big = spark.range(100).withColumn("k", (F.col("id") % 3).cast("string"))
    small = spark.range(3).select(F.col("id").cast("string").alias("k2"), F.lit("x" * 1000).alias("payload"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        within = attach_small(big, small, F.col("k") == F.col("k2"))
        over = attach_small(big, small, F.col("k") == F.col("k2"), max_broadcast_bytes=2000)
        assert "BroadcastHashJoin" in explain(within)
        assert "BroadcastHashJoin" not in explain(over)
        assert over.count() == within.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
