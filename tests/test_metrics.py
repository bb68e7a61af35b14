from datetime import date, datetime, timedelta

from logsieve.operators import (
    aggregate_by_hour,
    aggregate_by_service,
    aggregate_status_distribution,
    enrich,
    ip_traffic_summary,
    top_slow_endpoints,
)
from tests.conftest import log_row, make_logs


class TestByService:
    def test_exact_rows(self, sample_df):
        day = date(2024, 3, 10)
        got = aggregate_by_service(enrich(sample_df))
        assert [tuple(r) for r in got.collect()] == [
            # latencies 60, 150, 2600, 5200: ranks 2, 4 and 4
            ("billing", day, 4, 2, 50.0, 150, 5200, 5200, 1180),
            ("cart", day, 1, 1, 100.0, 110, 110, 110, 55),
            ("mail", day, 1, 0, 0.0, 2400, 2400, 2400, 1500),
            ("search", day, 2, 0, 0.0, 30, 45, 45, 4020),
        ]
        assert got.columns[2:] == [
            "total_requests", "error_count", "error_rate_pct", "p50_ms", "p95_ms", "p99_ms", "total_bytes_sent",
        ]

    def test_ordered_by_date_then_service(self, spark):
        d = datetime(2024, 1, 1)
        rows = [log_row(d + timedelta(days=i % 2), service=s) for i, s in enumerate(["b", "a", "c", "a"])]
        got = [(r.date.day, r.service) for r in aggregate_by_service(enrich(make_logs(spark, rows))).collect()]
        assert got == sorted(got)

    def test_error_pct_rounding_half_up(self, spark):
        # 1 error in 8 requests = 12.5 %; 2 in 3 = 66.67 % (rounded half-up).
        t = datetime(2024, 1, 1)
        rows = [log_row(t, service="a", status=500)] + [log_row(t, service="a")] * 7
        rows += [log_row(t, service="b", status=500)] * 2 + [log_row(t, service="b")]
        got = {r.service: r.error_rate_pct for r in aggregate_by_service(enrich(make_logs(spark, rows))).collect()}
        assert got == {"a": 12.5, "b": 66.67}


class TestOtherAggregates:
    def test_by_hour(self, sample_df):
        rows = aggregate_by_hour(enrich(sample_df)).collect()
        assert [(r.hour, r.service, r.requests) for r in rows] == [
            (14, "billing", 4), (14, "cart", 1), (14, "mail", 1), (14, "search", 2)
        ]
        assert rows[0].avg_response_ms == (150 + 2600 + 60 + 5200) / 4

    def test_status_distribution(self, sample_df):
        rows = aggregate_status_distribution(enrich(sample_df)).collect()
        got = {(r.service, r.status_class): r["count"] for r in rows}
        assert got == {
            ("billing", "2xx"): 1, ("billing", "4xx"): 1, ("billing", "5xx"): 2, ("cart", "5xx"): 1,
            ("mail", "2xx"): 1, ("search", "2xx"): 1, ("search", "3xx"): 1,
        }

    def test_top_slow_endpoints_limit_and_order(self, sample_df):
        slow = top_slow_endpoints(enrich(sample_df), n=3).collect()
        assert [tuple(r) for r in slow] == [
            ("/pay", "billing", 2650.0, 5200, 3), ("/send", "mail", 2400.0, 2400, 1), ("/add", "cart", 110.0, 110, 1),
        ]

    def test_top_slow_endpoints_tie_break(self, spark):
        t = datetime(2024, 1, 1)
        rows = [log_row(t, endpoint=e, service=s, rt=500) for e, s in [("/b", "x"), ("/a", "y"), ("/a", "x"), ("/c", "x")]]
        slow = top_slow_endpoints(enrich(make_logs(spark, rows)), n=2).collect()
        assert [(r.endpoint, r.service) for r in slow] == [("/a", "x"), ("/a", "y")]

    def test_ip_summary(self, sample_df):
        # Three IPs tie at one request: the smallest address wins the cut.
        assert [tuple(r) for r in ip_traffic_summary(enrich(sample_df), top_n=3).collect()] == [
            ("172.16.0.2", 3, 2, 1, 66.67), ("172.16.0.3", 2, 0, 2, 0.0), ("172.16.0.1", 1, 0, 1, 0.0),
        ]


class TestOptions:
    def test_approx_users_close_to_exact(self, spark):
        t = datetime(2024, 1, 1)
        rows = [log_row(t, ip="1.1.1.1", user=u) for u in range(500)]
        exact = ip_traffic_summary(enrich(make_logs(spark, rows))).first().unique_users
        approx = ip_traffic_summary(enrich(make_logs(spark, rows)), approx_users=True).first().unique_users
        assert exact == 500 and abs(approx - 500) <= 50

    def test_approx_percentiles_equal_exact_on_small_groups(self, sample_df):
        a = aggregate_by_service(enrich(sample_df), percentiles="approx", accuracy=100).collect()
        b = aggregate_by_service(enrich(sample_df)).collect()
        assert a == b
        c = top_slow_endpoints(enrich(sample_df), 3, percentiles="approx").collect()
        assert c == top_slow_endpoints(enrich(sample_df), 3).collect()


class TestExactPercentiles:
    def test_against_brute_force(self, spark):
        import math
        import random

        from logsieve.operators.percentiles import exact_percentiles

        rnd = random.Random(7)
        t = datetime(2024, 1, 1)
        rows, values = [], {"a": [], "b": [], None: []}
        for _ in range(3000):
            svc = rnd.choice(["a", "b", None])
            rt = rnd.choice([None] + [rnd.randint(0, 300)] * 9)
            rows.append(log_row(t, service=svc, rt=rt))
            if rt is not None:
                values[svc].append(rt)
        got = {
            r.service: (r.p50, r.p95, r.p99)
            for r in exact_percentiles(make_logs(spark, rows), ["service"], "response_time_ms",
                                       {"p50": 0.5, "p95": 0.95, "p99": 0.99}).collect()
        }
        for svc, vals in values.items():
            vals.sort()
            expect = tuple(vals[max(math.ceil(p * len(vals)), 1) - 1] for p in (0.5, 0.95, 0.99))
            assert got[svc] == expect

    def test_all_null_group_gives_null(self, spark):
        t = datetime(2024, 1, 1)
        rows = [log_row(t, service="a", rt=None), log_row(t, service="b", rt=5)]
        got = {r.service: r.p50_ms for r in aggregate_by_service(enrich(make_logs(spark, rows))).collect()}
        assert got == {"a": None, "b": 5}

    def test_by_service_plan_has_no_sketches(self, sample_df):
        from tests.conftest import explain

        plan = explain(aggregate_by_service(enrich(sample_df)))
        assert "percentile_approx" not in plan and "ObjectHashAggregate" not in plan


def test_null_endpoint_keeps_its_p99(spark):
    t = datetime(2024, 1, 1)
    rows = [log_row(t, endpoint=None, rt=r) for r in (900, 1000, 1100)] + [log_row(t, endpoint="/fast", rt=10)]
    got = {r.endpoint: (r.avg_ms, r.p99_ms, r.calls) for r in top_slow_endpoints(enrich(make_logs(spark, rows))).collect()}
    assert got == {None: (1000.0, 1100, 3), "/fast": (10.0, 10, 1)}
