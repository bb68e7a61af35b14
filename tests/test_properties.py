"""Property tests: the scalable rewrites equal plain-Python counts on
arbitrary small inputs (ties, nulls, gaps, dense seconds, many services)."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logsieve.operators import compute_rolling_error_rate, detect_high_latency, enrich
from tests.conftest import assert_high_latency, assert_rolling, half_up, log_row, make_logs

T0 = datetime(2024, 1, 15, 0, 0, 0)

rows_strategy = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 3 * 3600)),  # seconds offset (null = no timestamp)
        st.sampled_from(["a", "b", "c", None]),
        st.sampled_from([200, 201, 404, 401, 500, 503, None]),
        st.one_of(st.none(), st.integers(0, 20_000)),
    ),
    min_size=1,
    max_size=60,
)

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _logs(spark, rows):
    return enrich(
        make_logs(
            spark,
            [
                log_row(None if s is None else T0 + timedelta(seconds=s), service=svc, status=st_, rt=rt)
                for s, svc, st_, rt in rows
            ],
        )
    )


@SETTINGS
@given(rows=rows_strategy, lookback=st.sampled_from([0, 1, 60, 3600]))
def test_rolling_against_python(spark, rows, lookback):
    df = _logs(spark, rows)
    assert_rolling(df, compute_rolling_error_rate(df, lookback), lookback)


@SETTINGS
@given(rows=rows_strategy, multiplier=st.sampled_from([0.0, 0.5, 1.0, 3.0]))
def test_high_latency_against_python(spark, rows, multiplier):
    assert_high_latency(detect_high_latency(_logs(spark, rows), multiplier), multiplier)


window_rows = st.lists(
    st.tuples(
        st.integers(0, 3 * 600),  # seconds: a few 5-minute windows
        st.sampled_from(["a", "b"]),
        st.sampled_from(["1.1.1.1", "2.2.2.2"]),
        st.sampled_from([200, 401, 403, 500, 503]),
    ),
    min_size=1,
    max_size=120,
)


@SETTINGS
@given(rows=window_rows, threshold=st.sampled_from([0, 10, 50, 100]), min_req=st.sampled_from([1, 5, 20]))
def test_window_detectors_against_python(spark, rows, threshold, min_req):
    from collections import defaultdict

    from logsieve.operators import detect_brute_force, detect_error_spikes

    df = enrich(make_logs(spark, [log_row(T0 + timedelta(seconds=s), service=svc, ip=ip, status=code)
                                  for s, svc, ip, code in rows]))
    by_service, by_ip = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for s, svc, ip, code in rows:
        w = s // 300
        by_service[(svc, w)][0] += 1
        by_service[(svc, w)][1] += code >= 500
        by_ip[(ip, w)][0] += 1
        by_ip[(ip, w)][1] += code in (401, 403)
    spikes = {k for k, (n, e) in by_service.items() if half_up(e / n * 100, 2) >= threshold}
    brute = {k for k, (n, f) in by_ip.items() if n >= min_req and half_up(f / n, 3) >= 0.8}

    def key(r, col):
        return (r[col], int((r.window.start - T0).total_seconds()) // 300)

    got_spikes = {key(r, "service") for r in detect_error_spikes(df, threshold, ordered=False).collect()}
    got_brute = {key(r, "ip_address") for r in detect_brute_force(df, min_req, ordered=False).collect()}
    assert got_spikes == spikes and got_brute == brute
