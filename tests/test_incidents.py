"""Sliding error windows and incidents."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

from logsieve.operators import detect_error_spikes, detect_incidents, enrich
from tests.conftest import half_up, log_row, make_logs

T = datetime(2024, 5, 6, 8, 0, 0)


def at(seconds, **kw):
    return log_row(T + timedelta(seconds=seconds), **kw)


def brute(rows, width=5, bound=10):
    counts = defaultdict(lambda: [0, 0])
    for r in rows:
        if r[0] is not None:
            c = counts[(r[2], int((r[0] - datetime(1970, 1, 1)).total_seconds()) // 60)]
            c[0] += 1
            c[1] += bool(r[5] and r[5] >= 500)
    covered = defaultdict(list)
    for svc in {s for s, _ in counts}:
        panes = [p for s, p in counts if s == svc]
        for w in range(min(panes) - width, max(panes) + 1):
            n = sum(counts[(svc, p)][0] for p in range(w, w + width) if (svc, p) in counts)
            e = sum(counts[(svc, p)][1] for p in range(w, w + width) if (svc, p) in counts)
            if e and half_up(e / n * 100, 2) >= bound:
                for p in range(w, w + width):
                    covered[(svc, p)].append((half_up(e / n * 100, 2), w == p))
    out = []
    for svc, p in sorted(covered, key=lambda k: (str(k[0]), k[1])):
        if (svc, p - 1) not in covered:
            out.append([svc, p, p, 0, 0, 0, 0.0])
        span = out[-1]
        span[2] = p + 1
        span[3] += sum(first for _, first in covered[(svc, p)])
        n, e = counts.get((svc, p), (0, 0))
        span[4], span[5] = span[4] + n, span[5] + e
        span[6] = max(span[6], *(rate for rate, _ in covered[(svc, p)]))
    base = datetime(1970, 1, 1)
    return sorted(((s, base + timedelta(minutes=a), base + timedelta(minutes=b), w, n, e, half_up(e / n * 100, 2), peak)
                   for s, a, b, w, n, e, peak in out), key=repr)


def test_equals_counting_every_window(spark):
    rng = random.Random(7)
    rows = [at(rng.randrange(12000), service=rng.choice(["a", "b", None]), status=500 if rng.random() < 0.07 else 200) for _ in range(900)]
    rows.append(log_row(None))
    got = detect_incidents(enrich(make_logs(spark, rows))).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert len(got) > 3


def test_a_spike_cut_in_two_is_one_incident(spark):
    """Errors at 4:30 and 5:30, each below the bound in its tumbling window."""
    rows = [at(s, status=200) for s in range(0, 600, 10)]
    rows += [at(s, status=500) for s in (270, 280, 310, 320)]
    df = enrich(make_logs(spark, rows))
    assert detect_error_spikes(df, 8).collect() == []
    (one,) = detect_incidents(df, threshold_pct=8).collect()
    assert one.errors == 4 and one.incident_start < T + timedelta(seconds=270) < T + timedelta(seconds=320) < one.incident_end


def test_empty_and_clean_logs(spark):
    assert detect_incidents(enrich(make_logs(spark, []))).collect() == []
    assert detect_incidents(enrich(make_logs(spark, [at(1), at(2, status=None)]))).collect() == []
