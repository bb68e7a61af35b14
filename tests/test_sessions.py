"""Sessions and their longest failure run, against plain Python."""

import random
import re
from datetime import datetime, timedelta

import pytest

from logsieve.operators import detect_slow_attacks, session_runs
from logsieve.operators.sessions import SESSION_COLUMNS
from logsieve.sources import write_logs_csv
from logsieve.streaming import prepare_stream, read_log_stream, stream_slow_attacks
from tests.conftest import explain, log_row, make_logs

T = datetime(2024, 5, 6, 8, 0, 0)


def brute_sessions(rows, gap):
    """(ip, start, end, total, failures, longest, run start, run end), row by row."""
    by_ip = {}
    for r in rows:
        if r[0] is not None:
            by_ip.setdefault(r[9], []).append((r[0], r[5] in (401, 403)))
    out = []
    for ip, seen in by_ip.items():
        seen.sort()  # successes of a second before its failures
        sessions = [[seen[0]]]
        for row in seen[1:]:
            if (row[0] - sessions[-1][-1][0]).total_seconds() > gap:
                sessions.append([])
            sessions[-1].append(row)
        for s in sessions:
            best, run = [], []
            for row in s:
                run = [*run, row[0]] if row[1] else []
                best = run if len(run) > len(best) else best
            out.append((ip, s[0][0], s[-1][0], len(s), sum(f for _, f in s), len(best),
                        best[0] if best else None, best[-1] if best else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,span,gap", [(1, 4000, 300), (2, 40000, 1800), (3, 200000, 1800), (4, 300000, 9000)])
def test_equals_a_row_by_row_search(spark, seed, span, gap):
    rng = random.Random(seed)
    rows = [
        log_row(T + timedelta(seconds=rng.randrange(span)), status=rng.choice([200, 401, 401, 403, 401, 500, None]),
                ip=rng.choice(["1.1.1.1", "1.1.1.1", "2.2.2.2", None]))
        for _ in range(600)
    ] + [log_row(None, status=401)]
    got = session_runs(make_logs(spark, rows), gap).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_sessions(rows, gap)


def test_a_slow_attack_is_found_across_hours(spark):
    """One failure every twenty minutes for a day: no five-minute window sees two."""
    rows = [log_row(T + timedelta(minutes=20 * k), status=401, ip="9.9.9.9") for k in range(72)]
    rows += [log_row(T + timedelta(minutes=k), status=401 if k % 3 else 200, ip="8.8.8.8") for k in range(600)]
    (hit,) = detect_slow_attacks(make_logs(spark, rows)).collect()
    assert (hit.ip_address, hit.longest_run, hit.total) == ("9.9.9.9", 72, 72)
    assert (hit.run_start, hit.run_end) == (rows[0][0], rows[71][0])


def test_gap_and_run_bounds(spark):
    rows = [log_row(T + timedelta(seconds=1800 * k), status=403, ip="a") for k in range(20)]
    rows += [log_row(T + timedelta(seconds=1801 * k), status=403, ip="b") for k in range(40)]
    rows += [log_row(T + timedelta(seconds=k), status=403, ip="c") for k in range(19)]
    assert [r.ip_address for r in detect_slow_attacks(make_logs(spark, rows)).collect()] == ["a"]
    assert detect_slow_attacks(make_logs(spark, [])).collect() == []


def test_rows_are_counted_by_second_before_they_move(spark):
    plan = explain(session_runs(make_logs(spark, [log_row(T)])))
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", plan)
    assert moved and not any("status_code" in m or "timestamp" in m for m in moved)
    assert "PythonUDF" not in plan and "InPandas" not in plan


def run_stream(spark, tmp_dir, slices, watermark, min_run):
    for k, part in enumerate(slices):
        write_logs_csv(make_logs(spark, part), f"{tmp_dir}/src/slice{k}")
        stream = prepare_stream(read_log_stream(spark, f"{tmp_dir}/src/*"), watermark)
        query = stream_slow_attacks(stream, min_run, 600).writeStream.format("parquet").outputMode("append").option(
            "path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.parquet(f"{tmp_dir}/out").select(*SESSION_COLUMNS).collect()


def test_stream_gives_the_closed_sessions_of_the_batch(spark, tmp_dir):
    """Three starts, rows out of order inside the watermark, an IP that spans all slices."""
    rng = random.Random(11)
    rows = sorted((log_row(T + timedelta(seconds=rng.randrange(20000)), status=rng.choice([200, 401, 401, 401]),
                           ip=rng.choice(["a", "a", "b", "c"])) for _ in range(400)), key=lambda r: r[0])
    rows += [log_row(T + timedelta(seconds=20000 + 600 * 3), ip="z")]
    slices = [rows[:130], rows[130:270], rows[270:]]
    got = run_stream(spark, tmp_dir, [rng.sample(s, len(s)) for s in slices], "5 minutes", 3)
    last = max(r[0] for r in rows) - timedelta(minutes=5)
    want = [r for r in brute_sessions(rows, 600) if r[5] >= 3 and r[2] + timedelta(seconds=600) < last]
    assert sorted(map(tuple, got), key=repr) == want
    assert len(want) > 3


@pytest.mark.parametrize("seed,ips,watermark", [(12, 40, "1 minute"), (13, 200, "5 minutes")])
def test_stream_state_is_a_row_for_many_ips(spark, tmp_dir, seed, ips, watermark):
    """Runs and sessions that go on over slices, ties, a null IP; IPs share state rows."""
    rng = random.Random(seed)
    rows = sorted((log_row(T + timedelta(seconds=rng.randrange(9000)), status=rng.choice([200, 401, 403, None]),
                           ip=rng.choice([None, "a", "b", f"é{rng.randrange(ips)}", f"x{rng.randrange(ips)}"]))
                   for _ in range(4000)), key=lambda r: r[0])
    rows += [log_row(T + timedelta(hours=4), ip="z")]
    rows = [r for r in rows if r[5] is not None]
    buckets, slices = 16, [rows[:700], rows[700:1500], rows[1500:]]
    for k, part in enumerate(slices):
        write_logs_csv(make_logs(spark, rng.sample(part, len(part))), f"{tmp_dir}/src/slice{k}")
        stream = prepare_stream(read_log_stream(spark, f"{tmp_dir}/src/*"), watermark)
        query = stream_slow_attacks(stream, 2, 300, buckets=buckets).writeStream.format("parquet").option(
            "path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start()
        query.awaitTermination()
        assert all(p["stateOperators"][0]["numRowsTotal"] <= buckets for p in query.recentProgress)
    got = spark.read.parquet(f"{tmp_dir}/out").select(*SESSION_COLUMNS).collect()
    want = [r for r in brute_sessions(rows, 300) if r[5] >= 2 and r[0] != "z"]
    assert sorted(map(tuple, got), key=repr) == want
    assert len(want) > 30
