import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logsieve.operators import detect_brute_force, detect_error_spikes, detect_null_user_ids, drop_invalid, enrich
from logsieve.sources import write_logs_csv
from logsieve.streaming import late_rows, prepare_stream, read_log_stream, start_detectors
from tests.conftest import log_row, make_logs

T0 = datetime(2024, 1, 15, 9, 0, 0)


def _rows():
    rows = []
    for m in range(40):  # 40 minutes of traffic, one row every 10 s
        for s in range(0, 60, 10):
            t = T0 + timedelta(minutes=m, seconds=s)
            rows.append(log_row(t, service="a", status=500 if m % 7 == 0 else 200, user=None if s == 0 else 5))
            rows.append(log_row(t, service="b", status=200))
    # a brute-force burst from one IP in minutes 10-12
    rows += [log_row(T0 + timedelta(minutes=10, seconds=i), ip="9.9.9.9", status=401) for i in range(120)]
    return rows


def test_streaming_detectors_match_batch_for_closed_windows(spark, tmp_dir):
    logs = make_logs(spark, _rows())
    src = os.path.join(tmp_dir, "incoming")
    # Two batches of files, in time order.
    write_logs_csv(logs.filter(F.col("timestamp") < T0 + timedelta(minutes=20)), os.path.join(src, "part1"))
    write_logs_csv(logs.filter(F.col("timestamp") >= T0 + timedelta(minutes=20)), os.path.join(src, "part2"))

    stream = prepare_stream(read_log_stream(spark, os.path.join(src, "*"), max_files_per_trigger=1), "5 minutes")
    out = os.path.join(tmp_dir, "out")
    queries = start_detectors(spark, stream, out, available_now=True)
    for q in queries.values():
        q.awaitTermination(120)
        assert q.exception() is None

    clean = enrich(drop_invalid(logs))
    # A window is emitted once its end <= latest event - 5 minutes; those
    # windows are final and must equal the batch result exactly.
    horizon = clean.agg(F.max("timestamp")).first()[0] - timedelta(minutes=5)
    batch = {
        "error_spikes": detect_error_spikes(clean, ordered=False),
        "brute_force": detect_brute_force(clean, ordered=False),
    }
    for name, expected in batch.items():
        got = spark.read.parquet(os.path.join(out, f"{name}.parquet"))
        expected = expected.filter(F.col("window.end") <= F.lit(horizon))
        got_closed = got.filter(F.col("window.end") <= F.lit(horizon))
        assert got_closed.count() > 0
        assert got_closed.exceptAll(expected).count() == 0 and expected.exceptAll(got_closed).count() == 0

    nulls = spark.read.parquet(os.path.join(out, "null_users.parquet"))
    assert nulls.count() == detect_null_user_ids(clean).count() == 40


def test_ntz_stream_is_rejected(spark):
    import pytest
    from pyspark.sql.types import TimestampNTZType

    df = spark.readStream.format("rate").load().select(F.col("timestamp").cast(TimestampNTZType()).alias("timestamp"))
    with pytest.raises(TypeError):
        prepare_stream(df)


def _run(spark, src, out):
    stream = prepare_stream(read_log_stream(spark, src + "/*"), "5 minutes")
    queries = start_detectors(spark, stream, out, available_now=True)
    for q in queries.values():
        q.awaitTermination(120)
        assert q.exception() is None
    return queries


def test_restart_over_a_growing_folder_counts_every_row_once(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    first = [log_row(T0 + timedelta(seconds=i), user=None) for i in range(50)]
    then = [log_row(T0 + timedelta(minutes=20, seconds=i), user=None, status=500) for i in range(30)]
    write_logs_csv(make_logs(spark, first), src + "/a")
    _run(spark, src, out)
    write_logs_csv(make_logs(spark, then), src + "/b")
    queries = _run(spark, src, out)
    assert spark.read.parquet(out + "/null_users.parquet").count() == 80
    assert late_rows(queries["error_spikes"]) == 0
    # Rows behind the watermark are dropped by the window detectors, and counted.
    write_logs_csv(make_logs(spark, first[:7]), src + "/c")
    queries = _run(spark, src, out)
    assert late_rows(queries["error_spikes"]) > 0
    assert spark.read.parquet(out + "/null_users.parquet").count() == 87
