"""Physical-plan checks: no Python in the data path, pushdown, broadcast and
top-k strategies, no single-task window over a whole service."""

from pyspark.sql import functions as F

from logsieve.operators import (
    aggregate_by_hour,
    aggregate_by_service,
    build_anomaly_report,
    compute_rolling_error_rate,
    detect_high_latency,
    drop_invalid,
    enrich,
    ip_traffic_summary,
    top_slow_endpoints,
)
from logsieve.sources import logs_from_events
from tests.conftest import explain

SF = "/root/testdata/sf0.001"


def _plan(df):
    return explain(df)


def _clean(spark):
    return enrich(drop_invalid(logs_from_events(spark, SF)))


def test_no_python_udfs(spark):
    df = _clean(spark)
    for q in (aggregate_by_service(df), build_anomaly_report(df), compute_rolling_error_rate(df)):
        plan = _plan(q)
        assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_scan_reads_only_needed_columns(spark, sample_df, tmp_dir):
    path = f"{tmp_dir}/wide"
    sample_df.withColumn("unused", F.lit("x")).write.parquet(path)
    hours = aggregate_by_hour(enrich(drop_invalid(spark.read.parquet(path))))
    scan = next(line for line in _plan(hours).splitlines() if line.startswith("ReadSchema"))
    assert scan == (
        "ReadSchema: struct<timestamp:timestamp,log_level:string,service:string,status_code:int,response_time_ms:int>"
    )
    pushed = next(line for line in _plan(hours).splitlines() if line.startswith("PushedFilters"))
    assert all(f"IsNotNull({c})" in pushed for c in ("timestamp", "log_level", "service", "status_code"))


def test_slow_endpoints_scan_twice(spark):
    assert _plan(top_slow_endpoints(_clean(spark))).count("ReadSchema") == 2


def test_unordered_report_has_no_range_exchange(spark, sample_df):
    from logsieve.plans import run_anomaly_detection

    def plan(ordered):
        return _plan(run_anomaly_detection(sample_df, ordered_report=ordered)["report"])

    assert "rangepartitioning" in plan(True) and "rangepartitioning" not in plan(False)


def test_rolling_shuffle_join_gives_the_same_rows(spark):
    df = _clean(spark)
    want = sorted(map(str, compute_rolling_error_rate(df).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rolled = compute_rolling_error_rate(df)
        assert "BroadcastHashJoin" not in _plan(rolled)
        assert sorted(map(str, rolled.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_high_latency_broadcasts_small_stats(spark):
    plan = _plan(detect_high_latency(_clean(spark)))
    assert "BroadcastHashJoin" in plan
    assert "Window" not in plan


def test_high_latency_fallback_is_shuffle_join(spark):
    # Beyond the row bound no hint is given; with Spark's own size-estimate
    # broadcast also off (as for a large input), the join shuffles.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(detect_high_latency(_clean(spark), max_broadcast_rows=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_top_k_is_take_ordered(spark):
    for q in (top_slow_endpoints(_clean(spark)), ip_traffic_summary(_clean(spark))):
        assert "TakeOrderedAndProject" in _plan(q)


def test_rolling_window_not_partitioned_by_service_alone(spark):
    plan = _plan(compute_rolling_error_rate(_clean(spark)))
    assert "rangebetween" not in plan.lower()
    assert "_bucket" in plan


def test_operators_start_no_jobs_when_built(spark):
    """Building the lazy operators runs nothing; only the broadcast size
    check of the latency statistics is an action."""
    from logsieve.operators import (
        aggregate_status_distribution,
        detect_brute_force,
        detect_error_spikes,
        detect_null_user_ids,
        quality_report,
    )

    tracker = spark.sparkContext.statusTracker()
    df = _clean(spark)  # reading the source's schema may run a job; operators must not
    spark.sparkContext.setJobGroup("build-only", "operator construction")
    try:
        for op in (
            aggregate_by_service, aggregate_by_hour, aggregate_status_distribution, top_slow_endpoints,
            ip_traffic_summary, compute_rolling_error_rate, detect_error_spikes, detect_brute_force,
            detect_null_user_ids, quality_report,
        ):
            op(df)
        assert tracker.getJobIdsForGroup("build-only") == []
        detect_high_latency(df)
        assert len(tracker.getJobIdsForGroup("build-only")) >= 1
    finally:
        spark.sparkContext.setJobGroup("", "")
