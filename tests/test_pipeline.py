import os

import pytest
from pyspark.sql import functions as F

from logsieve.plans import ANOMALY_TABLES, PROCESSING_TABLES, run_anomaly_detection, run_pipeline, run_processing
from logsieve.sources import read_results, write_logs_csv
from tests.test_ingest import _write_csv

ALL_TABLES = (*PROCESSING_TABLES, *ANOMALY_TABLES)


def _counts(spark, out):
    return {n: df.count() for n, df in read_results(spark, out, list(ALL_TABLES)).items()}


class TestPipeline:
    def test_processing_and_detection_tables(self, sample_df):
        proc, anom = run_processing(sample_df), run_anomaly_detection(sample_df)
        assert tuple(proc) == PROCESSING_TABLES and tuple(anom) == ANOMALY_TABLES
        assert proc["by_service"].count() == 4
        assert anom["report"].count() == 5 and anom["null_users"].count() == 2

    def test_writes_all_tables_from_csv(self, spark, tmp_dir):
        out = os.path.join(tmp_dir, "out")
        result = run_pipeline(spark, _write_csv(tmp_dir), out)
        assert set(result.paths) == set(ALL_TABLES)
        counts = _counts(spark, out)
        assert counts["by_service"] == 3 and counts["null_users"] == 1
        assert result.quality["total_rows"] == 8 and result.quality["dropped_rows"] == 4
        assert result.staged_at is not None

    @pytest.mark.parametrize("stage", ["table", "cache", "none"])
    def test_stage_modes_agree_and_overwrite(self, spark, sample_df, tmp_dir, stage):
        src = os.path.join(tmp_dir, "src")
        write_logs_csv(sample_df, src)
        out = os.path.join(tmp_dir, "out")
        run_pipeline(spark, src, out, stage=stage)
        first = _counts(spark, out)
        run_pipeline(spark, src, out, stage=stage)  # overwrite, not append
        assert _counts(spark, out) == first
        assert first == {
            "by_service": 4, "by_hour": 4, "status_dist": 7, "slow_endpoints": 5, "ip_summary": 5,
            "report": 5, "error_spikes": 2, "brute_force": 0, "null_users": 2,
        }

    def test_accepts_dataframe(self, spark, sample_df, tmp_dir):
        out = os.path.join(tmp_dir, "out")
        run_pipeline(spark, sample_df, out)
        report = spark.read.parquet(os.path.join(out, "report.parquet"))
        assert report.count() == 5


def test_scratch_paths_live_under_checkpoint_dir(spark):
    from logsieve.sources import checkpoint_root, scratch_path

    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root + "/") and a != b


def test_partitioned_table_write(spark, sample_df, tmp_dir):
    from logsieve.operators import detect_null_user_ids, enrich
    from logsieve.sources import save_results

    out = os.path.join(tmp_dir, "out")
    paths = save_results({"null_users": detect_null_user_ids(enrich(sample_df))}, out, partition_by={"null_users": ["date"]})
    assert os.path.isdir(os.path.join(paths["null_users"], "date=2024-03-10"))
    assert spark.read.parquet(paths["null_users"]).count() == 2


def test_command_line_entry(spark, sample_df, tmp_dir, capsys):
    import json

    from logsieve.__main__ import main

    src = os.path.join(tmp_dir, "src")
    write_logs_csv(sample_df, src)
    main([src, os.path.join(tmp_dir, "out"), "--stage", "cache"])
    printed = json.loads(capsys.readouterr().out)
    assert printed["staged_at"] is None
    assert printed["quality"]["total_rows"] == 8 and set(printed["tables"]) == set(ALL_TABLES)


def test_thresholds_reach_the_detectors(sample_df):
    from logsieve.schema import Thresholds

    loose = Thresholds(error_spike_pct=101, slow_ms=100_000, latency_multiplier=0.5, top_slow_endpoints=2, top_ips=1)
    anom = run_anomaly_detection(sample_df, loose)
    assert anom["error_spikes"].count() == 0  # no window can exceed 100 %
    flags = {r.anomaly_flags for r in anom["report"].collect()}
    assert not any("SLOW" in f for f in flags) and any("HIGH_LATENCY" in f for f in flags)
    proc = run_processing(sample_df, loose)
    assert proc["slow_endpoints"].count() == 2 and proc["ip_summary"].count() == 1


@pytest.mark.parametrize("stage", ["table", "cache", "none"])
def test_quality_numbers_in_every_stage(spark, sample_df, tmp_dir, stage):
    from logsieve.operators import quality_report
    from tests.conftest import make_logs

    empty = run_pipeline(spark, make_logs(spark, []), os.path.join(tmp_dir, "none"), stage=stage).quality
    assert len(empty) == 6 and set(empty.values()) == {0}
    some = run_pipeline(spark, sample_df.withColumn("log_level", F.expr("if(service = 'mail', null, log_level)")),
                        os.path.join(tmp_dir, "some"), stage=stage).quality
    assert some == empty | {"total_rows": 8, "log_level_nulls": 1, "dropped_rows": 1}
    report = quality_report(make_logs(spark, [])).first()
    assert (report.total_rows, report.dropped_rows, report.valid_rows, report.service_nulls) == (0, 0, 0, 0)
    assert report.service_null_pct is None


@pytest.mark.parametrize("stage", ["table", "cache", "none"])
def test_growing_folder_in_one_session(spark, tmp_dir, stage):
    from datetime import datetime, timedelta

    from tests.conftest import log_row, make_logs

    t, src = datetime(2024, 1, 1), os.path.join(tmp_dir, "src")
    day1 = [log_row(t + timedelta(seconds=i), rt=100 if i else 1900) for i in range(21)]
    day2 = [log_row(t + timedelta(days=1, seconds=i), rt=1900) for i in range(81)]

    def flagged():
        run_pipeline(spark, src + "/*", os.path.join(tmp_dir, "out"), stage=stage)
        report = spark.read.parquet(os.path.join(tmp_dir, "out", "report.parquet"))
        return report.filter("anomaly_flags like '%HIGH_LATENCY%'").count()

    write_logs_csv(make_logs(spark, day1), src + "/day1")
    assert flagged() == 1
    write_logs_csv(make_logs(spark, day2), src + "/day2")
    assert flagged() == 0


def test_staged_table_can_be_dropped(spark, sample_df, tmp_dir):
    stage = os.path.join(tmp_dir, "clean_logs")
    result = run_pipeline(spark, sample_df, os.path.join(tmp_dir, "out"), stage_dir=stage, keep_staged=False)
    assert result.staged_at is None and not os.path.exists(stage)


def test_empty_input(spark, tmp_dir):
    from logsieve.operators import compute_rolling_error_rate, enrich
    from tests.conftest import make_logs

    empty = make_logs(spark, [])
    out = os.path.join(tmp_dir, "out")
    result = run_pipeline(spark, empty, out)
    assert set(_counts(spark, out).values()) == {0}
    assert set(result.quality.values()) == {0}
    assert compute_rolling_error_rate(enrich(empty)).count() == 0


def test_pipeline_partitioned_output(spark, sample_df, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    result = run_pipeline(spark, sample_df, out, stage="cache", partition_by={"null_users": ["date"], "by_hour": ["date"]})
    assert os.path.isdir(os.path.join(result.paths["null_users"], "date=2024-03-10"))
    assert spark.read.parquet(result.paths["by_hour"]).count() == 4


def test_stage_dir_keeps_clean_table(spark, sample_df, tmp_dir):
    stage = os.path.join(tmp_dir, "clean_logs")
    result = run_pipeline(spark, sample_df, os.path.join(tmp_dir, "out"), stage_dir=stage)
    assert result.staged_at == stage
    clean = spark.read.parquet(stage)
    assert clean.count() == 8 and "status_class" in clean.columns
