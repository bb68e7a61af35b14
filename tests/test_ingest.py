import os

from pyspark.sql import Observation

from logsieve.operators import drop_invalid, quality_report, validate_logs
from logsieve.plans import load_logs
from logsieve.schema import LOG_COLUMNS
from logsieve.sources import read_logs, write_logs_csv
from tests.conftest import explain

HEADER = ",".join(LOG_COLUMNS)
GOOD = "2024-01-15 09:00:00,INFO,auth-api,GET,/api/auth/login,200,120,1024,1001,10.0.0.1,Mozilla/5.0,NONE"
LINES = [
    GOOD,
    "2024-01-15 09:00:05,ERROR,auth-api,POST,/api/auth/login,500,3500,512,,10.0.0.2,bot/1.0,NULL_USER_ID",
    "not-a-time,INFO,auth-api,GET,/api/x,200,10,1,1,10.0.0.3,curl,NONE",  # bad timestamp -> dropped
    "2024-01-15 09:00:10,INFO,auth-api,GET,/api/x,abc,10,1,1,10.0.0.4,curl,NONE",  # bad status -> dropped
    "2024-01-15 09:00:15,INFO,auth-api,GET",  # short row: status missing -> dropped
    "2024-01-15 09:00:20,INFO,product-svc,GET,/api/p,200,80,2048,1003,10.0.0.5,curl,NONE,extra",  # long row
    "2024-01-15 09:00:25,INFO,,GET,/api/p,200,80,2048,1003,10.0.0.6,curl,NONE",  # empty service -> dropped
    "2024-01-15 09:00:30,WARNING,search-svc,GET,/api/s,404,xx,1,1,10.0.0.7,curl,NONE",  # bad latency: kept
]


def _write_csv(tmp_dir, name="logs.csv", lines=LINES):
    path = os.path.join(tmp_dir, name)
    with open(path, "w") as f:
        f.write(HEADER + "\n" + "\n".join(lines) + "\n")
    return path


class TestReadLogs:
    def test_schema_and_types(self, spark, tmp_dir):
        df = read_logs(spark, _write_csv(tmp_dir))
        assert df.columns == list(LOG_COLUMNS)
        types = dict(df.dtypes)
        assert types["timestamp"] == "timestamp" and types["status_code"] == "int"
        assert types["bytes_sent"] == "bigint" and types["user_id"] == "bigint"
        assert df.count() == len(LINES)

    def test_permissive_nulls(self, spark, tmp_dir):
        rows = {r.ip_address: r for r in read_logs(spark, _write_csv(tmp_dir)).collect() if r.ip_address}
        assert rows["10.0.0.3"].timestamp is None
        assert rows["10.0.0.4"].status_code is None
        assert rows["10.0.0.5"].service == "product-svc"  # long row keeps its first columns
        assert rows["10.0.0.7"].response_time_ms is None
        assert rows["10.0.0.2"].user_id is None

    def test_drop_invalid(self, spark, tmp_dir):
        clean = drop_invalid(read_logs(spark, _write_csv(tmp_dir)))
        assert sorted(r.ip_address for r in clean.collect()) == ["10.0.0.1", "10.0.0.2", "10.0.0.5", "10.0.0.7"]

    def test_keep_corrupt(self, spark, tmp_dir):
        df = read_logs(spark, _write_csv(tmp_dir), keep_corrupt=True)
        corrupt = [r._corrupt_record for r in df.collect() if r._corrupt_record]
        assert any("abc" in c for c in corrupt)
        assert any(c.endswith("extra") for c in corrupt)

    def test_ntz_timestamps(self, spark, tmp_dir):
        df = read_logs(spark, _write_csv(tmp_dir), ntz=True)
        assert dict(df.dtypes)["timestamp"] == "timestamp_ntz"
        assert df.filter("timestamp is null").count() == 1
        assert str(df.filter("ip_address = '10.0.0.1'").first().timestamp) == "2024-01-15 09:00:00"

    def test_directory_glob_and_list(self, spark, tmp_dir):
        _write_csv(tmp_dir, "a.csv")
        _write_csv(tmp_dir, "b.csv", [GOOD])
        assert read_logs(spark, tmp_dir).count() == len(LINES) + 1
        assert read_logs(spark, os.path.join(tmp_dir, "*.csv")).count() == len(LINES) + 1
        assert read_logs(spark, [os.path.join(tmp_dir, "b.csv")]).count() == 1

    def test_csv_round_trip(self, spark, sample_df, tmp_dir):
        path = os.path.join(tmp_dir, "rt")
        write_logs_csv(sample_df, path)
        back = read_logs(spark, path)
        assert back.exceptAll(sample_df).count() == 0 and sample_df.exceptAll(back).count() == 0


class TestQuality:
    def test_report(self, spark, tmp_dir):
        r = quality_report(read_logs(spark, _write_csv(tmp_dir))).collect()[0]
        assert r.total_rows == 8
        assert (r.timestamp_nulls, r.log_level_nulls, r.service_nulls, r.status_code_nulls) == (1, 0, 1, 2)
        assert r.dropped_rows == 4 and r.valid_rows == 4
        assert r.status_code_null_pct == 25.0

    def test_observation_matches_report(self, spark, tmp_dir):
        raw = read_logs(spark, _write_csv(tmp_dir))
        obs = Observation("q")
        assert validate_logs(raw, observation=obs).count() == 4
        got = obs.get
        assert got["total_rows"] == 8 and got["dropped_rows"] == 4 and got["status_code_nulls"] == 2

    def test_load_logs_caches_and_registers_view(self, spark, tmp_dir):
        df = load_logs(spark, _write_csv(tmp_dir), view_name="logs_test_view")
        assert df.is_cached
        assert spark.sql("select count(*) from logs_test_view").collect()[0][0] == 4
        df.unpersist()

    def test_null_check_pushed_to_scan(self, spark, tmp_dir):
        plan = explain(drop_invalid(read_logs(spark, _write_csv(tmp_dir))))
        assert "PushedFilters: [IsNotNull(log_level), IsNotNull(service), IsNotNull(status_code)]" in plan


def test_custom_timestamp_format(spark, tmp_dir):
    line = "15/01/2024 09:00:00,INFO,auth-api,GET,/api/x,200,120,1024,1001,10.0.0.1,Mozilla/5.0,NONE"
    df = read_logs(spark, _write_csv(tmp_dir, "eu.csv", [line]), timestamp_format="dd/MM/yyyy HH:mm:ss")
    assert str(df.first().timestamp) == "2024-01-15 09:00:00"
