from datetime import datetime


from logsieve.operators import enrich, repartition_by_service
from tests.conftest import log_row, make_logs


class TestEnrich:
    def test_adds_derived_columns(self, sample_df):
        df = enrich(sample_df)
        for c in ("date", "hour", "is_error", "is_slow", "status_class"):
            assert c in df.columns
        assert dict(df.dtypes)["hour"] == "int"
        assert dict(df.dtypes)["date"] == "date"

    def test_boundaries_and_nulls(self, spark):
        t = datetime(2024, 1, 15, 23, 59, 59)
        rows = [log_row(t, status=s, rt=r) for s, r in [(101, 2000), (299, 2001), (300, None), (499, 0), (500, 1), (600, 5), (None, 5)]]
        got = enrich(make_logs(spark, rows)).select("status_code", "is_error", "is_slow", "status_class", "hour").collect()
        by_status = {r.status_code: r for r in got}
        assert by_status[101].status_class == "2xx" and by_status[101].is_slow is False
        assert by_status[299].is_slow is True
        assert by_status[300].status_class == "3xx" and by_status[300].is_slow is None
        assert by_status[499].status_class == "4xx" and by_status[499].is_error is False
        assert by_status[500].is_error is True
        assert by_status[600].status_class == "5xx"
        assert by_status[None].status_class == "5xx" and by_status[None].is_error is None
        assert {r.hour for r in got} == {23}

    def test_custom_slow_threshold(self, sample_df):
        assert enrich(sample_df, slow_ms=100).filter("is_slow").count() == 5


class TestRepartition:
    def test_repartition_by_service(self, sample_df):
        df = repartition_by_service(sample_df, 6)
        assert df.rdd.getNumPartitions() == 6
        assert df.count() == 8

    def test_salted_repartition_keeps_rows(self, sample_df):
        df = repartition_by_service(sample_df, 6, salt_buckets=3)
        assert df.count() == 8
        assert df.exceptAll(sample_df).count() == 0
