"""Replaceable days, clustered tables and quarantine."""

import glob
import os
import random
from collections import Counter
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest

from logsieve.operators import drop_invalid, enrich
from logsieve.schema import LOG_COLUMNS
from logsieve.sources import (
    read_days,
    read_logs,
    read_quarantine,
    read_routed,
    read_valid,
    replace_days,
    write_clustered,
    write_days,
    write_routed,
)
from logsieve.sources.quarantine import REASONS
from tests.conftest import explain, log_row, make_logs

T = datetime(2024, 5, 6, 8, 0, 0)


def day_rows(day, n, **kw):
    return [log_row(T + timedelta(days=day, seconds=k), **kw) for k in range(n)]


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/date=*/*.parquet")}


def test_a_rerun_of_one_day_leaves_the_others_files(spark, tmp_dir):
    path = f"{tmp_dir}/days"
    write_days(enrich(make_logs(spark, day_rows(0, 30) + day_rows(1, 20) + day_rows(2, 10))), path)
    before = files(path)
    write_days(enrich(make_logs(spark, day_rows(1, 7, status=500))), path)
    after = files(path)
    others = {f for f in before if "2024-05-07" not in f}
    assert others and {f: before[f] for f in others} == {f: after[f] for f in after if "2024-05-07" not in f}
    assert dict(Counter(r.date for r in read_days(spark, path).collect())) == {
        date(2024, 5, 6): 30, date(2024, 5, 7): 7, date(2024, 5, 8): 10}


def test_replaced_days_hold_only_the_new_rows(spark, tmp_dir):
    """Rows of other days are not written, and a day without rows becomes empty."""
    path = f"{tmp_dir}/days"
    write_days(enrich(make_logs(spark, day_rows(0, 3) + day_rows(1, 4) + day_rows(2, 5))), path)
    new = enrich(make_logs(spark, day_rows(0, 9) + day_rows(1, 2)))
    replace_days(new, path, [date(2024, 5, 7), date(2024, 5, 8)])
    replace_days(new, path, [])
    spark.catalog.refreshByPath(path)
    assert Counter(r.date for r in read_days(spark, path).collect()) == {date(2024, 5, 6): 3, date(2024, 5, 7): 2}


def test_bounds_prune_folders(spark, tmp_dir):
    path = f"{tmp_dir}/days"
    write_days(enrich(make_logs(spark, day_rows(0, 3) + day_rows(1, 4) + day_rows(2, 5))), path)
    df = read_days(spark, path, date(2024, 5, 7), date(2024, 5, 7))
    assert "PartitionFilters: [isnotnull(date" in explain(df)
    assert {f.split("date=")[1][:10] for f in df.inputFiles()} <= {"2024-05-06", "2024-05-07", "2024-05-08"}
    assert {r.date for r in df.collect()} == {date(2024, 5, 7)}


def row_groups(path):
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            yield {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}, group.num_rows


def test_a_service_and_hour_filter_skips_row_groups(spark, tmp_dir):
    """By its bounds of both columns, nine row groups in ten."""
    rng = random.Random(3)
    rows = [log_row(T + timedelta(seconds=rng.randrange(86400)), service=rng.choice(["hot"] * 6 + [f"s{k}" for k in range(12)]),
                    ip=f"10.0.{rng.randrange(200)}.{rng.randrange(200)}") for _ in range(20000)]
    df = make_logs(spark, rows)
    wanted = "service = 's5' and timestamp >= '2024-05-06 12:00:00' and timestamp < '2024-05-06 13:00:00'"
    low, high = T + timedelta(hours=4), T + timedelta(hours=5)

    def may_hold(columns):
        s, t = columns["service"].statistics, columns["timestamp"].statistics
        return s.min <= "s5" <= s.max and t.min.replace(tzinfo=None) < high and t.max.replace(tzinfo=None) >= low

    write_clustered(df, f"{tmp_dir}/z", 40)
    got = spark.read.parquet(f"{tmp_dir}/z")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, df.collect()))
    assert Counter(map(tuple, got.where(wanted).collect())) == Counter(map(tuple, df.where(wanted).collect()))
    groups = list(row_groups(f"{tmp_dir}/z"))
    assert len(groups) >= 30 and max(n for _, n in groups) < 20000 / 40 * 3  # the hot service is split too
    assert sum(may_hold(c) for c, _ in groups) <= len(groups) / 10


def test_bloom_filters_are_written(spark, tmp_dir):
    df = make_logs(spark, [log_row(T, ip=f"10.{k % 7}.{k}.{k * k}") for k in range(2000)])
    write_clustered(df, f"{tmp_dir}/with", 1, bloom={"ip_address": 4000})
    write_clustered(df, f"{tmp_dir}/without", 1, bloom=())
    size = {k: sum(map(os.path.getsize, glob.glob(f"{tmp_dir}/{k}/*.parquet"))) for k in ("with", "without")}
    assert size["with"] > size["without"] + 2000
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"
    got = spark.read.parquet(f"{tmp_dir}/with")
    assert got.where("ip_address = '10.1.1.1'").count() == 1 and got.where("ip_address = 'none'").count() == 0


def test_clustered_edge_cases(spark, tmp_dir):
    rows = [log_row(None, service=None), log_row(T, service=""), log_row(T, service="ä" * 40)] * 3
    for k, some in enumerate(([], rows)):
        write_clustered(make_logs(spark, some), f"{tmp_dir}/z{k}", 3)
        assert spark.read.parquet(f"{tmp_dir}/z{k}").count() == len(some)


GOOD = "2024-05-06 08:00:00,INFO,svc,GET,/x,200,10,20,3,1.1.1.1,ua,NONE"
LINES = [
    # line, route, reasons
    (GOOD, "valid", []),
    (GOOD + ",more", "valid", ["too long"]),
    (",".join(GOOD.split(",")[:8]), "valid", ["too short"]),
    (",".join(GOOD.split(",")[:3]), "quarantine", ["missing status_code", "too short"]),
    (GOOD.replace(",200,", ",abc,"), "quarantine", ["unreadable status_code"]),
    (GOOD.replace("2024-05-06 08:00:00", "yesterday"), "quarantine", ["unreadable timestamp"]),
    (GOOD.replace("2024-05-06 08:00:00", ""), "quarantine", ["missing timestamp"]),
    (GOOD.replace(",svc,", ",,"), "quarantine", ["missing service"]),
    (GOOD.replace(",10,20,3,", ",ten,20,me,"), "valid", ["unreadable response_time_ms", "unreadable user_id"]),
    (GOOD.replace("ua", '"a, b ""c"""'.replace('""', '\\"')), "valid", []),
    (GOOD.replace(",200,", ",99999999999,"), "quarantine", ["unreadable status_code"]),
]


@pytest.fixture()
def broken_csv(tmp_dir):
    os.mkdir(f"{tmp_dir}/csv")
    with open(f"{tmp_dir}/csv/a.csv", "w") as f:
        f.write("\n".join([",".join(LOG_COLUMNS), *(line for line, *_ in LINES)]) + "\n")
    return f"{tmp_dir}/csv"


def test_every_line_is_routed_with_its_reasons(spark, broken_csv):
    got = read_routed(spark, broken_csv).collect()
    assert [(r.route, list(r.reasons)) for r in got] == [(route, reasons) for _, route, reasons in LINES]
    assert [r.raw for r in got] == [line if reasons else None for line, _, reasons in LINES]
    assert [[n for k, n in enumerate(REASONS) if r.reason_mask >> k & 1] for r in got] == [reasons for *_, reasons in LINES]


def test_valid_and_quarantined_make_the_input(spark, broken_csv, tmp_dir):
    routed = write_routed(read_routed(spark, broken_csv), f"{tmp_dir}/out")
    valid, rest = read_valid(spark, routed.path), read_quarantine(spark, routed.path)
    want = drop_invalid(read_logs(spark, broken_csv))
    assert sorted(map(repr, (tuple(r) for r in valid.collect()))) == sorted(map(repr, (tuple(r) for r in want.collect())))
    assert (routed.valid, routed.quarantined) == (valid.count(), rest.count())
    assert routed.valid + routed.quarantined == len(LINES)
    assert routed.reasons == dict(Counter(x for *_, reasons in LINES for x in reasons)) | {
        r: 0 for r in REASONS if not any(r in reasons for *_, reasons in LINES)}
    assert "PartitionFilters: [isnotnull(route" in explain(valid)


def test_strict_sends_every_reason_to_quarantine(spark, broken_csv):
    got = read_routed(spark, broken_csv, strict=True).collect()
    assert [r.route for r in got] == ["quarantine" if reasons else "valid" for *_, reasons in LINES]
    assert "Exchange" not in explain(read_routed(spark, broken_csv))


def test_quarantine_of_an_empty_file(spark, tmp_dir):
    os.mkdir(f"{tmp_dir}/none")
    open(f"{tmp_dir}/none/a.csv", "w").write(",".join(LOG_COLUMNS) + "\n")
    routed = write_routed(read_routed(spark, f"{tmp_dir}/none"), f"{tmp_dir}/out")
    assert (routed.valid, routed.quarantined) == (0, 0)
