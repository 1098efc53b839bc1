"""Bucketed upserts and the weekly stream."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlens.sources.files import BucketedTable
from cohortlens.streaming import weekly


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_upsert_leaves_other_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    table = BucketedTable(path, ["k"], "v", 16)
    table.create(spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("old").alias("x")))
    before = files_of(path)
    changes = spark.createDataFrame([(5, 2, "new"), (5, 3, "newer"), (99, 0, "stale"), (5000, 1, "added")], "k long, v int, x string")
    touched = table.upsert(changes)
    after = files_of(path)
    assert 1 <= len(touched) <= 3
    untouched = {f: t for f, t in before.items() if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
    assert untouched and all(after.get(f) == t for f, t in untouched.items())
    rows = {r["k"]: (r["v"], r["x"]) for r in table.read(spark).collect()}
    assert len(rows) == 2001 and rows[5] == (3, "newer") and rows[99] == (1, "old") and rows[5000] == (1, "added") and rows[6] == (1, "old")
    assert table.upsert(changes.limit(0)) == [] and files_of(path) == after
    table.upsert(changes)
    assert {r["k"]: (r["v"], r["x"]) for r in table.read(spark).collect()} == rows


def event(i, day, user, kind="view"):
    return (i, dt.datetime(2024, 1, 4) + dt.timedelta(days=day), user, kind, 1.0, "{}")


@pytest.fixture
def folder_of_events(spark, tmp_path):
    """Files in the order of their arrival."""

    def make(batches):
        for i, rows in enumerate(batches):
            path = str(tmp_path / f"part{i}")
            spark.createDataFrame(rows, weekly.EVENTS).coalesce(1).write.parquet(path)
            name = next(f for f in os.listdir(path) if f.endswith(".parquet"))
            os.makedirs(tmp_path / "events", exist_ok=True)
            os.link(os.path.join(path, name), tmp_path / "events" / f"{i:03}.parquet")
            os.utime(tmp_path / "events" / f"{i:03}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
        return str(tmp_path / "events")

    return make


def weeks(table, spark):
    return {(r["student_id"], r["week_start"]): (r["logins"], r["resources_accessed"], r["total_actions"]) for r in table.read(spark).collect()}


def test_late_events_within_the_watermark_count(spark, tmp_path, folder_of_events):
    first = [event(1, 0, 1), event(2, 8, 1, "click"), event(3, 15, 2)]
    late = [event(4, 2, 1), event(5, 20, 2), event(6, 1, 3)]  # 13 and 14 days behind the newest event
    between = [event(9, 20, 4)]
    too_late = [event(7, 3, 1), event(8, 21, 2, "click")]  # week 0 ended more than 10 days before day 20
    path = folder_of_events([first, late, between, too_late])
    table = weekly.new_table(spark, str(tmp_path / "weeks"), 4)
    weekly.keep_weekly(weekly.read_events(spark, path, 1), table, str(tmp_path / "state"), "10 days")
    got = weeks(table, spark)
    start = dt.datetime(2024, 1, 4)
    week = lambda n: start + dt.timedelta(days=7 * n)
    # the mark is day 5 after the first file, so week 0 is open for the second; it is day 10 after the second
    assert got[1, week(0)] == (2, 0, 2) and got[3, week(0)] == (1, 0, 1)
    assert got[1, week(1)] == (0, 1, 1) and got[2, week(2)] == (2, 0, 2) and got[2, week(3)] == (0, 1, 1)
    # nothing new: nothing changes
    weekly.keep_weekly(weekly.read_events(spark, path, 1), table, str(tmp_path / "state"), "10 days")
    assert weeks(table, spark) == got


def test_stream_equals_batch(spark, tmp_path, folder_of_events):
    rows = [event(i, (i * 7) % 30, i % 11, ["view", "click", "error"][i % 3]) for i in range(300)]
    path = folder_of_events([rows[i : i + 75] for i in range(0, 300, 75)])
    table = weekly.new_table(spark, str(tmp_path / "weeks"), 4)
    weekly.keep_weekly(weekly.read_events(spark, path, 1), table, str(tmp_path / "state"), "40 days")
    want = Counter((user, dt.datetime(2024, 1, 4) + dt.timedelta(days=(ts - dt.datetime(2024, 1, 4)).days // 7 * 7)) for _, ts, user, _, _, _ in rows)
    assert {k: v[2] for k, v in weeks(table, spark).items()} == want
