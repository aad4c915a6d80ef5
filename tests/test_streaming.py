"""Streams over several files, one per batch, against the batch results."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.streaming import jobs as ST

START = datetime(2024, 1, 1)
SCHEMA = "id long, status string, total_amount double, created_at timestamp_ntz"


def write_batches(spark, folder, batches):
    known = set((folder / "orders.parquet").glob("*.parquet"))
    for rows in batches:
        df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        df.write.mode("append").parquet(f"{folder}/orders.parquet")
        # Files are taken by modification time, which has to differ between batches.
        for file in (folder / "orders.parquet").glob("*.parquet"):
            if file not in known:
                known.add(file)
                os.utime(file, (1_700_000_000 + 10 * len(known),) * 2)


def run(spark, stream, folder):
    ST.run_available(ST.sink_parquet(stream, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/out").collect()


def order(i, minutes, status="pending", amount=1.0):
    return (i, status, amount, START + timedelta(minutes=minutes))


@pytest.mark.parametrize("spread", [1, 8])
def test_dedup_over_batches(spark, tmp_path, spread):
    hot = [order(7, m) for m in range(50)]
    write_batches(spark, tmp_path, [
        [order(1, 0), order(1, 1), order(2, 2), *hot], [order(1, 30), order(3, 31), *hot], [order(4, 40), order(2, 41)],
    ])
    stream = ST.parquet_stream(spark, str(tmp_path), "orders", files_per_batch=1)
    got = run(spark, ST.dedup_stream(stream, F.sha2(F.col("id").cast("string"), 256), "created_at", "3 hours", spread), tmp_path)
    assert sorted(r.id for r in got) == [1, 2, 3, 4, 7]


def test_windows_over_batches_with_late_rows(spark, tmp_path):
    write_batches(spark, tmp_path, [
        [order(1, 5), order(2, 10, amount=2.5), order(3, 70)],
        [order(4, 55), order(5, 200, "shipped")],
        [order(6, 400)],
        # The batches before have moved the watermark past 02:00, so a row of 00:30 is too late now.
        [order(7, 30), order(8, 410)],
    ])
    stream = ST.parquet_stream(spark, str(tmp_path), "orders", files_per_batch=1)
    got = run(spark, ST.order_windows(stream, "1 hour", "1 hour"), tmp_path)
    assert sorted((r.window_start, r.status, r.order_count, float(r.total_revenue)) for r in got) == [
        (datetime(2024, 1, 1, 0), "pending", 3, 4.5),
        (datetime(2024, 1, 1, 1), "pending", 1, 1.0),
        (datetime(2024, 1, 1, 3), "shipped", 1, 1.0),
    ]


@pytest.mark.parametrize("reach_by", [None, "id"])
def test_sink_skips_what_is_there(spark, tmp_path, reach_by):
    write_batches(spark, tmp_path, [[order(1, 0), order(2, 0)], [order(2, 5), order(3, 5), order(3, 6)]])
    for attempt in range(2):
        stream = ST.parquet_stream(spark, str(tmp_path), "orders", files_per_batch=1)
        ST.run_available(
            ST.sink_if_absent(stream, f"{tmp_path}/out", ["id"], f"{tmp_path}/checkpoint{attempt}", reach_by)
        )
    got = {r.id: r.created_at for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: START, 2: START, 3: START + timedelta(minutes=5)}


def test_a_restarted_stream_goes_on(spark, tmp_path):
    def load():
        stream = ST.parquet_stream(spark, str(tmp_path), "orders")
        unique = ST.dedup_stream(stream, F.sha2(F.col("id").cast("string"), 256), "created_at", "3 hours")
        return sorted(r.id for r in run(spark, unique, tmp_path))

    write_batches(spark, tmp_path, [[order(1, 0), order(2, 0)]])
    assert load() == [1, 2]
    write_batches(spark, tmp_path, [[order(2, 5), order(3, 6)]])
    assert load() == [1, 2, 3]


def test_late_first_records_are_kept(spark, tmp_path):
    write_batches(spark, tmp_path, [[order(1, 0), order(1, 1)], [order(2, 60_000)], [order(3, 2), order(1, 3)], [order(5, 90_000), order(3, 4)]])
    for attempt in range(2):  # the second run goes on from the checkpoint, with nothing new
        stream = ST.parquet_stream(spark, str(tmp_path), "orders", files_per_batch=1)
        ST.run_available(ST.sink_new_records(stream, F.md5(F.col("id").cast("string")), "created_at", f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
        got = spark.read.parquet(f"{tmp_path}/out").collect()
        assert sorted((r.id, r.created_at) for r in got) == [
            (1, START), (2, START + timedelta(minutes=60_000)), (3, START + timedelta(minutes=2)), (5, START + timedelta(minutes=90_000))]


def test_open_windows_are_stored_too(spark, tmp_path):
    write_batches(spark, tmp_path, [[order(1, 5), order(2, 70)], [order(3, 50), order(4, 75, amount=2.0)]])
    stream = ST.parquet_stream(spark, str(tmp_path), "orders", files_per_batch=1)
    ST.run_available(ST.sink_windows(ST.order_windows(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    got = ST.latest_windows(spark, f"{tmp_path}/out", ["status"]).collect()
    assert sorted((r.window_start.hour, r.order_count, float(r.total_revenue)) for r in got) == [(0, 2, 2.0), (1, 2, 3.0)]
