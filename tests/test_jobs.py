"""Loading, jobs and backfills against real folders."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.time import Span
from tallyhouse.operators.load import absent_rows, append_if_absent, database_sink_options, existing, range_of, without_key
from tallyhouse.plans import jobs as J
from tallyhouse.plans import orders as O
from tallyhouse.sources import entities as E

FOLDER = "/root/testdata/sf0.001"
YEARS = Span(datetime(1995, 1, 1), datetime(2002, 1, 1))
SCHEMA = "day string, kind string, n long"


def stored(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("day", "kind", "n").collect())


def test_only_absent_keys_are_added(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("d1", "a", 1), ("d1", "b", 2), ("d1", "a", 9)], SCHEMA)
    assert existing(spark, path) is None
    assert append_if_absent(first, path, ["day", "kind"]) == 2
    second = spark.createDataFrame([("d1", "a", 5), ("d2", "a", 3)], SCHEMA)
    assert append_if_absent(second, path, ["day", "kind"]) == 1
    assert append_if_absent(second, path, ["day", "kind"]) == 0
    assert stored(spark, path) == [("d1", "a", 1), ("d1", "b", 2), ("d2", "a", 3)]


def test_empty_input_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append_if_absent(spark.createDataFrame([], SCHEMA), path, ["day"]) == 0
    rows = spark.createDataFrame([(None, "a", 1), (None, "b", 2), ("d", "c", 3)], SCHEMA)
    assert append_if_absent(rows, path, ["day"]) == 1
    assert append_if_absent(rows, path, ["day"]) == 0
    assert sorted(r.kind for r in without_key(rows, ["day"]).collect()) == ["a", "b"]


def test_users_without_a_key_are_counted_and_kept_aside(spark, tmp_path):
    at, later = datetime(1996, 1, 1), datetime(1997, 1, 1)
    users = E.users(spark, FOLDER).limit(3).withColumn("created_at", F.lit(at).cast("timestamp_ntz")).withColumn(
        "user_token", F.when(F.col("id") % 2 == 0, F.col("user_token")))
    users = spark.createDataFrame(users.collect(), users.schema)
    keyless = users.filter("user_token IS NULL").count()
    done = J.run_job(J.user_job(users, YEARS, later), str(tmp_path))
    assert (done.records_loaded, done.records_failed) == (3 - keyless, keyless)
    assert spark.read.parquet(f"{tmp_path}/user_analytics_rejects").count() == keyless
    # The same tokens with another registration date are there already.
    moved = users.withColumn("created_at", F.lit(later).cast("timestamp_ntz"))
    again = J.run_job(J.user_job(moved, Span(later, datetime(1998, 1, 1)), later), str(tmp_path))
    assert again.records_loaded == 0
    assert spark.read.parquet(f"{tmp_path}/user_analytics").groupBy("user_token").count().filter("count > 1").count() == 0


def test_a_span_that_cuts_a_day_is_refused(spark, tmp_path):
    half = Span(datetime(1995, 1, 1, 12), datetime(1995, 1, 20))
    for make in (lambda s: J.order_job(E.orders(spark, FOLDER), s), lambda s: J.payment_job(E.payments(spark, FOLDER), s, salt="x"),
                 lambda s: J.notification_job(E.notifications(spark, FOLDER), s)):
        with pytest.raises(ValueError, match="whole days"):
            make(half)
    done = J.run_backfill(lambda s: J.order_job(E.orders(spark, FOLDER), s), half, str(tmp_path), name="order_analytics")
    assert {s.status for s in done} == {"failed"} and {s.job_name for s in done} == {"order_analytics"}
    assert done[0].window_start == half.start and done[0].start_time is not None
    assert list(tmp_path.iterdir()) == []


def test_leftovers_of_a_broken_write_do_not_count(spark, tmp_path):
    (tmp_path / "t" / "_temporary").mkdir(parents=True)
    path = str(tmp_path / "t")
    assert existing(spark, path) is None
    assert append_if_absent(spark.createDataFrame([("d", "a", 1)], SCHEMA), path, ["day"]) == 1


def test_partitioned_table_with_number_like_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("01", "a", 1), ("2", "b", 2)], SCHEMA)
    assert append_if_absent(rows, path, ["day"], partition_by=["kind"]) == 2
    more = spark.createDataFrame([("01", "a", 1), ("3", "c", 2)], SCHEMA)
    assert append_if_absent(more, path, ["day"], partition_by=["kind"], reach=F.col("kind") <= "c") == 1


def test_reach_prunes_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(f"d{i}", "a", i) for i in range(5)], SCHEMA)
    append_if_absent(rows, path, ["day"], partition_by=["day"])
    plan = absent_rows(rows, spark.read.parquet(path), ["day"], F.col("day") == "d3")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text
    assert plan.count() == 4


def test_range_of_a_batch(spark):
    days = [datetime(2024, 1, d, 1, 2, 3, 456789) for d in (1, 3, 2)]
    df = spark.createDataFrame([(d,) for d in days], "at timestamp_ntz")
    wide = spark.createDataFrame([(d,) for d in days + [datetime(2023, 1, 1), None]], "at timestamp_ntz")
    assert sorted(r.at for r in wide.filter(range_of(df, "at")).collect()) == sorted(days)
    assert wide.filter(range_of(wide, "at")).count() == 5
    assert wide.filter(range_of(wide.limit(0), "at")).count() == 0
    zoned = wide.selectExpr("CAST(at AS TIMESTAMP) AS at")
    assert zoned.filter(range_of(zoned.filter("at >= TIMESTAMP'2024-01-01'"), "at")).count() == 3


def test_database_writes_are_bounded():
    assert database_sink_options("jdbc:x", "t", connections=4) == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "1000", "numPartitions": "4"
    }


def make_jobs(spark):
    sources = {
        "users": E.users(spark, FOLDER), "orders": E.orders(spark, FOLDER), "payments": E.payments(spark, FOLDER),
        "notifications": E.notifications(spark, FOLDER),
    }
    return J.all_jobs(sources, Span(datetime(1995, 1, 1), datetime(2025, 1, 1)), datetime(2001, 8, 1), "s")


def test_jobs_load_once(spark, tmp_path):
    warehouse = str(tmp_path)
    first = J.run_jobs(make_jobs(spark), warehouse)
    again = J.run_jobs(make_jobs(spark), warehouse)
    assert [s.status for s in first + again] == ["success"] * 8
    for one, two in zip(first, again):
        assert one.records_loaded == one.records_transformed == one.records_extracted > 0
        assert (two.records_loaded, two.records_skipped) == (0, one.records_loaded)
        assert spark.read.parquet(f"{warehouse}/{one.job_name}").count() == one.records_loaded
    assert spark.read.parquet(f"{warehouse}/channel_analytics").count() == 3
    assert "card" not in " ".join(spark.read.parquet(f"{warehouse}/payment_analytics").columns)


def test_dry_run_writes_nothing(spark, tmp_path):
    done = J.run_jobs(make_jobs(spark), str(tmp_path), dry_run=True)
    assert all(s.status == "success" and s.records_loaded == s.records_transformed > 0 for s in done)
    assert list(tmp_path.iterdir()) == []


def test_version_1_jobs(spark, tmp_path):
    jobs = [
        J.user_job(E.users(spark, FOLDER), YEARS, datetime(2001, 8, 1), version=1),
        J.order_job(E.orders(spark, FOLDER), YEARS, ["shipped"], version=1),
        J.payment_job(E.payments(spark, FOLDER), YEARS, pii_mode="mask"),
    ]
    done = J.run_jobs(jobs, str(tmp_path))
    assert [s.status for s in done] == ["success"] * 3
    assert spark.read.parquet(f"{tmp_path}/order_analytics").schema["total_revenue"].dataType.simpleString() == "double"
    assert "user_id" in spark.read.parquet(f"{tmp_path}/user_analytics").columns


def test_a_failing_job_does_not_stop_the_others(spark, tmp_path):
    jobs = make_jobs(spark)
    jobs["payment_analytics"] = lambda: J.payment_job(E.payments(spark, FOLDER), YEARS)
    done = {s.job_name: s for s in J.run_jobs(jobs, str(tmp_path), dry_run=True)}
    assert done["payment_analytics"].status == "failed" and "salt" in done["payment_analytics"].errors[0]
    assert [s.status for s in done.values()].count("success") == 3
    frame = J.summary_frame(spark, list(done.values()))
    assert {r.job_name: r.error_count for r in frame.collect()}["payment_analytics"] == 1
    assert frame.filter("status = 'success' AND records_per_second > 0").count() == 3


def test_failed_write_fails_the_run(spark, tmp_path):
    (tmp_path / "order_analytics").write_text("not a folder")
    done = J.run_jobs({"order_analytics": make_jobs(spark)["order_analytics"]}, str(tmp_path))
    assert done[0].status == "failed" and done[0].records_loaded == 0


def test_backfill_equals_one_run(spark, tmp_path):
    span = Span(datetime(1995, 1, 1), datetime(1995, 2, 20))
    orders = E.orders(spark, FOLDER)
    done = J.run_backfill(lambda s: J.order_job(orders, s), span, str(tmp_path), days=14)
    assert len(done) == 4 and {s.status for s in done} == {"success"}
    whole = O.order_metrics(O.daily_orders(orders, span))
    loaded = spark.read.parquet(f"{tmp_path}/order_analytics")
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, whole.collect()))
    repeated = J.run_backfill(lambda s: J.order_job(orders, s), span, str(tmp_path), days=14)
    assert sum(s.records_loaded for s in repeated) == 0


def test_backfill_goes_on_after_a_broken_piece(spark, tmp_path):
    orders = E.orders(spark, FOLDER)

    def make(span):
        if span.start == datetime(1995, 1, 8):
            raise RuntimeError("no source")
        return J.order_job(orders, span)

    done = J.run_backfill(make, Span(datetime(1995, 1, 1), datetime(1995, 1, 22)), str(tmp_path), days=7)
    assert [s.status for s in done] == ["success", "failed", "success"]
    assert done[1].errors == ["no source"]


@pytest.mark.parametrize("days", [1, 7, 100])
def test_chunks_in_one_pass(spark, days):
    span = Span(datetime(1995, 1, 3, 12), datetime(1995, 3, 5, 6))
    orders = E.orders(spark, FOLDER)
    got = {r.chunk: (r.chunk_start, r.chunk_end, r.rows) for r in J.backfill_chunks(orders, "created_at", span, days).collect()}
    expected = {}
    for i, piece in enumerate(span.chunks(days)):
        n = orders.filter(piece.holds(F.col("created_at"))).count()
        if n:
            expected[i] = (piece.start, piece.end, n)
    assert got == expected
