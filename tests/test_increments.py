"""One-pass backfill against the loop, and tables that take in late rows."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.time import Span
from tallyhouse.operators import merge as M
from tallyhouse.plans import backfill as B
from tallyhouse.plans import increments as I
from tallyhouse.plans import jobs as J
from tallyhouse.plans import orders as O
from tallyhouse.sources import entities as E
from tallyhouse.streaming import jobs as ST

FOLDER = "/root/testdata/sf0.001"
AS_OF = datetime(2002, 1, 1)
SPAN = Span(datetime(1996, 1, 1), datetime(1996, 2, 10))


def rows(spark, path, drop=()):
    df = spark.read.parquet(path)
    df = df.select(sorted(set(df.columns) - set(drop)))
    return sorted(map(tuple, df.collect()), key=repr)


def outcome(s):
    return (s.job_name, s.status, s.records_extracted, s.records_transformed, s.records_loaded, s.records_processed,
            s.records_skipped, s.records_failed, s.window_start, s.window_end, s.errors)


def makers(spark):
    users = E.users(spark, FOLDER)
    # One token registers twice, in different weeks, and some users have no token.
    again = users.withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 9 DAYS"))
    users = users.unionByName(again).withColumn("user_token", F.when(F.col("id") % 9 != 0, F.col("user_token")))
    payments = E.payments(spark, FOLDER).withColumn("payment_method", F.nullif("payment_method", F.lit("paypal")))
    events = E.notifications(spark, FOLDER)
    return {
        "user_analytics": (lambda s: J.user_job(users, s, AS_OF), Span(datetime(1994, 1, 1), datetime(2002, 1, 3, 5)), 200),
        "order_analytics": (lambda s: J.order_job(E.orders(spark, FOLDER), s), SPAN, 7),
        "payment_analytics": (lambda s: J.payment_job(payments, s, salt="x"), SPAN, 9),
        "notification_analytics": (lambda s: J.notification_job(events, s), Span(datetime(2024, 1, 1), datetime(2024, 2, 1)), 8),
    }


@pytest.mark.parametrize("name", ["user_analytics", "order_analytics", "payment_analytics", "notification_analytics"])
def test_one_pass_equals_the_loop(spark, tmp_path, name):
    make, span, days = makers(spark)[name]
    loop, once = str(tmp_path / "loop"), str(tmp_path / "once")
    wanted = J.run_backfill(make, span, loop, days, name=name)
    for _ in range(2):  # the second time everything is there already
        got = B.backfill_at_once(make, span, once, days, name)
        assert list(map(outcome, got)) == list(map(outcome, wanted))
        assert sorted(os.listdir(once)) == sorted(os.listdir(loop))
        for table in os.listdir(loop):
            assert rows(spark, f"{once}/{table}") == rows(spark, f"{loop}/{table}")
        wanted = J.run_backfill(make, span, loop, days, name=name)
    assert sum(s.records_extracted for s in got) > 0 and sum(s.records_loaded for s in got) == 0


def test_the_source_is_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def watched(status):
        seen.add(1)
        return status

    orders = E.orders(spark, FOLDER)
    source = orders.withColumn("status", watched("status"))
    inside = orders.where(SPAN.holds(F.col("created_at"))).count()
    B.backfill_at_once(lambda s: J.order_job(source, s), SPAN, str(tmp_path), 7)
    assert inside <= seen.value <= orders.count()


def test_damaged_pieces_are_reported_and_the_others_loaded(spark, tmp_path):
    orders = E.orders(spark, FOLDER)
    bad = [datetime(1996, 1, 9), datetime(1996, 2, 1)]
    # A row that cannot be computed fails every plan that holds it.
    torn = orders.withColumn("status", F.when(
        F.to_date("created_at") == F.lit(bad[0].date()), F.raise_error(F.lit("torn page")).cast("string")).otherwise(F.col("status")))
    torn = torn.unionByName(orders.limit(1).withColumns({
        "created_at": F.lit(bad[0]).cast("timestamp_ntz"), "status": F.raise_error(F.lit("torn page")).cast("string")}))
    passes = []

    def make(span):
        passes.append(span)
        if span.covers(bad[1]):
            raise ValueError("no source")
        return J.order_job(torn, span)

    done = B.backfill_at_once(make, SPAN, str(tmp_path), 7, "order_analytics")
    assert [s.status for s in done] == ["success", "failed", "success", "success", "failed", "success"]
    assert [(s.window_start, s.window_end) for s in done] == [(p.start, p.end) for p in SPAN.chunks(7)]
    assert "torn page" in done[1].errors[0] and done[4].errors == ["no source"] and len(passes) <= 2 * len(done)
    left = [p for i, p in enumerate(SPAN.chunks(7)) if i not in (1, 4)]
    wanted = O.order_metrics(O.daily_orders(orders, SPAN)).collect()
    wanted = [r for r in wanted if any(p.covers(datetime.combine(r.order_date, datetime.min.time())) for p in left)]
    loaded = spark.read.parquet(f"{tmp_path}/order_analytics").collect()
    assert sorted(map(tuple, loaded)) == sorted(map(tuple, wanted))


def test_a_span_without_pieces_or_with_cut_days(spark, tmp_path):
    orders = E.orders(spark, FOLDER)
    assert B.backfill_at_once(lambda s: J.order_job(orders, s), Span(SPAN.start, SPAN.start), str(tmp_path)) == []
    half = Span(datetime(1996, 1, 1, 12), datetime(1996, 1, 20))
    done = B.backfill_at_once(lambda s: J.order_job(orders, s), half, str(tmp_path), name="order_analytics")
    assert {s.status for s in done} == {"failed"} and len(done) == 3 and list(tmp_path.iterdir()) == []


DAILY = {
    "orders": (I.ORDERS, E.orders, "created_at"), "payments": (I.PAYMENTS, E.payments, "created_at"),
    "notifications": (I.NOTIFICATIONS, E.notifications, "sent_at"),
}


@pytest.mark.parametrize("kind", sorted(DAILY))
def test_batches_add_up(spark, tmp_path, kind):
    increment, source, at = DAILY[kind]
    df = source(spark, FOLDER)
    second = increment.keys[1]
    df = df.withColumn(second, F.when(F.col("id") % 11 != 0, F.col(second)))  # some rows have no key
    df = df.unionByName(df.limit(5).withColumn(at, F.lit(None).cast("timestamp_ntz")))  # and some no time
    thirds = [df.where(F.col("id") % 3 == i) for i in range(3)]
    once = I.merge_rows(increment, df, str(tmp_path / "once"), 0)
    for batch in (0, 2, 1, 2, 0):
        done = I.merge_rows(increment, thirds[batch], str(tmp_path / "parts"), batch)
    assert done.months > 0 and once.rejected > 0 or kind != "payments"
    for table in os.listdir(tmp_path / "once"):
        if not table.endswith("_parts"):
            assert rows(spark, f"{tmp_path}/parts/{table}") == rows(spark, f"{tmp_path}/once/{table}")
    assert I.merge_rows(increment, df.limit(0), str(tmp_path / "parts"), 9).months == 0


def test_only_touched_months_are_read_and_replaced(spark, tmp_path):
    orders = E.orders(spark, FOLDER).where("status = 'pending'")
    I.merge_rows(I.ORDERS, orders, str(tmp_path), 0)
    files = lambda: {str(p) for p in (tmp_path / "order_analytics").rglob("*.parquet")}
    before = files()
    late = orders.limit(3).withColumn("created_at", F.lit(datetime(1996, 3, 5)).cast("timestamp_ntz"))
    done = I.merge_rows(I.ORDERS, late, str(tmp_path), 1)
    assert done.months == 1 and {p.split("/")[-2] for p in before ^ files()} == {"month=1996-03-01"}
    stored = M.rows_of(spark.read.parquet(f"{tmp_path}/order_analytics_parts"), "month", [date(1996, 3, 1)])
    assert all("month=1996-03-01" in f for f in stored.inputFiles()) or "month#" in stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in stored._jdf.queryExecution().toString() and "PartitionFilters: []" not in stored._jdf.queryExecution().toString()


def test_least_records_move_between_periods(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "token string, at date, name string, month date"
    jan, feb, mar = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
    frame = lambda data: spark.createDataFrame([(t, d, n, d) for t, d, n in data], schema)
    assert M.merge_least(frame([]), path, ["token"], "month") == 0
    batches = [
        [("a", feb, "x"), ("b", feb, "x"), ("b", feb, "w"), ("c", mar, "x")],
        [("c", jan, "y"), ("a", mar, "z"), ("d", mar, "q")],
        [("d", feb, "q")],  # the last record of March moves
    ]
    for data in [*batches, batches[0], batches[2]]:
        M.merge_least(frame(data), path, ["token"], "month")
    M.merge_least(frame(sum(batches, [])), str(tmp_path / "once"), ["token"], "month")
    assert rows(spark, path) == rows(spark, str(tmp_path / "once"))
    assert sorted((r.token, r.at, r.name) for r in spark.read.parquet(path).collect()) == [("a", feb, "x"), ("b", feb, "w"), ("c", jan, "y"), ("d", feb, "q")]
    assert not (tmp_path / "t" / "month=2024-03-01").exists()


def test_users_in_two_halves(spark, tmp_path):
    make, _, _ = makers(spark)["user_analytics"]
    users = make(Span(datetime(1900, 1, 1), datetime(2100, 1, 1))).extract
    for part in (users.where("id % 2 = 0"), users.where("id % 2 = 1"), users.where("id % 2 = 0")):
        I.merge_users(part, str(tmp_path / "halves"), AS_OF)
    J.run_job(make(Span(datetime(1900, 1, 1), datetime(2100, 1, 1))), str(tmp_path / "once"))
    assert rows(spark, f"{tmp_path}/halves/user_analytics", ["month"]) == rows(spark, f"{tmp_path}/once/user_analytics")


def test_late_rows_of_a_stream(spark, tmp_path):
    day = datetime(2024, 1, 31, 23)
    batches = [[(1, day, 1.0), (2, day, 2.0)], [(3, day + timedelta(days=40), 4.0)], [(4, day, 0.5), (5, day - timedelta(days=300), 8.0)]]
    for i, batch in enumerate(batches):
        spark.createDataFrame([(k, t, "pending", a) for k, t, a in batch], "id long, created_at timestamp_ntz, status string, total_amount double") \
            .coalesce(1).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    for _ in range(2):
        stream = ST.parquet_stream(spark, str(tmp_path), "orders", files_per_batch=1)
        ST.run_available(I.sink_merged(stream, I.ORDERS, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
        got = spark.read.parquet(f"{tmp_path}/out/order_analytics").collect()
        assert sorted((r.order_date, r.order_count, r.total_revenue, r.avg_order_value) for r in got) == [
            (date(2023, 4, 6), 1, "8.00", "8.000000"), (date(2024, 1, 31), 3, "3.50", "1.166667"), (date(2024, 3, 11), 1, "4.00", "4.000000")]
