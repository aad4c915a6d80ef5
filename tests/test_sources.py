from datetime import datetime

import pytest

from tallyhouse.functions.time import Span
from tallyhouse.sources import lookups as L
from tallyhouse.sources import tables as T


def test_database_reads_are_split():
    options = T.jdbc_options("jdbc:x", "orders_v2", "id", 0, 10**9, 400)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "400"
    assert options["dbtable"] == "orders_v2" and options["upperBound"] == "1000000000"
    with pytest.raises(ValueError):
        T.jdbc_options("jdbc:x", "orders_v2", "", 0, 1, 4)


def test_sql_parameters_are_values(spark):
    df = spark.createDataFrame(
        [(1, "a", datetime(2024, 1, 1)), (2, "b' OR '1'='1", datetime(2024, 1, 2)), (3, "c", datetime(2024, 1, 3))],
        "id long, v string, at timestamp_ntz",
    )
    text = "SELECT id FROM {t} WHERE v = :v"
    assert [r.id for r in T.run_sql(spark, text, {"v": "b' OR '1'='1"}, t=df).collect()] == [2]
    ranged = T.run_sql(
        spark, "SELECT id FROM {t} WHERE at >= :start AND at < :end AND array_contains(:ids, id)",
        {"start": datetime(2024, 1, 1), "end": datetime(2024, 1, 3), "ids": [1, 3]}, t=df,
    )
    assert [r.id for r in ranged.collect()] == [1]
    assert T.run_sql(spark, "SELECT * FROM {t}", t=df).count() == 3


def test_sql_times_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS at").write.parquet(path)
    df = T.run_sql(spark, "SELECT id FROM {t} WHERE at >= :s", {"s": datetime(2023, 1, 1)}, t=spark.read.parquet(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at,2023-01-01T00:00)" in plan


def test_select_where(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "id long, v string, n int")
    assert T.select_where(df, ["v"], {"id": "2"}).collect()[0].v == "b"
    assert T.select_where(df, ["id"], {"n": None}).collect()[0].id == 1
    assert T.select_where(df, ["id", "v"]).count() == 2
    for columns, equals in ((["nope"], {}), (["id"], {"nope": 1}), (["id; DROP TABLE x"], {})):
        with pytest.raises(ValueError):
            T.select_where(df, columns, equals)


def test_search_is_literal_and_bounded(spark):
    rows = [(i, f"u{i}@x.y", "100%" if i % 2 else "100x", datetime(2024, 1, 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, email string, name string, created_at timestamp_ntz")
    found = [r.id for r in L.search_users(df, "0%").collect()]
    assert found == list(range(1, 200, 2))
    assert [r.id for r in L.search_users(df, "u7@").collect()] == [7]
    assert L.search_users(df, "U7@").count() == 0


def test_latest_activity_is_a_top_k(spark):
    rows = [(i, 1, "login", "", datetime(2024, 1, 1, 0, 0, i % 60)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, user_id long, activity_type string, metadata string, created_at timestamp_ntz")
    got = L.latest_activity(df, 1, "login")
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()
    expected = sorted(rows, key=lambda r: (r[4], r[0]), reverse=True)[:1000]
    assert [r.id for r in got.collect()] == [r[0] for r in expected]


def test_payment_stats(spark):
    rows = [("m", 10.0, "success", datetime(2024, 1, 1)), ("m", 5.01, "failed", datetime(2024, 1, 2)), ("n", 1.0, "pending", datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "merchant_id string, amount double, status string, created_at timestamp_ntz")
    span = Span(datetime(2024, 1, 1), datetime(2024, 1, 3))
    one = L.payment_stats(df, span, "m").collect()
    assert [(r.total_transactions, str(r.total_amount), str(r.avg_amount), r.successful, r.failed) for r in one] == [
        (2, "15.01", "7.505000", 1, 1)
    ]
    nothing = L.payment_stats(df, Span(datetime(2020, 1, 1), datetime(2020, 1, 2)), "m").collect()
    assert [(r.total_transactions, r.total_amount) for r in nothing] == [(0, None)]
    assert L.payment_stats(df, span).count() == 2


def test_range_is_half_open_and_ordered(spark):
    rows = [(1, datetime(2024, 1, 3)), (2, datetime(2024, 1, 1)), (3, datetime(2024, 1, 2))]
    df = spark.createDataFrame(
        [(i, "e", "n", at, at, "active") for i, at in rows],
        "id long, email string, name string, created_at timestamp_ntz, last_login_at timestamp_ntz, status string",
    )
    got = L.users_between(df, Span(datetime(2024, 1, 1), datetime(2024, 1, 3)))
    assert [r.id for r in got.collect()] == [2, 3]
