"""The fingerprint store, bitmaps of active users, and bucketed tables."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import dedup as D
from tallyhouse.operators import known as K
from tallyhouse.plans import actives as A
from tallyhouse.plans import users as U
from tallyhouse.sources import entities as E
from tallyhouse.sources.bucketed import bucketed

FOLDER = "/root/testdata/sf0.001"


def prints(spark, numbers):
    return spark.createDataFrame([(i,) for i in numbers], "i long").select(F.md5(F.col("i").cast("string")).alias(D.FINGERPRINT))


@pytest.mark.parametrize("bits", [1 << 22, 1 << 9])  # the second filter is far too full
def test_store_against_sets(spark, tmp_path, bits):
    store, rng, held = K.Store(str(tmp_path), 8, bits), random.Random(3), {}
    assert K.known(prints(spark, [1, 2]), store).count() == 0
    for batch in (0, 1, 1, 2):  # one is replayed
        rng.seed(batch)
        numbers = [rng.randint(0, 3000) for _ in range(700)] + [5] * 300
        K.remember(prints(spark, numbers), store, batch)
        held[batch] = set(numbers)
    asked = list(range(0, 3500, 3)) + [5] * 200
    for before in (None, 2, 1, 0):
        wanted = set().union(*(own for b, own in held.items() if before is None or b < before)) & set(asked)
        got = K.known(prints(spark, asked), store, before)
        assert sorted(got.collect()) == sorted(prints(spark, sorted(wanted)).collect())
    K.remember(prints(spark, []), store, 9)
    assert K.known(prints(spark, []), store).count() == 0


def test_filters_leave_little_to_look_up(spark, tmp_path):
    store = K.Store.sized(str(tmp_path), 5000, 4)
    K.remember(prints(spark, range(5000)), store, 0)
    assert K.maybe_known(prints(spark, range(5000, 25_000)), store).count() < 600
    assert K.maybe_known(prints(spark, range(4000, 6000)), store).count() >= 1000


def test_other_partitions_are_not_opened(spark, tmp_path):
    store = K.Store(str(tmp_path / "store"), 16)
    K.remember(prints(spark, range(1000)), store, 0)
    own = {r[0] for r in prints(spark, [7]).select(store.part()).collect()}
    for table in ("prints", "filters"):
        for file in (tmp_path / "store" / table).rglob("*.parquet"):
            if f"part={min(own)}/" not in str(file):
                file.write_bytes(b"torn")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert K.known(prints(spark, [7]), store).count() == 1
    K.remember(prints(spark, [7]), store, 1)
    with pytest.raises(Exception):
        K.known(prints(spark, range(50)), store).collect()


def people(spark):
    tiers = ["premium", "enterprise", "basic", None]
    return spark.createDataFrame([(i, tiers[i % 4]) for i in range(1, 200)] + [(70_000, "premium"), (1 << 40, "enterprise")], "id long, subscription_tier string")


def seen(rng, n):
    ids = [*range(1, 210), 70_000, 1 << 40]
    return [(rng.choice(ids), datetime(2024, 1, 25) + timedelta(hours=rng.randint(0, 24 * 60))) for _ in range(n)] + [(5, datetime(2024, 2, 1))] * 400


def plain_actives(users, activity, start):
    found = {}
    for user, at in activity:
        if user in users:
            sets = found.setdefault(start(at.date()), (set(), set(), set()))
            sets[0].add(user)
            if users[user] in ("premium", "enterprise"):
                sets[1 if users[user] == "premium" else 2].add(user)
    return sorted((day, *map(len, sets)) for day, sets in found.items())


def test_actives(spark, tmp_path):
    users, rng = people(spark), random.Random(1)
    of = {r.id: r.subscription_tier for r in users.collect()}
    parts = [seen(rng, 300), seen(rng, 200), [(7, datetime(2023, 12, 31, 23)), (None, datetime(2024, 1, 1)), (9, None)]]
    frame = lambda rows: spark.createDataFrame(rows, "user_id long, created_at timestamp_ntz")
    assert A.merge_actives(users, frame([]), str(tmp_path)) == 0
    for part in (0, 2, 1, 1, 0):
        A.merge_actives(users, frame(parts[part]), str(tmp_path))
    stored, activity = spark.read.parquet(str(tmp_path)), [(u, t) for u, t in sum(parts, []) if u and t]
    starts = {"day": lambda d: d, "week": lambda d: d - timedelta(days=d.weekday()), "month": lambda d: d.replace(day=1)}
    for period, start in starts.items():
        got = A.actives(stored, period).select("period_start", "users", "premium_users", "enterprise_users").collect()
        assert sorted(map(tuple, got)) == plain_actives(of, activity, start)


def test_a_user_of_two_tiers_counts_once(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "user_id long, created_at timestamp_ntz")
    for tier, day in (("premium", 1), ("enterprise", 2)):
        users = spark.createDataFrame([(1, tier)], "id long, subscription_tier string")
        A.merge_actives(users, frame([(1, datetime(2024, 1, day))]), str(tmp_path))
    got = A.actives(spark.read.parquet(str(tmp_path)), "month").collect()
    assert [tuple(r) for r in got] == [(date(2024, 1, 1), 1, 1, 1)]


def plan_below_join(df):
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    lines = text.split("\n")
    at = next(i for i, line in enumerate(lines) if "Join" in line)
    return "\n".join(lines[at:])


def test_bucketed_tables_meet_without_a_shuffle(spark):
    users, orders = bucketed(E.users(spark, FOLDER), "id", 4), bucketed(E.orders(spark, FOLDER), "user_id", 4)
    activity = bucketed(E.order_activity(spark, FOLDER), "user_id", 4)
    since = datetime(1990, 1, 1)
    # As for tables too large to be broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        detail, kept = U.segment_members(users, orders, since, "s"), U.retention(users, activity, since, by_user=True)
        plain = U.retention(E.users(spark, FOLDER), E.order_activity(spark, FOLDER), since)
        assert "Exchange" not in plan_below_join(detail)
        # Below the join of cohorts and months; the cohort sizes are shuffled by month afterwards.
        text = kept._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(user_id" not in text and "hashpartitioning(user_id" in plain._jdf.queryExecution().executedPlan().toString()
        assert text.count("SelectedBucketsCount: 4 out of 4") >= 2
        assert kept.collect() == plain.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
