from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import conform as C
from tallyhouse.operators.schemas import FIELDS, fields_of, struct_of

AT = datetime(2024, 1, 15, 10, 30)


def test_schemas_are_complete():
    assert {e for e, _ in FIELDS} == {"user", "activity", "order", "order_item", "payment", "refund", "notification"}
    assert all(len(struct_of(*key)) == len(fields) for key, fields in FIELDS.items())
    assert struct_of("order", 2)["total_amount"].dataType.simpleString() == "decimal(18,2)"
    with pytest.raises(ValueError):
        fields_of("order", 3)


@pytest.mark.parametrize("entity, version", sorted(FIELDS))
def test_every_schema_takes_its_own_rows(spark, entity, version):
    """A row of only required values gets the defaults; publishing shows the marked columns in order."""
    sample = {"long": 1, "int": 2, "string": "x", "timestamp_ntz": AT}
    fields = fields_of(entity, version)
    needed = [f for f in fields if f.required]
    row = tuple(f.allowed[0] if f.allowed else sample[f.kind] for f in needed)
    df = spark.createDataFrame([row], ", ".join(f"{f.name} {f.kind}" for f in needed))
    valid, rejected = C.conform(df, entity, version)
    assert valid.schema.simpleString() == struct_of(entity, version).simpleString()
    assert rejected.count() == 0
    out = valid.collect()[0]
    for f in fields:
        if not f.required:
            assert (None if out[f.name] is None else str(out[f.name])) == (None if f.default is None else str(f.default))
    shown = C.publish(valid, entity, version, "salt").columns
    expected = [f.name for f in fields if f.publish]
    if (entity, version) == ("user", 1):
        expected = [f"{c}_token" if c in ("email", "phone", "name") else c for c in expected]
    assert shown == expected


def test_users_outside_the_tiers_are_rejected(spark):
    rows = [(1, "usr_1", "active", "gold"), (2, "usr_2", "inactive", "basic"), (3, "usr_3", None, None), (None, "u", "new", "free")]
    df = spark.createDataFrame(rows, "id long, user_token string, status string, subscription_tier string")
    valid, rejected = C.conform(df, "user", 2)
    assert {(r.id, r.status, r.subscription_tier) for r in valid.collect()} == {(2, "inactive", "basic"), (3, "active", "free")}
    reasons = {r.user_token: r.reject_reasons for r in rejected.collect()}
    assert reasons == {
        "usr_1": ["subscription_tier: unknown value"], "u": ["id: required", "status: unknown value"]
    }


def test_unreadable_money_is_rejected(spark):
    df = spark.createDataFrame([(1, 1, 1, "12.345"), (2, 1, 1, "abc"), (3, 1, 1, None)], "id long, payment_id long, order_id long, amount string")
    valid, rejected = C.conform(df, "refund", 2)
    assert {(r.id, str(r.amount)) for r in valid.collect()} == {(1, "12.35"), (3, "0.00")}
    assert [(r.id, r.reject_reasons) for r in rejected.collect()] == [(2, ["amount: not a decimal(18,2)"])]
    assert {(r.id, r.amount) for r in C.conform(df, "refund", 1).valid.collect()} == {(1, 12.345), (3, 0.0)}


def test_values_of_another_type(spark):
    df = spark.createDataFrame([("1", 7, "2024-01-15 10:30:00"), ("x", None, "soon")], "id string, status int, created_at string")
    df = df.selectExpr("*", "id AS payment_id", "id AS order_id", "id AS user_id", "'t' AS user_token", "'n' AS order_number")
    refunds = C.conform(df, "refund", 1)
    assert [(r.id, r.status, r.created_at) for r in refunds.valid.collect()] == [(1, "7", AT)]
    orders = C.conform(df, "order", 2)
    assert {tuple(r.reject_reasons) for r in orders.rejected.collect()} == {
        ("status: unknown value",),
        ("id: not a long", "user_id: not a long", "created_at: not a timestamp_ntz"),
    }


def test_missing_required_column_rejects_all(spark):
    valid, rejected = C.conform(spark.createDataFrame([(1,)], "id long"), "activity", 1)
    assert valid.count() == 0
    assert rejected.collect()[0].reject_reasons == ["user_id: required", "activity_type: required"]


def test_publishing_contact_data_needs_a_salt(spark):
    valid = C.conform(spark.createDataFrame([(1, "a@b.c")], "id long, email string"), "user", 1).valid
    with pytest.raises(ValueError):
        C.publish(valid, "user", 1)
    assert "a@b.c" not in str(C.publish(valid, "user", 1, "s").collect())


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 2, 'b.c', named_struct('d', 3)) AS s, array(4) AS l")
    assert C.flatten(df).columns == ["id", "s_a", "s_b.c_d", "l"]
    assert C.flatten(df, ".").collect()[0]["s.a"] == 2


def test_completeness(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "id long, v string")
    report = {r.field: (r.passed, r.failed) for r in C.completeness_report(df, ["id", "v", "gone"]).collect()}
    assert report == {"id": (2, 1), "v": (1, 2), "gone": (0, 3), "(all)": (0, 3)}
    lacking = df.select(C.missing_fields(df, ["id", "v", "gone"])).collect()
    assert [r[0] for r in lacking] == [["gone"], ["gone", "v"], ["gone", "id", "v"]]
    assert df.filter(C.is_complete(df, ["id", "v"])).count() == 1


def test_value_or(spark):
    df = spark.createDataFrame([(1,), (None,)], "a long")
    assert [r[0] for r in df.select(C.value_or(df, "a", F.lit(7))).collect()] == [1, 7]
    assert [r[0] for r in df.select(C.value_or(df, "b", F.lit(7))).collect()] == [7, 7]
