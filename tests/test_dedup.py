"""Fingerprints and duplicates, with hot groups checked against brute force."""

import hashlib
from collections import defaultdict
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import dedup as D
from tallyhouse.operators import fingerprints as FP
from tallyhouse.operators.firsts import first_per_key

# A third of all rows share one value; the others repeat a little or not at all.
HOT = [(i, "hot" if i % 3 == 0 else f"v{i % 701}") for i in range(3000)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(HOT, "id long, value string").repartition(7)


def groups():
    found = defaultdict(list)
    for i, value in HOT:
        found[value].append(i)
    return found


def prints(df, **more):
    return [r[0] for r in df.select(FP.record_fingerprint(df, **more)).collect()]


def test_fingerprint_ignores_column_order(spark):
    one = spark.createDataFrame([(1, 2, 3)], "a long, b long, c long")
    assert prints(one) == prints(one.select("c", "a", "b"))
    assert len(prints(one)[0]) == 64 and len(prints(one, algorithm="md5")[0]) == 32


def test_fingerprint_sees_values_nulls_and_nesting(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (2, None), (1, None)], "a long, b string")
    first, second, third, fourth = prints(df)
    assert first == fourth and len({first, second, third}) == 3
    nested = spark.sql("SELECT 1 AS id, named_struct('b', 1, 'a', named_struct('d', true)) AS m")
    turned = spark.sql("SELECT named_struct('a', named_struct('d', true), 'b', 1) AS m, 1 AS id")
    assert prints(nested) == prints(turned)


def test_field_fingerprint(spark):
    df = spark.createDataFrame([(1, "x", None)], "id long, email string, name string")
    def of(fields, algorithm="sha256"):
        return df.select(FP.field_fingerprint(df, fields, algorithm)).collect()[0][0]
    assert of(["email", "id"]) == of(["id", "email"])
    assert len(of(["id"], "md5")) == 32 and len(of(["id", "absent"])) == 64
    assert of(["id", "absent"]) != of(["id", "name"])
    with pytest.raises(ValueError):
        FP.field_fingerprint(df, ["id"], "crc")


def test_field_fingerprint_of_typed_values(spark):
    """The digest is that of the values' plain text, sorted by name, with | between them."""
    rows = [
        (1, True, datetime(2024, 1, 2, 3, 4, 5), Decimal("1.50"), "é"),
        (-2, False, datetime(2024, 1, 2, 3, 4, 5, 600), Decimal("0.00"), ""),
        (3, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "n long, flag boolean, at timestamp_ntz, cost decimal(9,2), word string")
    got = [r[0] for r in df.select(FP.field_fingerprint(df, df.columns)).collect()]
    texts = [[str(v) for _, v in sorted(zip(df.columns, row))] for row in rows]
    assert got == [hashlib.sha256("|".join(t).encode()).hexdigest() for t in texts]


def test_identity_hash_normalises(spark):
    df = spark.createDataFrame(
        [("TEST@Test.Com ", " 1", "JOHN DOE"), ("test@test.com", "1", "john doe"), (None, None, None), ("", "", "")],
        "e string, p string, n string",
    )
    a, b, c, d = (r[0] for r in df.select(FP.identity_hash(F.col("e"), F.col("p"), F.col("n"))).collect())
    assert a == b and c == d and a != c


@pytest.mark.parametrize("ids, expected", [
    ([1, 2, 1, 3, 2], 3), ([], 0), ([1, 2, 3], 3), ([5, 5, 5], 1),
])
def test_distinct_records(spark, ids, expected):
    df = spark.createDataFrame([(i, f"n{i}") for i in ids], "id long, name string")
    assert D.distinct_records(df).count() == expected


def test_first_per_fingerprint(spark, rows):
    got = D.first_per_fingerprint(rows, F.md5("value"), "id").collect()
    assert {(r.id, r.value) for r in got} == {(ids[0], value) for value, ids in groups().items()}
    assert len(got) == len(groups())


def test_first_per_fingerprint_when_joins_are_shuffled(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_first_per_fingerprint(spark, rows)
        test_a_row_for_each_member_whatever_the_size(spark, rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_per_key_breaks_ties(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", 2, "0"), (None, 9, "n")], "k string, o long, v string")
    got = first_per_key(df, ["k"], ["o"])
    assert got.columns == ["k", "o", "v"]
    assert {tuple(r) for r in got.collect()} == {("k", 1, "a"), (None, 9, "n")}


def test_first_seen_order(spark):
    df = spark.createDataFrame([(0, "Charlie"), (1, "Alice"), (2, "Bob"), (3, "Alice")], "at long, name string")
    got = D.first_per_fingerprint(df, F.md5("name"), "at").orderBy("at")
    assert [r.name for r in got.collect()] == ["Charlie", "Alice", "Bob"]


def test_mark_new(spark, rows):
    seen = D.fingerprint_table(rows.filter("value = 'v1'"), F.md5("value"))
    first = {ids[0] for value, ids in groups().items() if value != "v1"}
    got = D.mark_new(rows, F.md5("value"), "id", seen).collect()
    assert len(got) == len(HOT)
    assert {r.id for r in got if r.is_new} == first
    everything = D.mark_new(rows, F.md5("value"), "id").filter("is_new").count()
    assert everything == len(groups())


def test_missing_fingerprints_count_as_equal(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id long, value string")
    marked = D.mark_new(df, F.md5("value"), "id").orderBy("id").collect()
    assert [r.is_new for r in marked] == [True, False, True]
    assert D.first_per_fingerprint(df, F.md5("value"), "id").count() == 2


def test_known_and_new_records(spark, rows):
    seen = D.fingerprint_table(rows.filter("value IN ('hot', 'v2')"), F.md5("value"))
    known = {i for i, value in HOT if value in ("hot", "v2")}
    assert {r.id for r in D.known_records(rows, F.md5("value"), seen).collect()} == known
    new = D.new_records(rows, F.md5("value"), "id", seen).collect()
    assert {r.id for r in new} == {ids[0] for value, ids in groups().items() if value not in ("hot", "v2")}


def test_a_row_for_each_member_whatever_the_size(spark, rows):
    members = D.duplicate_members(rows, F.col("value"), "id", "key")
    wanted = {value: ids for value, ids in groups().items() if len(ids) > 1}
    assert sorted((r.key, r.duplicate_id, r.duplicate_count) for r in members.collect()) == sorted(
        (value, i, len(ids)) for value, ids in wanted.items() for i in ids)
    assert {r.key: r.duplicate_ids for r in D.listed(members, "key").collect()} == wanted


def test_groups_as_text(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None)], "id long, value string")
    got = D.listed(D.duplicate_members(df, F.col("value"), "id", "key"), "key", ",").collect()
    assert [(r.key, r.duplicate_ids) for r in got] == [("a", "1,3")]


def test_records_are_hashed_once_and_texts_not_shuffled(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = D.mark_new(documents, F.sha2("text", 256), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.replace("context", "") and "sha2" not in plan


def test_known_fingerprints_over_batches(spark, tmp_path):
    path, loaded = str(tmp_path / "seen"), []
    for batch in ([(1, "a"), (2, "b"), (3, "a")], [(4, "b"), (5, "c")], [(6, "c"), (7, "a")]):
        df = spark.createDataFrame(batch, "id long, value string")
        new = D.new_records(df, F.md5("value"), "id", D.recall(spark, path)).collect()
        loaded += [r.id for r in new]
        assert D.remember(df, F.md5("value"), path) == len(new)
    assert loaded == [1, 2, 5] and D.recall(spark, path).count() == 3
    D.forget(spark, path)
    assert D.recall(spark, path).count() == 0


def test_fingerprints_of_maps_and_arrays_do_not_depend_on_order(spark):
    one = spark.sql("SELECT map('a', 1, 'b', 2) AS m, array(named_struct('x', 1, 'y', map('p', 1, 'q', 2))) AS s")
    two = spark.sql("SELECT array(named_struct('y', map('q', 2, 'p', 1), 'x', 1)) AS s, map('b', 2, 'a', 1) AS m")
    other = spark.sql("SELECT array(named_struct('y', map('q', 2, 'p', 3), 'x', 1)) AS s, map('b', 2, 'a', 1) AS m")
    prints = [d.select(FP.record_fingerprint(d)).first()[0] for d in (one, two, other)]
    assert prints[0] == prints[1] != prints[2]
