"""JSON records without a schema, and proofs of loads, against plain versions."""

import json
import random
from collections import Counter
from datetime import date

from pyspark.sql import functions as F

from tallyhouse.operators import proof as PF
from tallyhouse.operators import records as R
from tallyhouse.operators.merge import replace_partitions
from tallyhouse.operators.privacy import REDACTED, SENSITIVE_PARTS

KEYS = ["a", "b_c", "Email", "api_key", "user token", "n{", "}x", 'q"\\', "ADDRESS2", "ok", "日本"]


def value(rng, depth):
    kind = rng.random()
    if depth and kind < 0.35:
        return {k: value(rng, depth - 1) for k in rng.sample(KEYS, rng.randint(0, 4))}
    if depth and kind < 0.6:
        return [value(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([None, True, False, 0, -7, 12345678901, 1.5, "", "text", '{"email": "in a text"}', "[", "\\\"]", "x" * 50])


def cleaned(x):
    if isinstance(x, dict):
        return {k: REDACTED if any(p in k.lower() for p in SENSITIVE_PARTS) else cleaned(v) for k, v in x.items()}
    return [cleaned(v) for v in x] if isinstance(x, list) else x


def leaves(x, path=""):
    if isinstance(x, dict):
        return [leaf for k, v in x.items() for leaf in leaves(v, f"{path}_{k}" if path else k)]
    return [(path, x)]


def records(seed, n=150):
    rng = random.Random(seed)
    return [(i, json.dumps(value(rng, 6), ensure_ascii=i % 2 == 0)) for i in range(n)]


BROKEN = [(1000, "no json"), (1001, None), (1002, ""), (1003, '{"a": 1'), (1004, '{"a": 1, "a": 2}'), (1005, '{"email": "x"]')]


def test_sanitize_json(spark):
    rows = records(1)
    df = spark.createDataFrame([(i, r, "kept") for i, r in rows + BROKEN], "id long, `re.cord` string, email string").repartition(3)
    got = {r.id: r["re.cord"] for r in R.sanitize_json(df, "re.cord").collect()}
    assert {i: json.loads(got[i]) for i, _ in rows} == {i: cleaned(json.loads(r)) for i, r in rows}
    assert [got[i] for i, _ in BROKEN] == [None] * len(BROKEN)
    assert R.sanitize_json(df.limit(0), "re.cord").count() == 0


def test_what_lies_too_deep_is_redacted(spark, monkeypatch):
    monkeypatch.setattr(R, "DEEPEST", 3)
    deep = {"a": {"b": {"c": {"email": "x"}, "d": [1]}}, "e": 1}
    df = spark.createDataFrame([(json.dumps(deep),)], "r string")
    assert json.loads(R.sanitize_json(df, "r").first().r) == {"a": {"b": {"c": REDACTED, "d": REDACTED}}, "e": 1}


def test_deep_records(spark):
    deep = '{"k":[' * 7 + '{"phone":"1","ok":[]}' + "]}" * 7
    df = spark.createDataFrame([(deep,)], "r string")
    assert R.sanitize_json(df, "r").first().r == '{"k":[' * 7 + '{"ok":[],"phone":"[REDACTED]"}' + "]}" * 7
    assert "Exchange" not in R.sanitize_json(df, "r")._jdf.queryExecution().executedPlan().toString()


def test_flatten_json(spark):
    rows = records(2)
    df = spark.createDataFrame(rows + BROKEN, "id long, record string").repartition(3)
    got = Counter((r.id, r.path) for r in R.flatten_json(df, "record").collect())
    assert got == Counter((i, path) for i, r in rows for path, _ in leaves(json.loads(r)))
    shown = {(r.id, r.path): r.value for r in R.flatten_json(df, "record").collect()}
    for i, r in rows:
        for path, x in leaves(json.loads(r)):
            if isinstance(x, list):
                assert json.loads(shown[i, path]) == x
            elif isinstance(x, str):
                assert shown[i, path] == x


def test_records_are_not_read_before_they_are_walked(spark):
    torn = spark.range(1).select(F.raise_error(F.lit("read")).cast("string").alias("r"))
    assert R.sanitize_json(torn, "r").columns == ["r"] and R.flatten_json(torn, "r").columns == ["path", "value"]


def test_records_of_one_split_are_dealt_out(spark):
    df = R.spread(spark.range(1000).select("id", F.lit('{"email": 1}').alias("r")).coalesce(1), "id")
    plan = R.sanitize_json(df, "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("variant") < plan.index("Exchange hashpartitioning(id")  # moved first, walked after
    got = R.sanitize_json(df, "r").collect()
    assert sorted(got) == [(i, '{"email":"[REDACTED]"}') for i in range(1000)]


def test_flatten_deep_records(spark):
    deep = '{"a":' * R.DEEPEST + "1" + "}" * R.DEEPEST
    got = R.flatten_json(spark.createDataFrame([(deep,), ('{"":{"b":{"":2}}}',), ('{"a":{},"b":[]}',)], "r string"), "r").collect()
    assert sorted(map(tuple, got)) == [("_".join("a" * R.DEEPEST), "1"), ("b", "[]"), ("b_", "2")]


def test_names_are_taken_literally(spark):
    df = spark.createDataFrame([('{"a.b":1,"axb":{},"c|":[],"d":null}',)], "r string")
    assert R.sanitize_json(df, "r", ("a.b", "|")).first().r == '{"a.b":"[REDACTED]","axb":{},"c|":"[REDACTED]","d":null}'
    assert R.sanitize_json(df, "r", ()).first().r == '{"a.b":1,"axb":{},"c|":[],"d":null}'


SCHEMA = "year int, month date, day date, kind string, n long, note string"


def table(rng):
    days = [date(y, m, d) for y in (2022, 2023) for m in (1, 2, 7) for d in range(1, 20, 4)]
    return {(d, k): (rng.randint(0, 9), rng.choice([None, "", "x"])) for d in days for k in ("a", "b") if rng.random() < 0.9}


def frame(spark, rows):
    return spark.createDataFrame([(d.year, d.replace(day=1), d, k, n, note) for (d, k), (n, note) in rows.items()], SCHEMA)


def store(spark, path, rows):
    stored = frame(spark, rows)
    replace_partitions(stored, path, "month")
    PF.store_digests(stored, path, ("year", "month"), "month")


def differences(spark, path, rows):
    read = spark.read.schema(SCHEMA).parquet(path)
    got = PF.load_differences(frame(spark, rows), read, spark.read.parquet(f"{path}_digests"), ("day", "kind"), ("year", "month"), "month")
    return sorted(map(tuple, got.collect()))


def test_load_differences(spark, tmp_path):
    rng, path = random.Random(4), str(tmp_path / "t")
    old = table(rng)
    store(spark, path, old)
    assert differences(spark, path, old) == []
    new = dict(old)
    keys = sorted(k for k in old if k[0].month == 2 and k[0].year == 2023)
    del new[keys[0]]
    new[keys[1]] = (old[keys[1]][0] + 1, old[keys[1]][1])
    new[keys[2]] = (old[keys[2]][0], "other")
    new[date(2024, 5, 5), "a"] = (1, None)  # a month, and a year, that the table hasn't
    # Whatever lies in months that are equal isn't opened.
    for file in (tmp_path / "t").rglob("*.parquet"):
        if "month=2023-02-01" not in str(file):
            file.write_bytes(b"torn")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    wanted = [(*keys[0], "extra"), (*keys[1], "changed"), (*keys[2], "changed"), (date(2024, 5, 5), "a", "absent")]
    assert differences(spark, path, new) == sorted(wanted)


def test_differences_of_null_and_empty_values_and_repeated_pairs(spark, tmp_path):
    path, day = str(tmp_path / "t"), date(2022, 1, 1)
    store(spark, path, {(day, "a"): (1, None), (day, "b"): (1, "x"), (day, "c"): (2, "x")})
    assert differences(spark, path, {(day, "a"): (1, ""), (day, "b"): (2, "x"), (day, "c"): (1, "x")}) == [
        (day, "a", "changed"), (day, "b", "changed"), (day, "c", "changed")]
    assert differences(spark, path, {}) == [(day, k, "extra") for k in "abc"]


def test_digests_do_not_depend_on_order_and_add_up(spark):
    rows = frame(spark, table(random.Random(5)))
    one, two = (PF.digests(r, ("year", "month")).orderBy("month").collect() for r in (rows, rows.orderBy(F.desc("n")).repartition(7)))
    assert one == two
    whole = PF.digests(rows.select("day", "kind", "n", "note"), ()).first()
    added = PF.wider(PF.digests(rows, ("year", "month")), ()).first()
    assert whole == added
