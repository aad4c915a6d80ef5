"""Searches by index and lookups in clustered tables: the same rows, and how little of a table they read."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import lookups as L
from tallyhouse.sources import search as X
from tallyhouse.sources.clustered import write_clustered

SCHEMA = "id long, name string, email string"


def people(n=3000):
    rng, out = random.Random(7), []
    for i in range(1, n + 1):
        name = rng.choice([None, "", "Al", "".join(rng.choices("abcdä%_", k=rng.randint(0, 9)))])
        out.append((i * 40, name, rng.choice([None, f"u{i}@x.test"])))
    return [*out, (5, "needle in a haystack", None), (119_999, None, "a needle"), (7, "same " * 2000, None)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    found = X.TextIndex(str(tmp_path_factory.mktemp("index")), ("name", "email"), block=10_000, parts=8)
    X.build_index(spark.createDataFrame(people(), SCHEMA).repartition(4), found)
    return found


@pytest.mark.parametrize("term", ["needle", "abc", "ab%", "_ä", "u17", "u1", "@x.test", "", "zzz", "aaaaaaa", "dleX", "same same", "ä%_"])
def test_search_against_a_scan(spark, index, term):
    for limit in (100, 7):
        got = [tuple(r) for r in X.search(spark, index, term, SCHEMA, limit).collect()]
        wanted = sorted((r for r in people() if term in (r[1] or "") and r[1] is not None or term in (r[2] or "") and r[2] is not None), key=lambda r: r[0])
        assert got == wanted[:limit]


def test_grams(spark):
    rows = [("abcabc",), ("ab",), ("",), (None,), ("abc",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(X.grams(F.col("t"))).collect()]
    assert got == [["abc", "bca", "cab"], None, None, None, ["abc"]]


def test_only_blocks_with_candidates_are_opened(spark, tmp_path):
    index = X.TextIndex(str(tmp_path / "index"), ("name", "email"), block=32_768)
    X.build_index(spark.createDataFrame(people(), SCHEMA), index)
    before = X.search(spark, index, "needle", SCHEMA, 100).collect()
    torn = 0
    for file in (tmp_path / "index" / "rows").rglob("*.parquet"):
        if file.parent.name not in ("block=0", "block=1", "block=3"):  # the last id of a bitmap begins the next block
            file.write_bytes(b"torn")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
            torn += 1
    assert torn and X.search(spark, index, "needle", SCHEMA, 100).collect() == before
    with pytest.raises(Exception):
        X.search(spark, index, "ne", SCHEMA, 100).collect()


def test_tasks_of_an_index_do_not_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(X, "TASK_CHARS", 2000)
    index = X.TextIndex("", ("name", "email"))
    for n in (1000, 4000):
        rows = spark.createDataFrame([(i - 500, f"name{i:05}", f"u{i:05}@x.test") for i in range(n)], SCHEMA).coalesce(1)
        found = X.postings(rows, index)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")  # trigrams aren't moved
        assert found.rdd.getNumPartitions() == 1 + n * 22 // 2000
        held = {(r.gram, r.word): r.bits & (1 << 64) - 1 for r in found.collect()}
        assert len(held) == found.count()
        wanted = {}
        for row_id, *texts in rows.collect():
            for gram in {t[k : k + 3] for t in texts for k in range(len(t) - 2)}:
                wanted[gram, row_id >> 6] = wanted.get((gram, row_id >> 6), 0) | 1 << (row_id & 63)
        assert held == wanted


def rows_scanned(df):
    """Rows that the scans of a collected frame handed on, after row groups and pages were left out."""
    def scans(plan):
        if plan.getClass().getSimpleName().startswith("AdaptiveSparkPlan"):
            yield from scans(plan.executedPlan())
            return
        leaves = plan.collectLeaves()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if leaf.getClass().getSimpleName().endswith("QueryStageExec"):
                yield from scans(leaf.plan())
            else:
                yield leaf.metrics().get("numOutputRows").get().value()
    return sum(scans(df._jdf.queryExecution().executedPlan()))


@pytest.fixture
def many_files(spark):
    """Small files stay apart, as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def activity(spark):
    rng, start = random.Random(8), datetime(2024, 1, 1)
    # A third of all rows belong to one user.
    rows = [(i, 1 if i % 3 == 0 else rng.randint(2, 4000), rng.choice(["click", "view"]), "{}", start + timedelta(minutes=rng.randint(0, 500_000))) for i in range(60_000)]
    return spark.createDataFrame(rows, "id long, user_id long, activity_type string, metadata string, created_at timestamp_ntz")


@pytest.mark.parametrize("user", [1, 77, 9999])
def test_lookups_read_little(spark, tmp_path, activity, many_files, user):
    path = str(tmp_path / "t")
    write_clustered(activity, path, ("user_id", "created_at", "id"), group_bytes=64 << 10)
    stored = spark.read.parquet(path)
    got, wanted = (L.latest_activity(t, user, "click", 50) for t in (stored, activity))
    assert got.collect() == wanted.collect()
    share = rows_scanned(got) / 60_000
    assert share < (0.5 if user == 1 else 0.1)
    assert len(stored.where("user_id = 1").select(F.input_file_name()).distinct().collect()) > 1  # a hot user fills several files


def test_bloom_filters_spare_files(spark, tmp_path, activity, many_files):
    path = str(tmp_path / "t")
    write_clustered(activity, path, ("created_at", "id"), ("user_id",), group_bytes=64 << 10)
    got = spark.read.parquet(path).where("user_id = 5000")
    assert got.count() == 0
    held = spark.read.parquet(path).where("user_id = 77")
    assert len(held.collect()) == activity.where("user_id = 77").count() and rows_scanned(held) < 60_000 * 0.8
