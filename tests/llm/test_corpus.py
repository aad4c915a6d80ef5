"""Shards, ranked search and divergences against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import divergence, max_sketch, queries, shards
from tests.llm import plain

FOLDER = "/root/testdata/sf0.01"


def corpus(seed, n=160):
    """Rows of doc_id, text, lang, source: null and empty texts, null names, a third alike, one long text, repeated and null ids."""
    rng = random.Random(seed)
    vocabulary = [w + s for w in ("alpha", "Beta", "GAMMA", "déjà", "x1", "2024", "straße", "日本", "a", "the") for s in ("", "s", "-z", "9q")]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(vocabulary, [1 / (j + 1) for j in range(len(vocabulary))], k=rng.randint(0, 30)))
        rows.append((i, rng.choice([text, text, text, text.upper(), "", None]), rng.choice(["en", "de", None]), rng.choice(["s0", "s1", "s2", "S1", None])))
    rows += [(7, "the same text of many rows", "en", "s0")] * (n // 2)
    rows += [(None, "no id", "en", "s4"), (None, "no id", "en", "s4"), (None, None, "fr", "s9"), (7, "alpha " * 9000, "en", "s1"), (n + 5, "\x00 \t\n 1 2", "it", "s1"), (n + 6, "", "it", "s2")]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("n", [16, 3, 200])
def test_shards(spark, n):
    rows = corpus(1)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = shards.read_shards(spark, shards.write_shards(docs, n), docs).select("row.*", "size", "shard", "slot").collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(rows)
    size = lambda text: len((text or "").encode()) + 1
    key = lambda r: (r[0] is not None, r[0] or 0, size(r[1]), zlib.crc32((r[1] or "").encode()))
    total, before, wanted, counts = sum(size(r[1]) for r in rows), 0, [], Counter()
    for r in sorted(rows, key=key):
        shard = min(n - 1, (2 * before + size(r[1])) * n // (2 * total))
        wanted.append((key(r), shard, counts[shard]))
        counts[shard] += 1
        before += size(r[1])
    assert sorted((key(r), r.shard, r.slot) for r in got) == sorted(wanted)
    assert all(r.size == size(r.text) for r in got)


def test_shards_are_near_equal(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = queries.QUERIES["op11_shards"](spark, FOLDER).groupBy("shard").agg(F.sum("size").alias("size"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    found = sorted(found.collect())
    longest = docs.agg(F.max(F.octet_length("text"))).first()[0] + 1
    mean = sum(r.size for r in found) / 16
    assert [r.shard for r in found] == list(range(16)) and all(abs(r.size - mean) <= longest for r in found)
    assert all(a.high < b.low for a, b in zip(found, found[1:]))


def test_shards_of_clashing_columns_and_of_nothing(spark):
    names = ["row", "size", "range", "place", "shard", "slot", "salt", "crc", "at", "total"]
    rows = [(i, f"text {i:02}", *range(10)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` long" for c in names))
    got = shards.read_shards(spark, shards.write_shards(docs, 4), docs)
    assert Counter(tuple(r.row) for r in got.collect()) == Counter(rows)
    assert [r["count"] for r in got.groupBy("shard").count().orderBy("shard").collect()] == [10] * 4
    assert shards.read_shards(spark, shards.write_shards(docs.limit(0)), docs).count() == 0


def test_shards_are_native_and_shuffle_texts_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = shards.ranged(docs, ["doc_id"])
    plan = shards.placed(rows, shards.range_plan(rows, 16))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan.split("== Physical Plan ==")[1]


@pytest.mark.parametrize("pairs, coordinates, step", [(1 << 18, 1024, 16), (12, 8, 1)])
def test_search(spark, monkeypatch, pairs, coordinates, step):
    monkeypatch.setattr(max_sketch, "BLOCK_PAIRS", pairs)
    monkeypatch.setattr(max_sketch, "COORDINATES", coordinates)
    monkeypatch.setattr(max_sketch, "STEP", step)
    monkeypatch.setattr(max_sketch, "ITEMS", 3)
    monkeypatch.setattr(max_sketch, "DOCUMENTS", 50)
    rows = [(i, t) for i, t, _, _ in corpus(2)]
    items = [(1, "the Alpha gammas"), (2, "déjà, 2024 x1! straße"), (3, None), (4, ""), (5, "nothing known here"), (6, "same text of many rows"), (6, "same text of many rows"), (None, "日本 日本 the")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, item string, score int").repartition(5)
    asked = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id int, text string, rank int")
    got = sorted(map(tuple, max_sketch.search(docs, asked).collect()), key=repr)
    assert got == sorted(plain.ranked(rows, items, 10), key=repr)
    assert {r[0] for r in got} == {1, 2, 6, None} and sum(r[0] == 6 for r in got) == 10
    assert max_sketch.search(docs, asked).schema["item_id"].dataType.simpleString() == "int"


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a c")], "item_id long, text string")
    assert [tuple(r)[:3] for r in max_sketch.search(docs, items).collect()] == [(1, 1, 1)]
    assert max_sketch.search(docs.limit(0), items).count() == 0
    assert max_sketch.search(docs.where("text is null"), items).count() == 0
    assert max_sketch.search(docs, items.limit(0)).count() == 0


def test_bounds_hold_and_spare_most_documents():
    import duckdb

    docs = duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet' order by doc_id").fetchall()
    items = duckdb.sql(f"select text from '{FOLDER}/benchmark.parquet' order by item_id").fetchall()
    names = [sorted(set(plain.search_terms(t))) for t, in items]
    found = [plain.search_terms(t) for _, t in docs]
    df = Counter(t for own in found for t in set(own))
    n, length = sum(map(bool, found)), sum(map(len, found))
    weight = {t: int(np.floor(1000 * np.log((2 * n + 2) / (2 * df[t] + 1)))) for own in names for t in own}
    block, best = max_sketch.Items(names, weight, n, length), max_sketch.Best(len(names), 10)
    for first, texts in max_sketch.few(pa.array([t for _, t in docs])):
        postings = max_sketch.Postings(texts, block)
        every = np.repeat(np.arange(texts.n), len(names)), np.tile(np.arange(len(names)), texts.n)
        bounds = postings.sketch @ block.matrix(0, len(names)) * np.float32(max_sketch.SLACK)
        assert (bounds.ravel() >= postings.scores(*every)).all()
        max_sketch.rescore(postings, np.arange(first, first + texts.n), best)
    assert best.scored < 0.2 * len(docs) * len(names)


@pytest.mark.parametrize("tile, block, pairs", [(1 << 18, 1024, 1 << 18), (16, 2, 5), (16, 1, 5)])
def test_divergence(spark, monkeypatch, tile, block, pairs):
    monkeypatch.setattr(divergence, "TILE_COUNTS", tile)
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "PAIRS", pairs)
    rows = corpus(3)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n int, term string").repartition(5)
    got = sorted(map(tuple, divergence.audit(docs).collect()))
    assert got == sorted(plain.divergences(rows, divergence.TERM_RANKS))
    assert divergence.audit(docs.limit(0)).count() == 0


def test_common_cells():
    rng = np.random.default_rng(5)
    cells = np.array(sorted({(int(c), int(r)) for c, r in rng.integers(0, 37, size=(300, 2))}))
    order = np.argsort(divergence.interleaved(cells[:, 0], cells[:, 1], 6))
    column, row = cells[order].T
    got = Counter(frozenset(((column[i], row[i]), (column[j], row[j]))) for a, b in divergence.common_cells(column, row, 6) for i, j in zip(a, b))
    wanted = Counter(frozenset(((c, r), (c, s))) for c, r in cells.tolist() for d, s in cells.tolist() if c == d and r < s)
    assert got == wanted
    got = sum(len(a) for a, _ in divergence.common_cells(column, row, 6, 5))
    assert got == sum(1 for pair in wanted if len({r >> 5 for _, r in pair}) == 2)


def test_shares_do_not_overflow(spark):
    row = spark.range(1).selectExpr("4000000000000L AS n", "9000000000000L AS total", "5L AS v").select(divergence._share("n", "total")).first()
    assert row[0] == 1 + 10**9 * (4 * 10**12 + 1) // (9 * 10**12 + 5)
