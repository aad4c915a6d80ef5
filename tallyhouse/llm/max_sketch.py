"""Ranked lexical search: sketches of maxima bound every score, exact scores in descending order of bounds until a threshold.

Each document folds into a sketch: its terms are hashed to coordinates, and a coordinate holds the highest impact of
the terms in it, where an impact is the part of a score that depends on document and term alone. The sum of an item's term weights
times their coordinates is at least its score. Bounds of all items for some documents are one matrix product. An item
then takes the documents in descending order of its bounds, and scores them exactly, until the next bound is below
its ``k``-th best score so far, which a task keeps from its first to its last document.

There are two passes over the documents, one for counts and one for scores, for each block of items. Only weights of a
block, of bounded size, go to all tasks, and only each task's ``k`` best of each item come back.

Defined results: documents without terms, null texts among them, and items without terms have no row; equal scores are
ordered by id, null ids last; rows with equal ids are documents of their own; items that agree in id and text are taken
once; further columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.terms import LETTERS_AND_DIGITS, counted, terms
from tallyhouse.llm.words import Texts, slices
from tallyhouse.operators.staging import settled

#: More coordinates make bounds closer; a sketch lives only while its documents are searched.
COORDINATES = 8192
#: Documents that are sketched together.
DOCUMENTS = 512
#: Pairs of item and term in a block of items, about.
BLOCK_PAIRS = 1 << 18
#: Items whose bounds are computed together.
ITEMS = 256
#: Documents an item takes before its threshold is looked at again.
STEP = 16
#: A bound is summed in single precision; this much more than covers the rounding.
SLACK = 1.001
#: Impacts are below this.
MOST = 1_000_000
#: Lanes in which the best of all tasks are thinned out before they meet.
LANES = 64


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``item, term`` for every different term of an item, with the item's number."""
    for batch in batches:
        for first, texts in slices(batch.column(1)):
            words, number, owner = terms(texts, LETTERS_AND_DIGITS)
            pairs = np.unique(owner * max(1, len(words)) + number)
            item = batch.column(0).slice(first, texts.n).take(pa.array(pairs // max(1, len(words))))
            yield pa.RecordBatch.from_arrays([item, words.take(pa.array(pairs % max(1, len(words)))).cast(pa.string())], names=["item", "term"])


def _counter(wanted: pa.Array):
    """A task's ``term, docs, n``: documents with each wanted term; under the null term all documents with a term, and their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, documents, length = np.zeros(len(wanted), np.int64), 0, 0
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                words, number, owner = terms(texts, LETTERS_AND_DIGITS)
                known = _known(words, wanted)
                if len(words):
                    pairs = np.unique(owner * len(words) + number)
                    ids = known[pairs % len(words)]
                    df += np.bincount(ids[ids >= 0], minlength=len(df))
                    documents += len(np.unique(owner))
                    length += len(owner)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([
            pa.concat_arrays([wanted.take(pa.array(at)), pa.nulls(1, wanted.type)]).cast(pa.string()),
            pa.array(np.append(df[at], documents)), pa.array(np.append(np.zeros(len(at), np.int64), length)),
        ], names=["term", "docs", "n"])

    return run


def _known(words: pa.Array, wanted: pa.Array) -> np.ndarray:
    """The number of each word in ``wanted``, or -1."""
    return pc.fill_null(pc.index_in(words, value_set=wanted), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def coordinates(words: pa.Array) -> np.ndarray:
    """The coordinate of each word."""
    if not len(words):
        return np.zeros(0, np.int64)
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(words) + 1, words.offset * 8)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    return (Texts(raw, bounds).fingerprints(bounds[:-1], bounds[1:]) % np.uint64(COORDINATES)).astype(np.int64)


class Items:
    """A block of items: terms and weights of each, for tasks."""

    def __init__(self, names: list[list[str]], weight: dict[str, int], documents: int, length: int):
        self.words = pa.array(sorted({t for own in names for t in own}), pa.large_string())
        at = {t: i for i, t in enumerate(self.words.to_pylist())}
        self.sizes = np.array([len(own) for own in names], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.term = np.array([at[t] for own in names for t in own], np.int64)
        self.weight = np.array([weight.get(t, 0) for own in names for t in own], np.int64)
        self.coordinate = coordinates(self.words)[self.term]
        self.documents, self.length = documents, length

    def matrix(self, first: int, last: int) -> np.ndarray:
        """Weights of some items by coordinate."""
        found = np.zeros((COORDINATES, last - first), np.float32)
        item = np.repeat(np.arange(last - first), self.sizes[first:last])
        own = slice(self.starts[first], self.starts[last - 1] + self.sizes[last - 1])
        np.add.at(found, (self.coordinate[own], item), self.weight[own])
        return found


def few(column: pa.Array) -> Iterator[tuple[int, Texts]]:
    """As ``slices``, with at most DOCUMENTS texts each."""
    for first, texts in slices(column):
        for at in range(0, texts.n, DOCUMENTS):
            own = texts.bounds[at : at + DOCUMENTS + 1]
            yield first + at, Texts(texts.data[own[0] : own[-1]], own - own[0])


class Postings:
    """Impacts of some documents: folded into sketches, and exact for the items' terms."""

    def __init__(self, texts: Texts, items: Items):
        words, number, owner = terms(texts, LETTERS_AND_DIGITS)
        size = max(1, len(words))
        keys, tf = counted(owner * size + number)
        doc, word = keys // size, keys % size
        # In whole numbers of any size, as the product may pass 64 bits.
        m = np.array([10 + 90 * n * items.documents // items.length for n in np.bincount(owner, minlength=texts.n).tolist()], np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
        self.sketch = np.zeros((texts.n, COORDINATES), np.float32)
        order = np.argsort(impact, kind="stable")  # the highest impact of a coordinate is stored last
        self.sketch[doc[order], coordinates(words)[word[order]]] = impact[order]
        known = _known(words, items.words)[word]
        keys = doc[known >= 0] * len(items.words) + known[known >= 0]
        order = np.argsort(keys, kind="stable")
        self.keys, self.impact = keys[order], impact[known >= 0][order]
        self.items = items

    def scores(self, doc: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Exact scores of pairs."""
        if not len(self.keys) or not len(doc):
            return np.zeros(len(doc), np.int64)
        n = self.items.sizes[item]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(self.items.starts[item], n)
        wanted = np.repeat(doc, n) * len(self.items.words) + self.items.term[at]
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        parts = np.where(self.keys[place] == wanted, self.impact[place], 0) * self.items.weight[at]
        sums = np.concatenate(([0], np.cumsum(parts)))
        return sums[ends] - sums[ends - n]


class Best:
    """The ``k`` best documents of each item so far; scores above 0 only."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((items, k), np.int64)
        self.doc = np.full((items, k), np.iinfo(np.int64).max)
        self.scored = 0

    def threshold(self) -> np.ndarray:
        """A bound below this, or below 1, leaves nothing to find."""
        return np.maximum(self.score[:, -1], 1)

    def take(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        """Add scored documents, at most one entry for each document and item."""
        self.scored += len(item)
        good = score >= self.threshold()[item]
        item, doc, score = item[good], doc[good], score[good]
        if not len(item):
            return
        which = np.unique(item)
        item = np.concatenate((np.repeat(which, self.k), item))
        doc = np.concatenate((self.doc[which].ravel(), doc))
        score = np.concatenate((self.score[which].ravel(), score))
        order = np.lexsort((doc, -score, item))
        first = np.searchsorted(item[order], which)
        kept = order[(first[:, None] + np.arange(self.k)).ravel()].reshape(len(which), self.k)
        self.score[which], self.doc[which] = score[kept], doc[kept]


def rescore(found: Postings, ids: np.ndarray, best: Best) -> None:
    """Let every item take some documents in descending order of its bounds, until the next is below its threshold."""
    n = len(found.sketch)
    for first in range(0, len(found.items.sizes), ITEMS):
        last = min(first + ITEMS, len(found.items.sizes))
        bounds = found.sketch @ found.items.matrix(first, last) * np.float32(SLACK)
        order = np.argsort(-bounds, axis=0, kind="stable")
        open_items = np.arange(last - first)
        for at in range(0, n, STEP):
            limit = best.threshold()[first:last]
            open_items = open_items[bounds[order[at, open_items], open_items] >= limit[open_items]]
            if not len(open_items):
                break
            doc = order[at : at + STEP, open_items]
            item = np.broadcast_to(open_items, doc.shape)
            reach = bounds[doc, item] >= limit[item]
            doc, item = doc[reach], item[reach] + first
            best.take(item, ids[doc], found.scores(doc, item))


def _searcher(items: Items, k: int):
    """A task's best ``item, doc_id, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items.sizes), k)
        for batch in batches:
            ids = pc.fill_null(batch.column(0).cast(pa.int64()), np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            for first, texts in few(batch.column(1)):
                if items.length:
                    rescore(Postings(texts, items), ids[first : first + texts.n], best)
        item, place = np.nonzero(best.score)
        doc = best.doc[item, place]
        yield pa.RecordBatch.from_arrays([
            pa.array(item), pa.array(doc, pa.int64(), mask=doc == np.iinfo(np.int64).max), pa.array(best.score[item, place]),
        ], names=["item", "doc_id", "score"])

    return run


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def weights(docs: DataFrame, wanted: list[str]) -> tuple[dict[str, int], int, int]:
    """Weight of each wanted term that occurs, documents with terms, and all terms of them. The terms are those of one block."""
    held = pa.array(wanted, pa.large_string())
    rows = docs.select("text").mapInArrow(_counter(held), "term string, docs long, n long")
    sums = rows.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).collect()
    documents, length = next(((r.docs, r.n) for r in sums if r.term is None), (0, 0))
    found = np.floor(1000 * np.log((2 * documents + 2) / (2 * np.array([r.docs for r in sums if r.term is not None], np.float64) + 1)))
    return dict(zip((r.term for r in sums if r.term is not None), found.astype(int).tolist())), documents, length


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    held = settled(items.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id()), "search-items")
    pairs = settled(held.select("item", "text").mapInArrow(_item_terms, "item long, term string"), "search-terms")
    n = pairs.count()
    blocks = 1 if n <= BLOCK_PAIRS else -(-2 * n // BLOCK_PAIRS)
    parts = []
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))
        rows = own.orderBy("item").collect()
        if not rows:
            continue
        numbers: list[Any] = [(i, r.item) for i, r in enumerate(rows)]
        made = Items([r.terms for r in rows], *weights(docs, sorted({t for r in rows for t in r.terms})))
        found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_searcher(made, k), "place long, doc_id long, score long")
        found = _first(found.withColumn("lane", F.pmod(F.xxhash64("doc_id"), F.lit(LANES))), ["place", "lane"], k)
        parts.append(found.join(spark.createDataFrame(numbers, "place long, item long"), "place").select("item", "doc_id", "score"))
    if not parts:
        return held.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    best = _first(rows, ["item"], k)
    return best.join(held.select("item", "item_id"), "item").select(F.col("item_id").cast(kind), "rank", "doc_id", "score")
