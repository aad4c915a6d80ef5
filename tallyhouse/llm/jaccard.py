"""Exact Jaccard join of whole texts in the metric space of their shingle sets.

The distance ``1 - |x & y| / |x | y|`` is a metric; two texts link within ``EPS`` = 0.15 of each other.

1. Equal sets are one class. Everything after that is about classes.
2. Cells. A linked pair differs in at most ``K`` shingles, K by the sizes. The shingle universe is dealt into
   ``m = K + 1 + z`` parts, so at least ``z + 1`` parts of the two sets agree. Each part of a set is at
   distance 0 from the pivot "exactly this part", and goes to that pivot's cell. Parts with under two shingles are left out
   while there are at most ``z`` of them; so every linked pair meets in a cell. Sizes are
   cut into bands wide enough that linked pairs lie in one band or two neighbouring ones; a set goes
   to the cells of its band and the next: the boundary windows.
3. Pivots. In each cell its smallest class is the pivot. Every other class of the cell is measured against
   it: within EPS it is linked. Cells whose classes are then all connected are done: a group of
   thousands of near copies costs one comparison for each copy, not one for each pair.
4. Recursion. In the other cells the classes are dealt anew, to the cells of their rarest shingles: a shingle counts only if
   classes of different components have it, and a class that lacks partners for 85 % of its shingles is done. In these cells
   classes that are not yet connected are joined with pivot after pivot: a pair is measured only if its distances from the first
   pivot of the cell differ by at most EPS (triangle inequality), and if enough common shingles can follow. A cell takes STEP times as many pivots in
   each round, until none is left; connected pairs drop out after each round.

Nothing is estimated. Sets are compared as 64-bit fingerprints of shingles, classes by a 64-bit
fingerprint of the set.

Defined results: a null or empty text, or one of white space only, has no shingles and links with nothing; a text with fewer
words than a shingle is one shingle of all its words. Repeated rows are copies of each other.
A null id is allowed; component_id is the smallest id that isn't null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.components import components
from tallyhouse.llm.words import LOWER, WHITE, mixed, slices, windows
from tallyhouse.operators.staging import settled

SHARE = (85, 100)
BAND_RATIO = 1 / 0.849  # a little over 1 / 0.85: linked sets are at most one band apart
MAX_BAND = 220  # sets of up to 4e15 shingles
STEP = 8  # times as many pivots in each round
CLASS_SALT = np.uint64(0x2545F4914F6CDD1D)


def band_of(n: np.ndarray) -> np.ndarray:
    """The size band of each set."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(BAND_RATIO)).astype(np.int64)


#: For each band: shingles in which two linked sets may differ at most, spare parts, and parts.
_HIGH = np.floor(BAND_RATIO ** np.arange(1.0, MAX_BAND + 1))
DIFFER = np.floor(2 * _HIGH * (SHARE[1] - SHARE[0]) / (SHARE[1] + SHARE[0]) + 1e-9).astype(np.int64)
SPARE = np.ceil(0.12 * DIFFER).astype(np.int64) + 2
PARTS = DIFFER + 1 + SPARE


def shingle_sets(texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bounds, hashes)``: the distinct shingles of each text, sorted, in one array."""
    data = LOWER[texts.data]
    starts, ends = texts.runs(~WHITE[data])
    owner = texts.owner(starts)
    word = texts.fingerprints(starts, ends, data)
    at, hashes = windows(word, owner, k)
    of = owner[at]
    first = np.searchsorted(owner, np.arange(texts.n + 1))
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < k))
    if len(few):  # fewer words: the whole sequence, which differs from any shingle by its length
        whole = np.zeros(len(few), np.uint64)
        for j in range(k - 1):
            has = first[few] + j < first[few + 1]
            whole[has] = mixed(whole[has] ^ word[first[few[has]] + j]) + np.uint64(j + 1)
        of, hashes = np.concatenate((of, few)), np.concatenate((hashes, mixed(whole)))
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
    of, hashes = of[new], hashes[new]
    return np.searchsorted(of, np.arange(texts.n + 1)), hashes


def class_ids(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A fingerprint of each whole set."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mixed(hashes ^ CLASS_SALT), out=sums[1:])
    return mixed(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def cell_keys(bounds: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(set number, cell)`` of every cell each set goes to."""
    size = np.diff(bounds)
    found = []
    for step in (0, 1):
        band = band_of(size) + step
        parts = np.where(size > 0, PARTS[band], 0)
        base = np.concatenate(([0], np.cumsum(parts)))
        of = np.repeat(np.arange(len(size)), size)
        spread = mixed(hashes + band[of].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        slot = base[of] + ((spread >> np.uint64(32)) * parts[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        count = np.bincount(slot, minlength=base[-1])
        total = np.zeros(base[-1], np.uint64)
        np.add.at(total, slot, spread)
        owner = np.repeat(np.arange(len(size)), parts)
        weak = np.bincount(owner, weights=count < 2, minlength=len(size))
        empty = np.bincount(owner, weights=count < 1, minlength=len(size))
        least = np.where(empty > SPARE[band], 0, np.where(weak > SPARE[band], 1, 2))
        go = count >= least[owner]
        part = np.arange(base[-1]) - base[owner]
        key = mixed(total ^ mixed((band[owner] * (1 << 40) + part).astype(np.uint64)))
        found.append((owner[go], key[go].view(np.int64)))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _sizes(k: int):
    """Rows ``key, n_shingles, class`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                bounds, hashes = shingle_sets(texts, k)
                size = np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, texts.n), pa.array(size, pa.int64()), pa.array(class_ids(bounds, hashes), mask=size == 0)],
                    names=["key", "n_shingles", "class"])

    return run


def _cells(k: int):
    """Rows ``cell, class``, for the texts with which a class is first met in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                bounds, hashes = shingle_sets(texts, k)
                ids, size = class_ids(bounds, hashes), np.diff(bounds)
                if len(met) > 1_000_000:  # meeting a class again only repeats its cells
                    met.clear()
                fresh = np.array([s > 0 and (i not in met and not met.add(i)) for i, s in zip(ids.tolist(), size.tolist())], bool)
                of, keys = cell_keys(np.concatenate(([0], np.cumsum(np.where(fresh, size, 0)))), hashes[np.repeat(fresh, size)])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids[of])], names=["cell", "class"])

    return run


def _class_sets(k: int):
    """Rows ``class, n, members`` of each text, members being its n sorted shingles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                bounds, hashes = shingle_sets(texts, k)
                members = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(class_ids(bounds, hashes)), pa.array(np.diff(bounds), pa.int64()), pa.array(members, pa.binary())],
                    names=["class", "n", "members"])

    return run


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Common and all shingles of each pair ``a, b, x, y``."""
    for batch in batches:
        common, union = [], []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            n = int((large[at] == small).sum())
            common.append(n)
            union.append(len(x) + len(y) - n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(union, pa.int64())], names=["a", "b", "common", "total"])


LINKED = f"common * {SHARE[1]} >= total * {SHARE[0]}"


#: What holds for a linked pair in the cell of its first common shingle: the triangle inequality, and enough shingles from there
#: on that are common to some pair: 85 % of the union is 85 / 185 of both sizes together.
POSSIBLE = (
    f"abs(far - far_b) <= {1 - SHARE[0] / SHARE[1]} + 1e-9 and "
    f"(1 + least(useful - place, useful_b - place_b)) * {SHARE[0] + SHARE[1]} >= {SHARE[0]} * (n + n_b)"
)


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, common, total`` of each pair of classes."""
    held = pairs.join(sets.select(F.col("class").alias("a"), F.col("members").alias("x")), "a")
    held = held.join(sets.select(F.col("class").alias("b"), F.col("members").alias("y")), "b")
    return held.select("a", "b", "x", "y").mapInArrow(_measure, "a long, b long, common long, total long")


def jaccard_components(docs: DataFrame, key: str = "doc_id", k: int = 4) -> DataFrame:
    """``key, n_shingles, component_id`` of every row."""
    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(f"`{key}`").alias("key"), "text")
    every = settled(named.mapInArrow(_sizes(k), f"key {kind}, n_shingles long, class long"), "jaccard-sizes")
    cells = docs.select("text").mapInArrow(_cells(k), "cell long, class long")
    # One shuffle brings the classes of a cell together; only cells of two classes or more go on.
    cell = Window.partitionBy("cell")
    met = cells.select("cell", "class", F.min("class").over(cell).alias("pivot"), F.max("class").over(cell).alias("top"))
    met = settled(met.where("pivot <> top").select("cell", "class").distinct(), "jaccard-cells")

    wanted = met.select("class").distinct()
    one = every.where("class is not null").groupBy("class").agg(F.min("key").alias("key")).join(wanted, "class", "left_semi")
    texts = named.join(one.select("key").distinct(), "key", "left_semi")
    sets = texts.select("text").mapInArrow(_class_sets(k), "class long, n long, members binary")
    # Texts without any id have no key to be fetched by; they are read again and picked by class.
    unnamed = named.where("key is null").select("text").mapInArrow(_class_sets(k), "class long, n long, members binary")
    unnamed = unnamed.join(one.where("key is null").select("class"), "class", "left_semi").dropDuplicates(["class"])
    sets = settled(sets.union(unnamed), "jaccard-members")

    groups, _ = pivot_round(met, sets, None)
    near = _rare_cells(_open_cells(met, groups), sets)
    groups, member = pivot_round(_open_cells(near, groups).drop("component"), sets, groups)
    groups = recursion(member, sets, groups)

    low = every.where("class is not null").groupBy("class").agg(F.min("key").alias("key"))
    low = low.join(groups.select(F.col("node").alias("class"), "component"), "class", "left")
    low = low.select("class", "key", F.coalesce("component", "class").alias("component"))
    least = low.groupBy("component").agg(F.min("key").alias("component_id"))
    named = low.join(least, "component").select("class", "component_id")
    found = every.select("key", "n_shingles", "class").join(named, "class", "left")
    return found.select(F.col("key").alias(key), "n_shingles", F.coalesce("component_id", "key").alias("component_id"))


def merged(groups: DataFrame, new: DataFrame) -> DataFrame:
    """The components after more links: those of the graph whose nodes are the components so far."""
    if new.isEmpty():
        return groups
    of = lambda end: groups.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
    ends = new.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    roots = components(ends, "jaccard-components")
    root = roots.select(F.col("node").alias("component"), F.col("component").alias("root"))
    moved = groups.join(root, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    first_met = roots.join(groups.select("node"), "node", "left_anti").select("node", "component")
    return settled(moved.union(first_met), "jaccard-components")


def pivot_round(met: DataFrame, sets: DataFrame, groups: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The components so far, and ``met`` with ``far``: every class's distance from the first pivot of its cell."""
    pivot = F.min("class").over(Window.partitionBy("cell"))
    held = met.withColumn("pivot", pivot)
    pairs = held.where("class <> pivot").select(F.col("class").alias("a"), F.col("pivot").alias("b")).distinct()
    found = settled(measured(pairs, sets), "jaccard-measured")
    new = found.where(LINKED).select("a", "b")
    groups = components(new, "jaccard-components") if groups is None else merged(groups, new)
    apart = found.select(F.col("a").alias("class"), F.col("b").alias("pivot"), (1 - F.col("common") / F.col("total")).alias("far"))
    member = held.join(apart, ["class", "pivot"], "left").withColumn("far", F.coalesce("far", F.lit(0.0))).drop("pivot")
    return groups, member


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each class."""
    for batch in batches:
        for i in range(batch.num_rows):
            members = np.frombuffer(batch.column(3)[i].as_buffer(), np.int64)
            one = np.zeros(len(members), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one + batch.column(0)[i].as_py()), pa.array(one + batch.column(1)[i].as_py()), pa.array(one + batch.column(2)[i].as_py()), pa.array(members)],
                names=["class", "component", "n", "shingle"])


def _rare_cells(member: DataFrame, sets: DataFrame) -> DataFrame:
    """``cell, class, n, useful, place``: the classes of unconnected cells by their rarest shingles.

    ``useful`` of a class's ``n`` shingles are in another component too, and the cell's is at ``place`` among them.

    A class can only link outside its component through shingles that another component has too. It needs 85 % of its own;
    by the order of rarity, one of the first ``n - need + 1`` is common to it and its partner, and shingles
    that nobody outside has may come first.
    """
    open_ = member.select("class", "component").distinct()
    rows = open_.join(sets, "class").select("class", "component", "n", "members").mapInArrow(_shared, "class long, component long, n long, shingle long")
    shared = Window.partitionBy("shingle")
    rows = rows.select(
        "*", F.count(F.lit(1)).over(shared).alias("often"), F.min("component").over(shared).alias("lo"), F.max("component").over(shared).alias("hi")).where("lo <> hi")
    own = Window.partitionBy("class")
    ranked = rows.select("class", "n", "shingle", F.count(F.lit(1)).over(own).alias("useful"), F.row_number().over(own.orderBy("often", "shingle")).alias("rank"))
    need = f"(n * {SHARE[0]} + {SHARE[1] - 1}) div {SHARE[1]}"
    return settled(ranked.where(f"useful >= {need} and rank <= useful - {need} + 1").select(
        F.col("shingle").alias("cell"), "class", "n", "useful", F.col("rank").alias("place")), "jaccard-rare")


def recursion(member: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
    """The components after the cells that one pivot did not connect are joined exactly."""
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("class"))
    member, start = _open_cells(member, groups).withColumn("rank", rank), 2
    member = settled(member, "jaccard-open")
    while not member.isEmpty():
        # The pivots of this round are the next ranks; each is paired with the classes that rank after it.
        pivot = member.where((F.col("rank") >= start) & (F.col("rank") < STEP * start)).select(
            "cell", F.col("class").alias("b"), *(F.col(c).alias(f"{c}_b") for c in ("rank", "far", "component", "n", "useful", "place")))
        near = member.join(pivot, "cell").where("rank > rank_b and component <> component_b and " + POSSIBLE)
        pairs = near.select(F.col("class").alias("a"), "b").distinct()
        more = settled(measured(pairs, sets).where(LINKED).select("a", "b"), "jaccard-links")
        start *= STEP
        groups = merged(groups, more)
        member = settled(_open_cells(member.drop("component"), groups, start), "jaccard-open")
    return groups


def _open_cells(member: DataFrame, groups: DataFrame, start: int = 1) -> DataFrame:
    """Members, with their components, of the cells that have pivots left and more than one component."""
    named = member.join(groups.select(F.col("node").alias("class"), "component"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    several = [F.min("component").alias("lo"), F.max("component").alias("hi")] + ([F.max("rank").alias("most")] if "rank" in member.columns else [])
    still = named.groupBy("cell").agg(*several).where("lo <> hi" + (f" and most > {start}" if "rank" in member.columns else ""))
    return named.join(still.select("cell"), "cell", "left_semi")


def one_of_each(docs: DataFrame, key: str = "doc_id", k: int = 4) -> DataFrame:
    """The rows whose id is the smallest of their group, with their columns.

    Of repeated rows (same id and text) one stays; rows without an id stay.
    """
    found = settled(jaccard_components(docs, key, k).select(F.col(key).alias("id"), "component_id"), "jaccard-groups")
    gone = settled(found.where("id <> component_id").select(F.col("id").alias(key)).distinct(), "jaccard-gone")
    left = docs.join(gone, key, "left_anti")
    again = found.groupBy("id").count().where("id is not null and count > 1").select(F.col("id").alias(key))
    if again.isEmpty():
        return left
    again = settled(again, "jaccard-repeated")
    return left.join(again, key, "left_anti").unionByName(left.join(again, key, "left_semi").dropDuplicates([key, "text"]))
