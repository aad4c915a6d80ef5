"""Near duplicates among embedding vectors: cells of spherical k-means, exact cosines in blocks, one kept per group.

Vectors of different lengths never link; each length is joined within itself.

1. Equal directions are one class with a count; everything after that is about classes.
2. Spherical k-means on a bounded sample (SAMPLE_ROWS over all lengths) gives the centres of each length; a length of up to CELL_ROWS
   classes is one cell. Every vector belongs to the cell of
   its nearest centre. It reaches another cell ``j`` if a link could go over the border: for a partner there,
   ``x . (c_i - c_j) <= |x - y| |c_i - c_j|``, and ``|x - y|`` is at most the chord of the threshold. Only blocks that reach
   each other's cells are compared, and of two cells only vectors whose places along the line between the centres differ by that chord
   at most. No link is lost.
3. Every class is written once, in its cell's blocks of about BLOCK rows; no copy goes to the cells it reaches. Pairs of blocks are read from
   that table without a shuffle and compared by matrix products in tasks
   of bounded memory: an upper bound from some directions first, in single precision, then the cosines in double. A task returns the number of links of each vector and a spanning forest of the links, never the pairs.
4. Connected components of the forests give the groups; the smallest id of each is kept.

Disk: the classes twice (as read, in four bytes a component where the column has them, and in blocks), shuffled once for each, and
ids and prints. It grows with the rows, whatever the cells reach. A task's forest has a row for each linked class of its blocks. The time for
vectors without any structure still grows faster than the rows.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without an id link with
nothing and are kept. Rows with equal ids are vectors of their own. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tallyhouse.llm.components import components
from tallyhouse.operators.staging import settled, shuffles_dropped

THRESHOLD = 0.9
SAMPLE_ROWS = 20_000  # vectors the centres are fitted on, in expectation
CELL_ROWS = 8192
MOST_CELLS = 2048
ROUNDS = 8
BLOCK = 8192
BLOCK_BYTES = 8 << 20  # of long vectors a block has fewer, 1024 at least
STRIP = 256
TILE = 1024  # a product of a strip and a tile stays in a core's cache
SLACK = 1e-4  # far above the error of single precision
EDGE = 1e-9  # far above the error of double precision
DENSE = 0.02  # share of possible pairs from which all are computed together
PASSING = 1e-4  # share of a sample's pairs without a link that may pass the first bound
TURNED = 1024  # longest vectors whose directions are fitted
KEPT_BYTES = 64 << 20  # first bounds that a task keeps
CHECKED = 50_000
WAITING = 1 << 20


def units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The directions of the rows, and which rows have one; each depends on its own row only."""
    x = x.astype(np.float64)
    with np.errstate(all="ignore"):
        most = np.abs(x).max(axis=1)
        x /= most[:, None]
        x = x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None] + 0.0  # no negative zeros: equal directions have equal bytes
    return x, np.isfinite(most) & (most > 0)


def unit(values: list | None) -> np.ndarray | None:
    """The direction of a vector, or None if it has none."""
    if not values or any(v is None for v in values):
        return None
    x, ok = units(np.array([values], np.float64))
    return x[0] if ok[0] else None


def cut(x: np.ndarray) -> list[bytes]:
    """The bytes of each row."""
    data, width = x.tobytes(), x.shape[1] * x.itemsize
    return [data[k : k + width] for k in range(0, len(data), width)]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists, known = batch.column(1), batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts, values = np.cumsum(lengths) - lengths, lists.flatten()
        values = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False)
        prints, raw = np.full(len(lengths), None, object), np.full(len(lengths), None, object)
        for size in np.unique(lengths[known & (lengths > 0)]).tolist():
            at = np.flatnonzero(known & (lengths == size))
            x = values[starts[at][:, None] + np.arange(size)]
            found, ok = units(x)
            at, x, found = at[ok], x[ok], found[ok]
            prints[at], raw[at] = [hashlib.blake2b(d, digest_size=16).digest() for d in cut(found)], cut(x)
        sizes = pa.array(lengths, pa.int32(), mask=np.equal(prints, None))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary()), sizes, pa.array(raw, pa.binary())], names=["vec_id", "print", "size", "raw"])


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row."""
    return np.concatenate([(x[k : k + TILE] @ centres.T).argmax(axis=1) for k in range(0, len(x), TILE)])


def spherical_means(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centres: start from spread-out rows of the sample, then move to the mean directions of the cells."""
    chosen, far = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(cells, len(sample)):
        far = np.minimum(far, 1 - sample @ sample[chosen[-1]])
        chosen.append(int(far.argmax()))
    centres = sample[chosen]
    for _ in range(ROUNDS):
        home = nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        size = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def reached(x: np.ndarray, home: int, cells: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which of the cells each row of one cell reaches, as rows by cells."""
    away = centres[home] - centres[cells]
    return x @ away.T <= np.sqrt(2 - 2 * THRESHOLD) * np.sqrt((away**2).sum(axis=1)) + EDGE


def head(x: np.ndarray, basis: np.ndarray | None) -> np.ndarray:
    """Some components of each row and the length of the rest as one more: products of these are never below the cosine."""
    first = x[:, : x.shape[1] // 2] if basis is None else x @ basis
    return np.hstack([first, np.sqrt(np.maximum(0, 1 - (first**2).sum(axis=1)))[:, None]])


def basis_of(sample: np.ndarray) -> np.ndarray | None:
    """Directions in which the sample is longest, as many as make its pairs without a link fail the first bound."""
    if sample.shape[1] > TURNED:
        return None
    turn = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
    some = sample[:1000]
    apart, most = some @ some.T < THRESHOLD, PASSING * len(some) ** 2
    for k in (n for power in range(3, 10) for n in (1 << power, 3 << power - 1) if n < len(turn)):
        short = head(some, turn[:, :k])
        if np.count_nonzero((short @ short.T >= THRESHOLD) & apart) <= most:
            return turn[:, :k].copy()
    return turn


def samples_of(marked: DataFrame, one: DataFrame, kind: str) -> dict[int, tuple[int, np.ndarray]]:
    """Classes and a sample of directions of each length with more than CELL_ROWS classes."""
    large = {r["size"]: r["count"] for r in one.groupBy("size").count().where(F.col("count") > CELL_ROWS).collect()}
    if not large:
        return {}
    part = {size: max(1, int(min(1.0, SAMPLE_ROWS / len(large) / n) * (1 << 30))) for size, n in large.items()}
    limit = F.create_map(*(F.lit(x) for pair in part.items() for x in pair))[F.col("size")]
    place = F.pmod(F.xxhash64("print", F.lit("sample")), F.lit(1 << 30))
    chosen = one.where(F.col("size").isin(list(large))).where(place < limit).select("print", "id")
    picked = marked.join(F.broadcast(chosen), (marked["print"] == chosen["print"]) & (F.col("vec_id") == F.col("id")))
    rows = {bytes(r["print"]): (r["size"], r["raw"]) for r in picked.select(marked["print"], "size", "raw").collect()}
    found = {}
    for size, n in large.items():
        raw = [rows[k][1] for k in sorted(rows) if rows[k][0] == size]
        if raw:  # else one cell, cut into blocks
            found[size] = n, units(np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1))[0]
    return found


def placed(classes: DataFrame, centres: dict[int, np.ndarray], kind: str) -> DataFrame:
    """``cell, size, id, n, raw``: each class once, in its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            cell = np.zeros(len(sizes), np.int32)
            for size in np.unique(sizes).tolist():
                if size in centres:
                    at = np.flatnonzero(sizes == size)
                    own = b"".join(batch.column(3).take(pa.array(at)).to_pylist())
                    cell[at] = nearest(units(np.frombuffer(own, kind).reshape(len(at), -1))[0], centres[size])
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", "size", "id", "n", "raw"])

    return classes.select("size", "id", "n", "raw").mapInArrow(run, "cell int, size int, id long, n long, raw binary")


def packing(centres: dict[int, np.ndarray], kind: str) -> Callable[[pa.Table], pa.Table]:
    """Makes one row of a block's rows; ``reach``: the cells that any of them reaches."""

    def run(rows: pa.Table) -> pa.Table:
        size, cell, block = (rows.column(c)[0].as_py() for c in ("size", "cell", "block"))
        raw, reach = b"".join(rows.column("raw").to_pylist()), np.array([cell])
        if size in centres:
            x, cells = np.frombuffer(raw, kind).reshape(rows.num_rows, -1), np.arange(len(centres[size]))
            parts = (reached(units(x[k : k + TILE])[0], cell, cells, centres[size]) for k in range(0, len(x), TILE))
            reach = np.flatnonzero(sum(part.sum(axis=0) for part in parts) + (cells == cell))
        ids, n = (rows.column(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "n"))
        return pa.table({
            "size": pa.array([size], pa.int32()), "cell": pa.array([cell], pa.int32()), "block": pa.array([block], pa.int64()),
            "reach": pa.array([reach.tolist()], pa.list_(pa.int32())), "ids": pa.array([ids], pa.binary()), "n": pa.array([n], pa.binary()), "raw": pa.array([raw], pa.binary())})

    return run


PACKED = "size int, cell int, block long, reach array<int>, ids binary, n binary, raw binary"


def packs_of(classes: DataFrame, centres: dict[int, np.ndarray], kind: str) -> DataFrame:
    """Each class in one block of its cell; a block is one row."""
    most = F.least(F.lit(BLOCK), F.greatest(F.lit(1024), F.floor(F.lit(BLOCK_BYTES) / (F.col("size") * np.dtype(kind).itemsize))))
    blocks = classes.groupBy("size", "cell").count().select("size", "cell", F.ceil(F.col("count") / most).alias("blocks"))
    dealt = classes.join(F.broadcast(blocks), ["size", "cell"])  # at most MOST_CELLS rows for each length
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("raw", F.lit("block")), F.col("blocks")))
    return dealt.groupBy("size", "cell", "block").applyInArrow(packing(centres, kind), PACKED)


def pairs_of(packs: DataFrame) -> DataFrame:
    """Each pair of blocks whose cells reach each other, one way round, and each block with itself.

    Tasks read the parts of the table that they pair, as a Cartesian product does; nothing is shuffled.
    """
    left, right = (packs.select(*(F.col(c).alias(side + c) for c in packs.columns)) for side in ("a_", "b_"))
    cells, blocks = (F.col("a_cell"), F.col("b_cell")), (F.col("a_block"), F.col("b_block"))
    same, less = ((cells[0] == cells[1]) & (blocks[0] == blocks[1])), ((cells[0] < cells[1]) | ((cells[0] == cells[1]) & (blocks[0] < blocks[1])))
    turn = F.pmod(F.xxhash64("a_cell", "a_block").bitwiseXOR(F.xxhash64("b_cell", "b_block")), F.lit(2)) == 0  # either way round alike: tasks get equal shares
    meet = F.array_contains("a_reach", cells[1]) & F.array_contains("b_reach", cells[0])
    return left.hint("shuffle_replicate_nl").join(right, (F.col("a_size") == F.col("b_size")) & (same | (turn == less)) & meet)


def linked_rows(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of two tables link with each other, in double precision and in one order of summation."""
    return np.einsum("nd,nd->n", x, y) >= THRESHOLD


def linked_matrix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of ``x`` link with which of ``y``.

    Products of whole matrices only rule out and in what is clear; sums of one fixed order decide within EDGE of the threshold, so
    that a pair's verdict doesn't depend on the others in its block.
    """
    near = x @ y.T
    clear = near >= THRESHOLD + EDGE
    i, j = np.nonzero((near >= THRESHOLD - EDGE) & ~clear)
    ok = linked_rows(x[i], y[j])
    clear[i[ok], j[ok]] = True
    return clear


def linked_pairs(x: np.ndarray, y: np.ndarray, possible: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs that link, among the possible ones."""
    if possible.mean() > DENSE:
        return np.nonzero(linked_matrix(x, y))
    i, j = np.nonzero(possible)
    ok = np.concatenate([linked_rows(x[i[k : k + CHECKED]], y[j[k : k + CHECKED]]) for k in range(0, len(i), CHECKED)] or [np.zeros(0, bool)])
    return i[ok], j[ok]


def key_of(batch: pa.RecordBatch, k: int, side: str) -> tuple[int, int, int]:
    return tuple(batch.column(side + c)[k].as_py() for c in ("size", "cell", "block"))


class Block:
    """A block of one cell."""

    def __init__(self, batch: pa.RecordBatch, k: int, side: str, kind: str) -> None:
        self.key = self.size, self.cell, _ = key_of(batch, k, side)
        ids, n, raw = (batch.column(side + c)[k].as_py() for c in ("ids", "n", "raw"))
        self.ids, self.n = np.frombuffer(ids, np.int64), np.frombuffer(n, np.int64)
        self.raw = np.frombuffer(raw, kind).reshape(len(self.n), -1)
        self.whole: np.ndarray | None = None

    def units(self, at: np.ndarray | slice) -> np.ndarray:
        """The directions of some rows."""
        return units(self.raw[at])[0] if self.whole is None else self.whole[at]

    def keep(self) -> np.ndarray:
        """All directions, kept from now on."""
        if self.whole is None:
            self.whole = units(self.raw)[0]
        return self.whole


class Links:
    """The links of a task: their number for each class, and a forest of them."""

    def __init__(self) -> None:
        self.blocks: dict[tuple, tuple[int, np.ndarray, np.ndarray]] = {}
        self.root, self.waiting, self.size = np.zeros(0, np.int64), [], 0

    def place(self, block: Block) -> tuple[int, np.ndarray]:
        """The number of the first class of a block, and the links of its classes so far."""
        if block.key not in self.blocks:
            first, n = len(self.root), len(block.ids)
            self.blocks[block.key] = first, np.zeros(n, np.int64), block.ids
            self.root = np.append(self.root, np.arange(first, first + n))
        return self.blocks[block.key][:2]

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        self.waiting.append((i, j))
        self.size += len(i)
        if self.size >= WAITING:
            self.join()

    def join(self) -> None:
        """Hang the root of each end on the smaller one until both ends of every link have the same."""
        i, j = (np.concatenate([x[k] for x in self.waiting] or [np.zeros(0, np.int64)]) for k in (0, 1))
        self.waiting, self.size = [], 0
        while True:
            x, y = self.root[i], self.root[j]
            differ = x != y
            if not differ.any():
                return
            i, j, x, y = i[differ], j[differ], x[differ], y[differ]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(above := self.root[self.root], self.root):
                self.root = above

    def tables(self) -> Iterator[pa.RecordBatch]:
        """``id, links, root`` of the classes with links."""
        self.join()
        ids = np.concatenate([own for _, _, own in self.blocks.values()] or [np.zeros(0, np.int64)])
        for first, count, own in self.blocks.values():
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(own[at]), pa.array(count[at]), pa.array(ids[self.root[first + at]])], names=["id", "links", "root"])


def scales(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest component of each row, and its length in units of that."""
    most = np.abs(raw).max(axis=1)
    x = raw.astype(np.float64) / most[:, None]
    return most, np.sqrt(np.einsum("nd,nd->n", x, x))


def along(block: Block, scale: tuple[np.ndarray, np.ndarray], e: np.ndarray) -> np.ndarray:
    """The components of a block's directions along ``e``, in the precision in which it was read."""
    return (block.raw / scale[0][:, None]) @ e.astype(block.raw.dtype) / scale[1]


def padded(short: np.ndarray) -> np.ndarray:
    """With rows of zeros up to whole tiles: they link with nothing."""
    return np.vstack([short, np.zeros((-len(short) % TILE, short.shape[1]), np.float32)])


def compare(a: Block, b: Block, bound_a: tuple, bound_b: tuple, centres: np.ndarray | None, links: Links) -> None:
    """Add the links of two blocks; ``bound``: the first bounds, padded, and scales.

    Linked directions differ by the chord of the threshold at most, so along the line between two centres too. In the order of that line each
    strip of one cell has its partners at the start of the other.
    """
    same, rows_a, rows_b, ends = np.bool_(a.key == b.key), np.arange(len(a.n)), np.arange(len(b.n)), None
    (short_a, *scale_a), (short_b, *scale_b) = bound_a, bound_b
    if a.cell != b.cell and (centres[a.cell] != centres[b.cell]).any():
        e = centres[a.cell] - centres[b.cell]
        e = e / np.sqrt(e @ e)
        at, to = along(a, scale_a, e), along(b, scale_b, e)
        chord = np.sqrt(2 - 2 * THRESHOLD) + SLACK
        rows_a, rows_b = np.flatnonzero(at <= to.max() + chord), np.flatnonzero(to >= at.min() - chord)
        rows_a, rows_b = rows_a[np.argsort(at[rows_a])], rows_b[np.argsort(-to[rows_b])]
        ends = np.searchsorted(-to[rows_b], chord - at[rows_a[::STRIP]], side="right")
        short_a, short_b = padded(short_a[rows_a]), padded(short_b[rows_b])
    (first_a, count_a), (first_b, count_b) = links.place(a), links.place(b)

    def check(maybe: list[tuple[np.ndarray, np.ndarray]]) -> None:
        i, j = rows_a[np.concatenate([i for i, _ in maybe])], rows_b[np.concatenate([j for _, j in maybe])]
        ok = linked_rows(a.units(i), b.units(j)) & (~same | (i < j))
        i, j = i[ok], j[ok]
        count_a[:] += np.bincount(i, weights=b.n[j], minlength=len(a.n)).astype(np.int64)
        count_b[:] += np.bincount(j, weights=a.n[i], minlength=len(b.n)).astype(np.int64)
        links.add(first_a + i, first_b + j)

    def check_all(i: np.ndarray, j: np.ndarray) -> None:
        hits = linked_matrix(a.keep()[i], b.keep()[j])
        if same:
            hits &= i[:, None] < j
        count_a[i] += (hits.astype(np.float64) @ b.n[j]).astype(np.int64)
        count_b[j] += (a.n[i] @ hits.astype(np.float64)).astype(np.int64)
        x, y = np.nonzero(hits & (links.root[first_a + i][:, None] != links.root[first_b + j]))
        links.add(first_a + i[x], first_b + j[y])

    products, flags = np.empty(STRIP * TILE, np.float32), np.empty(STRIP * TILE, bool)
    least, maybe, waiting = np.float32(THRESHOLD - SLACK), [], 0
    for first in range(0, len(rows_a), STRIP):
        strip = short_a[first : first + STRIP]
        end = len(rows_b) if ends is None else ends[first // STRIP]
        for start in range(first // TILE * TILE if same else 0, end, TILE):
            tile = short_b[start : start + min(TILE, end - start + -(end - start) % 64)]
            shape = len(strip), len(tile)
            near, possible = (x[: shape[0] * shape[1]].reshape(shape) for x in (products, flags))
            np.dot(strip, tile.T, out=near)
            np.greater_equal(near, least, out=possible)
            count = np.count_nonzero(possible)
            if count > DENSE * possible.size:
                check_all(rows_a[first : first + len(strip)], rows_b[start : start + len(tile)])
            elif count:
                some = np.flatnonzero(possible.view(np.uint64) != 0)  # eight at a time: most are without any
                at, within = np.nonzero(possible.reshape(-1, 8)[some])
                i, j = np.divmod(some[at] * 8 + within, len(tile))
                maybe.append((i + first, j + start))
                waiting += count
            if waiting >= CHECKED:
                check(maybe)
                maybe, waiting = [], 0
    if maybe:
        check(maybe)


def comparing(centres: dict[int, np.ndarray], bases: dict[int, np.ndarray | None], kind: str) -> Callable:
    """Compares the pairs of blocks of a task; what it found about a block comes once, at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, a, bound_a, kept, free = Links(), None, None, {}, KEPT_BYTES

        def bound(block: Block) -> tuple:
            nonlocal free
            if block.key in kept:
                return kept[block.key]
            parts = (head(block.units(slice(k, k + TILE)), bases.get(block.size)).astype(np.float32) for k in range(0, len(block.n), TILE))
            made = padded(np.vstack(list(parts))), *scales(block.raw)
            if (size := sum(x.nbytes for x in made)) <= free:
                kept[block.key], free = made, free - size
            return made

        for batch in batches:
            for k in range(batch.num_rows):
                if a is None or key_of(batch, k, "a_") != a.key:
                    a = Block(batch, k, "a_", kind)
                    bound_a = bound(a)
                b = Block(batch, k, "b_", kind)
                compare(a, b, bound_a, bound(b), centres.get(a.size), links)
        yield from links.tables()

    return run


def vector_groups(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key, n_links, component_id, kept`` of every row."""
    raw = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{column}`").alias("v"))
    kind = "f4" if isinstance(getattr(raw.schema["v"].dataType, "elementType", None), FloatType) else "f8"
    raw = raw if kind == "f4" else raw.withColumn("v", F.col("v").cast("array<double>"))
    marked = raw.mapInArrow(_units, "vec_id long, print binary, size int, raw binary")
    with shuffles_dropped(vectors.sparkSession):
        rows = settled(marked.select("vec_id", "print", "size"), "vectors")
        valid = rows.where("size is not null")
        if valid.isEmpty():
            return rows.select(F.col("vec_id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
        one = settled(valid.groupBy("print").agg(F.min("size").alias("size"), F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")), "vector-prints")
        samples = samples_of(marked, one, kind)
        bases = {size: basis_of(sample) for size, (_, sample) in samples.items()}
        centres = {size: spherical_means(sample, max(1, min(MOST_CELLS, -(-n // CELL_ROWS)))) for size, (n, sample) in samples.items()}
        del samples

        held = marked.where("size is not null").select("print", F.col("vec_id").alias("id"), "raw")
        classes = held.join(one, ["print", "id"]).dropDuplicates(["print", "id"])  # a print has one id in the table it is joined with
        classes = settled(placed(classes, centres, kind), "vector-classes")
        packs = settled(packs_of(classes, centres, kind), "vector-blocks")
        found = settled(pairs_of(packs).mapInArrow(comparing(centres, bases, kind), "id long, links long, root long"), "vector-links")
        groups = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")), "vector-components")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = one.select("print", "id", "n").join(links, "id", "left")
    named = named.join(groups.select(F.col("node").alias("id"), "component"), "id", "left")
    named = named.select("print", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.select("vec_id", "print").join(named, "print", "left")
    out = out.select(F.col("vec_id").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
