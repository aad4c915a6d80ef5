"""How the sources of a language differ: exact divergences from a quadtree over the matrix of groups and terms.

A group is a source of a language. Every task reads a tile of the count matrix, that is all groups (or two
blocks of them) by a share of the terms, as a quadtree with two halves a side, in which a quadrant without counts is not
stored. Two groups meet only where both have a stored quadrant over the same terms: pairs of nodes are
followed down together, from the root, to the terms that both have. All else is uniform, as every term that a group
lacks has the same smoothed share there, and is priced by formula from the number of terms, and from how many
terms of a group have which share (`_priced`). Sums are exact: all figures are whole numbers.

Defined results: null texts, languages and sources count as ''; a group without kept terms has the even share
of all terms; a language without kept terms gives pairs of value 0; repeated rows count again; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.terms import LETTERS, counted, terms
from tallyhouse.llm.words import slices
from tallyhouse.operators.staging import settled

#: A kept term occurs in this many documents of its language.
DOCUMENTS = 3
#: Shares are whole numbers of this size, one at least.
SCALE = 1_000_000_000
#: Counts in a tile, about, and groups in a block.
TILE_COUNTS = 1 << 16
BLOCK = 1024
#: Pairs of nodes followed at once.
PAIRS = 1 << 18
TERM_RANKS = 200


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, docs`` of each batch."""
    for batch in batches:
        parts = []
        for first, texts in slices(batch.column(2)):
            names = list(zip(*(batch.column(i).slice(first, texts.n).to_pylist() for i in (0, 1))))
            of = {name: i for i, name in enumerate(dict.fromkeys(names))}
            group = np.array([of[name] for name in names], np.int64)
            words, number, owner = terms(texts, LETTERS)
            if not len(words):
                continue
            in_text, n = counted(owner * len(words) + number)
            keys = group[in_text // len(words)] * len(words) + in_text % len(words)
            order = np.argsort(keys, kind="stable")
            cell, at, docs = np.unique(keys[order], return_index=True, return_counts=True)
            kinds = list(of)
            which = cell // len(words)
            parts.append(pa.RecordBatch.from_arrays([
                *(pa.array([k[i] for k in kinds], pa.string()).take(pa.array(which)) for i in (0, 1)),
                words.take(pa.array(cell % len(words))).cast(pa.string()),
                pa.array(np.add.reduceat(n[order], at)), pa.array(docs.astype(np.int64)),
            ], names=["lang", "source", "term", "n", "docs"]))
        if parts:
            whole = pa.Table.from_batches(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
            whole = whole.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])
            yield from whole.combine_chunks().to_batches()


def _name(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)


def counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, lang_n, first``: the occurring counts of kept terms; ``first`` holds once for each term of a language."""
    rows = docs.select(_name("lang"), _name("source"), "text").mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    cells = rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # A window holds one row for each source of the language that has the term.
    term = Window.partitionBy("lang", "term")
    return cells.select(
        "lang", "source", "term", "n", F.sum("docs").over(term).alias("lang_docs"), F.sum("n").over(term).alias("lang_n"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
    ).where(F.col("lang_docs") >= DOCUMENTS).drop("lang_docs")


def _share(n: str, total: str) -> Column:
    """The smoothed share of ``n`` of ``total`` occurrences, over ``v`` terms; decimals, as the product may pass 64 bits."""
    return F.expr(f"CASE WHEN v > 0 THEN 1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + 1 AS DECIMAL(20, 0))) div CAST({total} + v AS DECIMAL(20, 0)) END")


def groups(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """``lang, source, total, stored, v, lang_total, lang_stored, number, empty`` of every occurring group.

    ``total`` counts occurrences and ``stored`` terms, ``v`` the kept terms of the language, ``number`` runs within the language,
    ``empty`` is the share of a term that the group lacks.
    """
    sums = cells.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("stored"), F.count_if("first").alias("firsts"))
    every = docs.select(_name("lang"), _name("source")).distinct()
    lang = Window.partitionBy("lang")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    found = every.join(sums, ["lang", "source"], "left").select(
        "lang", "source", zero("total").alias("total"), zero("stored").alias("stored"), F.sum(zero("firsts")).over(lang).alias("v"),
        F.sum(zero("total")).over(lang).alias("lang_total"), F.sum(zero("stored")).over(lang).alias("lang_stored"),
        (F.row_number().over(lang.orderBy("source")) - 1).alias("number"),
    )
    return found.withColumn("empty", _share("0", "total"))


def _price(p: str, q: str) -> str:
    """How far a share is from another, as SQL."""
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _priced(cells: DataFrame, found: DataFrame) -> DataFrame:
    """``lang, a, b, value``: what pairs cost outside of the terms both have, as sums and differences of uniform parts.

    Every term is first taken as lacking in both; then each term that one of them has is counted with the other lacking
    it, by the number of terms with the same share. Terms that both have are put right by `_joint`.
    """
    one = found.select("lang", F.col("number").alias("a"), F.col("empty").alias("za"), "v")
    other = found.select("lang", F.col("number").alias("b"), F.col("empty").alias("zb"))
    both = one.join(other, "lang").where("a <> b")
    none = both.select("lang", "a", "b", F.expr(f"coalesce(v * {_price('za', 'zb')}, 0)").alias("value"))
    shares = cells.groupBy("lang", "number", "p").agg(F.count(F.lit(1)).alias("n"))
    shares = shares.join(found.select("lang", "number", F.col("empty").alias("z")), ["lang", "number"])
    left = shares.select("lang", F.col("number").alias("a"), "p", "n", F.col("z").alias("za")).join(other, "lang").where("a <> b")
    left = left.select("lang", "a", "b", F.expr(f"n * ({_price('p', 'zb')} - {_price('za', 'zb')})").alias("value"))
    right = shares.select("lang", F.col("number").alias("b"), "p", "n", F.col("z").alias("zb")).join(one.drop("v"), "lang").where("a <> b")
    right = right.select("lang", "a", "b", F.expr(f"n * ({_price('za', 'p')} - {_price('za', 'zb')})").alias("value"))
    return none.unionByName(left).unionByName(right)


def interleaved(column: np.ndarray, row: np.ndarray, levels: int) -> np.ndarray:
    """Quadtree order: from the top, the bit of the column and that of the row at each level."""
    key = np.zeros(len(column), np.int64)
    for level in range(levels - 1, -1, -1):
        key = key << 2 | (column >> level & 1) << 1 | row >> level & 1
    return key


def common_cells(column: np.ndarray, row: np.ndarray, levels: int, side_bit: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of stored cells, as positions, in the same column and different rows; cells are in quadtree order and differ.

    Nodes of a level are runs of cells. Pairs of nodes over the same columns are replaced by pairs of their
    children, from the root on; a pair has no children where one of the two stores nothing. With ``side_bit``, only
    rows that differ from that bit on upwards are paired.
    """
    key = interleaved(column, row, levels)
    starts = [np.flatnonzero(np.concatenate(([True], (key[1:] >> 2 * s) != (key[:-1] >> 2 * s)))) for s in range(levels, -1, -1)]
    stack = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64))] if len(key) else []
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        if level == levels:
            apart = a != b
            if apart.any():
                yield a[apart], b[apart]
            continue
        above, below, shift = starts[level], starts[level + 1], levels - level - 1
        child = np.searchsorted(below, np.append(above, len(key)))
        # Which column half, and which side, each child is on.
        half, side = key[below] >> 2 * shift + 1 & 1, row[below] >> (side_bit or 0)
        lefts, rights = [], []
        for i in range(4):
            for j in range(4):
                x, y = child[a] + i, child[b] + j
                ok = np.flatnonzero((x < child[a + 1]) & (y < child[b + 1]) & ((a != b) | (x <= y)))
                x, y = x[ok], y[ok]
                ok = half[x] == half[y]
                if side_bit is not None and shift <= side_bit:
                    ok &= side[x] != side[y]
                lefts.append(x[ok])
                rights.append(y[ok])
        a, b = np.concatenate(lefts), np.concatenate(rights)
        if len(a):
            stack.append((level + 1, a, b))


def _tile(table: pa.Table) -> pa.Table:
    """``lang, a, b, value`` of a tile: for the terms both have, the true price less what `_priced` took for them."""
    numbers = table.column("number").to_numpy()
    blocks = np.unique(np.array([table.column("low")[0].as_py(), table.column("high")[0].as_py()]))
    held = np.searchsorted(blocks, numbers // BLOCK) * BLOCK + numbers % BLOCK
    words = table.column("term").combine_chunks().dictionary_encode()
    order = np.argsort(-np.bincount(words.indices.to_numpy()), kind="stable")  # frequent terms side by side
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    column = place[words.indices.to_numpy()]
    used, row = np.unique(held, return_inverse=True)
    if len(blocks) > 1:
        row = held
    levels = max(int(x.max()).bit_length() for x in (column, row))
    order = np.argsort(interleaved(column, row, levels), kind="stable")
    column, row, held = column[order], row[order], held[order]
    p, z = (table.column(c).to_numpy()[order] for c in ("p", "empty"))
    size = len(used)
    local = np.searchsorted(used, held)
    sums = np.zeros(size * size, np.int64)
    price = lambda p, q: (p - q) * (p - q) // q
    for a, b in common_cells(column, row, levels, BLOCK.bit_length() - 1 if len(blocks) > 1 else None):
        for x, y in ((a, b), (b, a)):
            np.add.at(sums, local[x] * size + local[y], price(p[x], p[y]) - price(p[x], z[y]) - price(z[x], p[y]) + price(z[x], z[y]))
    at = np.flatnonzero(sums)
    back = blocks[used // BLOCK] * BLOCK + used % BLOCK
    lang = pa.array([table.column("lang")[0].as_py()], pa.string())
    return pa.table({
        "lang": lang.take(pa.array(np.zeros(len(at), np.int64))), "a": pa.array(back[at // size].astype(np.int32)),
        "b": pa.array(back[at % size].astype(np.int32)), "value": pa.array(sums[at]),
    })


def _joint(cells: DataFrame) -> DataFrame:
    """``lang, a, b, value`` from the tiles. With many groups, each pair of blocks of them is a tile of its own."""
    tiles = f"greatest(1, cast(ceil(lang_stored / {TILE_COUNTS}) as long))"
    dealt = cells.select(
        "lang", "term", "number", "p", "empty", F.expr(f"pmod(xxhash64(term), {tiles})").alias("tile"), F.expr(f"number div {BLOCK}").alias("block"),
        F.explode(F.expr(f"sequence(0L, (groups - 1) div {BLOCK})")).alias("other"),
    )
    dealt = dealt.select(
        "lang", "tile", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "term", "number", "p", "empty")
    return dealt.groupBy("lang", "tile", "low", "high").applyInArrow(_tile, "lang string, a int, b int, value long")


def _ranked(rows: DataFrame) -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))


def audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each group is from every other one, and its most excessive terms."""
    kept = settled(counts(docs), "term-counts")
    found = settled(groups(docs, kept), "term-groups")
    size = F.count(F.lit(1)).over(Window.partitionBy("lang")).alias("groups")
    cells = kept.join(found.select("*", size), ["lang", "source"]).withColumns({"p": _share("n", "total"), "q": _share("lang_n", "lang_total")})
    pairs = _priced(cells, found).unionByName(_joint(cells)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    names = found.select("lang", "number", "source")
    pairs = pairs.join(names.withColumnRenamed("number", "a"), ["lang", "a"])
    pairs = pairs.join(names.select("lang", F.col("number").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    over = cells.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_price("p", "q")).alias("value"))
    over = over.withColumn("rank", _ranked(over)).where(F.col("rank") <= TERM_RANKS)
    return pairs.withColumn("rank", _ranked(pairs)).unionByName(over)
