"""Token ids as binary files: whole texts encoded, coded in blocks, and read back.

A file is a Parquet table of blocks in the shared folder: ``part, block, data``. Parts are ranges of document ids
in ascending order; the blocks of a part hold its ids one after the other. Each block's ``data`` is complete in itself:

    magic "TKB3", then as unsigned 32-bit numbers: crc32 of all that follows, steps, ids held, fragments,
    bytes of fragments, bytes of code; then the fragments, then the code.

A fragment is what a document has in the block: its number in the part (32 bits), its id (64), whether it has one (8), and how many
ids it has there (32). Blocks have BLOCK_IDS ids, so that a long document lies in several and none is too large;
the last few of a task are a little shorter. The code is that of `range_coder`, which starts anew in every block.

Defined results: a null or empty text has only the end id; null ids come first; rows with equal ids are documents
of their own, ordered by a hash of their text, and as they come if that is equal too; other columns are not written; a
damaged block raises an error.
"""

from __future__ import annotations

import os
import struct
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.range_coder import decode_lanes, encode_lanes
from tallyhouse.operators.staging import settled

MAGIC = b"TKB3"
HEAD = "<4s6I"
HEAD_BYTES = struct.calcsize(HEAD)
FRAGMENT = np.dtype([("number", "<u4"), ("id", "<i8"), ("has_id", "u1"), ("n", "<u4")])
BLOCK_IDS = 4096
LANES = 2048
KNOWN_PIECES = 400_000
JOINED = 100


class Encoder:
    """Whole texts to ids (16-bit numbers) with the tokenizers library.

    A piece after a single space and before another is encoded alike in any text, so that of many texts every different piece is
    encoded once; pieces met twice are kept for the texts that follow. Where a space stands beside other white space, the library
    gets the whole text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit in 16 bits")
        self.known: dict[str, bytes] = {}
        # Which ids stand for a text that starts with a space (the byte-level sign for it).
        self.starts = np.zeros(1 << 16, bool)
        self.starts[[i for token, i in self.library.get_vocab().items() if token.startswith("\u0120")]] = True

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, texts: pa.Array, end: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each with those of ``end`` after it, and how many each has. Null is empty."""
        if not len(texts):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        texts, after = texts.fill_null(""), np.array(end, np.uint16)
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy()
        heads = bounds[:-1] - bounds[0]
        coded = split.flatten().dictionary_encode()
        pieces, index = coded.dictionary.to_pylist(), coded.indices.to_numpy().copy()
        first = index[heads]
        spaced = self.spaced(pieces, np.bincount(index, minlength=len(pieces)) - np.bincount(first, minlength=len(pieces)))
        odd = np.array([ids is None for ids in spaced])[index]
        alone = [pieces[i] for i in first.tolist()]
        odd[heads] = [piece[-1:].isspace() for piece in alone]
        odd = np.logical_or.reduceat(odd, heads)
        for i, text in zip(np.flatnonzero(odd).tolist(), texts.filter(pa.array(odd)).to_pylist()):
            alone[i] = text
        # In place of its first piece, a text has the end of the one before, and the ids of that piece or of the whole odd text.
        begins = [after.tobytes() * (i > 0) + ids for i, ids in enumerate(self.ids(alone))]
        index[heads] = np.arange(len(pieces), len(pieces) + len(heads))
        parts = [ids or b"" for ids in spaced] + begins
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 2
        n = sizes[index]
        n[np.repeat(odd, np.diff(bounds)) & (index < len(pieces))] = 0
        ids = np.frombuffer(b"".join(parts), np.uint16).take(places((np.cumsum(sizes) - sizes)[index], n))
        total = np.add.reduceat(n, heads)
        total[0] += len(after)  # the others have as many of the text before
        return np.concatenate((ids, after)), total

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint16).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def spaced(self, pieces: list[str], times: np.ndarray) -> list[bytes | None]:
        """The ids of pieces after a space, or none where they depend on what is beside them; empty where that occurs zero times."""
        found = [ids if n else b"" for ids, n in zip(map(self.known.get, pieces), times.tolist())]
        new = [i for i, ids in enumerate(found) if ids is None and (p := pieces[i]) and not p[0].isspace() and not p[-1].isspace()]
        for at in range(0, len(new), JOINED * JOINED):
            some = [new[i : i + JOINED] for i in range(at, min(at + JOINED * JOINED, len(new)), JOINED)]
            for own, data in zip(some, self.ids(["".join([" " + pieces[i] for i in own]) for own in some])):
                # Of joined pieces the ids of each start where an id starts with a space, and only there.
                starts = (2 * np.flatnonzero(self.starts[np.frombuffer(data, np.uint16)])).tolist()
                if len(starts) == len(own):
                    cut = [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]
                else:
                    cut = self.ids([" " + pieces[i] for i in own])
                for i, ids in zip(own, cut):
                    found[i] = ids
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        again = (times > 1).tolist()
        self.known.update((pieces[i], found[i]) for i in new if again[i])
        return found


def places(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``at[i], at[i] + 1, ...`` for ``sizes[i]`` places, one after the other."""
    ends = np.cumsum(sizes)
    kind = np.int32 if ends[-1] < 1 << 31 else np.int64
    found = np.repeat((at - (ends - sizes)).astype(kind), sizes)
    found += np.arange(ends[-1], dtype=kind)
    return found


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, kept by a Python worker from task to task."""
    kept = sys.modules.setdefault("_kept_token_encoders", types.ModuleType("_kept_token_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def pack(ids: np.ndarray, fragments: list[tuple[int, int, int, int]]) -> list[bytes]:
    """Blocks of equal length for consecutive ids. ``fragments``: number, id, has id, ids of each document."""
    blocks = max(1, -(-len(ids) // BLOCK_IDS))
    steps = -(-len(ids) // blocks)
    by_step = np.zeros((steps, blocks), np.uint16)
    whole, last = divmod(len(ids), max(1, steps))
    by_step[:, :whole] = ids[: whole * steps].reshape(whole, steps).T
    if last:
        by_step[:last, whole] = ids[whole * steps :]
    codes = encode_lanes(by_step)
    found, at, left = [], 0, list(fragments[:1])
    for i, code in enumerate(codes):
        room = held = max(0, min(steps, len(ids) - i * steps))
        own = []
        while room:
            number, key, has, n = left[0] if left else fragments[at]
            take = min(n, room)
            own.append((number, key, has, take))
            room -= take
            at += take == n
            left = [(number, key, has, n - take)] if take < n else []
        index = np.array(own, FRAGMENT).tobytes()
        rest = struct.pack("<5I", steps, held, len(own), len(index), len(code)) + index + code
        found.append(MAGIC + struct.pack("<I", zlib.crc32(rest)) + rest)
    return found


def unpack(blocks: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Fragments and ids of each block, in order."""
    heads = []
    for data in blocks:
        magic, crc, steps, held, _, index, code = struct.unpack_from(HEAD, data)
        if magic != MAGIC or len(data) != HEAD_BYTES + index + code or zlib.crc32(memoryview(data)[8:]) != crc:
            raise ValueError("damaged block of token ids")
        heads.append((steps, held, index))
    at = 0
    while at < len(blocks):
        steps = heads[at][0]
        end = at
        while end < len(blocks) and heads[end][0] == steps and end - at < LANES:
            end += 1
        ids = np.ascontiguousarray(decode_lanes([b[HEAD_BYTES + h[2] :] for b, h in zip(blocks[at:end], heads[at:end])], steps).T)
        for i in range(at, end):
            _, held, index = heads[i]
            yield np.frombuffer(blocks[i], FRAGMENT, index // FRAGMENT.itemsize, HEAD_BYTES), ids[i - at, :held]
        at = end


def write(docs: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id") -> DataFrame:
    """The written file, as a frame ``part, block, at, n, data``; ``at``: ids of the part before the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, own = TaskContext.get().partitionId(), encoder(vocabulary)
        held: list[np.ndarray] = []
        fragments: list[tuple[int, int, int, int]] = []
        number = block = at = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, at, size
            ids = np.concatenate(held)
            data = pack(ids, fragments)
            steps = -(-len(ids) // len(data))
            n = [min(steps, len(ids) - i * steps) for i in range(len(data))]
            rows = pa.RecordBatch.from_arrays(
                [pa.array([part] * len(data), pa.int32()), pa.array(range(block, block + len(data)), pa.int64()),
                 pa.array([at + i * steps for i in range(len(data))], pa.int64()), pa.array(n, pa.int64()), pa.array(data, pa.binary())],
                names=["part", "block", "at", "n", "data"])
            held.clear()
            fragments.clear()
            block, at, size = block + len(data), at + len(ids), 0
            return rows

        for batch in batches:
            keys = batch.column(0)
            ids, n = own.encode_all(batch.column(1), (end_id,))
            held.append(ids)
            fragments += zip(range(number, number + len(n)), keys.fill_null(0).to_pylist(), keys.is_valid().to_pylist(), n.tolist())
            number, size = number + len(n), size + len(ids)
            if size >= LANES * BLOCK_IDS:
                yield flush()
        if held:
            yield flush()

    ranged = docs.select(F.col(f"`{key}`").cast("long").alias("key"), "text").repartitionByRange("key", F.xxhash64("text"))
    ordered = ranged.sortWithinPartitions("key", F.xxhash64("text"))
    return settled(ordered.mapInArrow(run, "part int, block long, at long, n long, data binary"), "token-files")


def read(files: DataFrame) -> DataFrame:
    """``part, number, doc_id, at, ids``: every fragment of a document; ``at`` counts ids of its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, LANES):
                rows = batch.slice(first, LANES)
                parts, ats = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                found = [[], [], [], [], []]
                for part, at, (fragments, ids) in zip(parts, ats, unpack(rows.column(2).to_pylist())):
                    place = 0
                    for number, doc_id, has, n in fragments.tolist():
                        for column, value in zip(found, (part, number, doc_id if has else None, at + place, ids[place : place + n].astype(np.int32))):
                            column.append(value)
                        place += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[0], pa.int32()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.int64()), pa.array(found[3], pa.int64()), pa.array(found[4], pa.list_(pa.int32()))],
                    names=["part", "number", "doc_id", "at", "ids"])

    return files.select("part", "at", "data").mapInArrow(run, "part int, number long, doc_id long, at long, ids array<int>")


def crc_of_ids(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, read from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, LANES):
                rows = batch.slice(first, LANES)
                found = [[], [], [], [], [], []]
                for part, at, (fragments, ids) in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), unpack(rows.column(2).to_pylist())):
                    wide, place = ids.astype("<u4").tobytes(), 0
                    for number, doc_id, has, n in fragments.tolist():
                        crc = zlib.crc32(memoryview(wide)[4 * place : 4 * (place + n)])
                        for column, value in zip(found, (part, number, doc_id if has else None, at + place, n, crc)):
                            column.append(value)
                        place += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int32() if i == 0 else pa.int64()) for i, x in enumerate(found)],
                    names=["part", "number", "doc_id", "at", "n", "crc"])

    pieces = files.select("part", "at", "data").mapInArrow(run, "part int, number long, doc_id long, at long, n long, crc long")
    # Sums of whole parts: one row for each part.
    sizes = files.groupBy("part").agg(F.sum("n").alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    docs = pieces.groupBy("part", "number").agg(
        F.min("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))
    docs = docs.join(settled(before, "token-parts"), "part")
    docs = docs.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "pieces")
    return docs.mapInArrow(_combined, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One checksum from those of a document's fragments."""
    maps = zero_maps()
    for batch in batches:
        whole = []
        for pieces in batch.column(3).to_pylist():
            crc = pieces[0]["crc"]
            for piece in pieces[1:]:
                crc = crc_joined(crc, piece["crc"], 4 * piece["n"], maps)
            whole.append(crc)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(whole, pa.int64())], names=[*batch.schema.names[:3], "ids_crc32"])


def mapped(columns: list[int], vector: int) -> int:
    """A linear map of 32 bits, given by its columns, applied to a vector of bits."""
    total = 0
    while vector:
        low = vector & -vector
        total ^= columns[low.bit_length() - 1]
        vector ^= low
    return total


def zero_maps() -> list[list[int]]:
    """What 1, 2, 4, ... zero bits after a string do to its checksum, up to 2**43 of them."""
    # One zero bit: shift right, and add the polynomial when a one falls out.
    maps = [[0xEDB88320] + [1 << i for i in range(31)]]
    while len(maps) < 44:
        maps.append([mapped(maps[-1], c) for c in maps[-1]])
    return maps


def crc_joined(first: int, second: int, size: int, maps: list[list[int]]) -> int:
    """crc32 of two byte strings one after the other, from theirs and the length of the second."""
    bits, power = 8 * size, 0
    while bits:
        if bits & 1:
            first = mapped(maps[power], first)
        bits >>= 1
        power += 1
    return first ^ second
