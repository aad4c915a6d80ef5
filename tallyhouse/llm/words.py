"""Words of whole texts as arrays: positions and 64-bit fingerprints, without a loop over words.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``. In UTF-8 these bytes occur only as the
characters themselves, so bytes and characters give the same words. Equal words have equal
fingerprints; two different words agree with a chance of about 2**-60 per pair.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
#: Under this name a Python worker keeps encoders from task to task. A task of another kind lets go of them.
KEPT = "_kept_encoders"
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SHINGLE_FACTORS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def small_batches(spark: SparkSession) -> None:
    """Let tasks get texts in batches of BATCH_BYTES at most, or of one longer text, in place of Spark's 64 MB.

    A task holds a few copies of its batch in the JVM and in Python. This is a setting of the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over all bits of the output; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Texts:
    """Some whole texts as one byte array with the place of each text."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds, self.n = data, bounds, len(bounds) - 1

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a byte-wise array over each text."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of true bytes, cut where a text ends."""
        n = len(inside)
        edge = np.zeros(n + 1, bool)
        edge[self.bounds] = True
        before = np.concatenate(([False], inside[:-1])) if n else inside
        after = np.concatenate((inside[1:], [False])) if n else inside
        starts = np.flatnonzero(inside & (~before | edge[:n]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return starts, ends

    def owner(self, places: np.ndarray) -> np.ndarray:
        """The text each byte position belongs to."""
        return np.searchsorted(self.bounds, places, side="right") - 1

    def fingerprints(self, starts: np.ndarray, ends: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
        """A fingerprint of the bytes of each span: a polynomial over prefix sums."""
        data = self.data if data is None else data
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * powers(INVERSE, n + 1)[starts])


def slices(column: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES) -> Iterator[tuple[int, Texts]]:
    """``(first row, texts)`` for runs of rows of at most ``size`` bytes, or of one longer text.

    Null counts as the empty text.
    """
    sys.modules.pop(KEPT, None)
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        chunk = chunk.cast(pa.large_string()).fill_null("")
        _, offsets, data = chunk.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(chunk) + 1, chunk.offset * 8) if len(chunk) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        first = 0
        while first < len(chunk):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1)
            own = bounds[first : last + 1]
            yield first, Texts(raw[own[0] : own[-1]], own - own[0])
            first = last


def windows(words: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start index and fingerprint of every run of ``k`` words within one text."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += words[j : n + j] * np.uint64(SHINGLE_FACTORS[j])
    at = np.flatnonzero(owner[:n] == owner[k - 1 :])
    return at, mixed(total[at])


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two flags for each key: it occurs more than once; it has occurred before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later
