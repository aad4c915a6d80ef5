"""Terms of whole texts as exact dictionaries: runs of chosen characters, with A-Z lower-cased."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallyhouse.llm.words import LOWER, Texts

LETTERS = np.zeros(256, bool)
LETTERS[0x80:] = True
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
LETTERS_AND_DIGITS = LETTERS.copy()
LETTERS_AND_DIGITS[0x30:0x3A] = True


def terms(texts: Texts, inside: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms; and for each occurrence, in order, the number of its term and of its text.

    ``inside`` tells which bytes belong to terms. All bytes of characters beyond ASCII are alike in it, so bytes and characters
    give the same terms.
    """
    flags = inside[texts.data]
    starts, ends = texts.runs(flags)
    bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    held = np.ascontiguousarray(LOWER[texts.data[flags]])
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(held)).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(), texts.owner(starts)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs."""
    return np.unique(keys, return_counts=True)
