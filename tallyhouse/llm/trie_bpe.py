"""BPE encoding and decoding: a trie of distinct words, with last-token states passed down depth first.

The encoding of a prefix is determined by its last token: a token ending here is the right one when the
state at its start is a token it may follow. So a trie node needs one state, computed from the states
of its ancestors, and all words below share it. `Vocabulary` holds merges and the test whether two
tokens may stand side by side; `encode_words` walks the trie; `encode` and `decode` treat whole texts.

The results are those of the tokenizers library for a vocabulary of byte-level symbols with a word-end
suffix, added tokens, and the normaliser and word pattern of ``word_bpe_49k.json``: `Vocabulary.load`
refuses other settings. Null counts as the empty text, which has no ids; rows may repeat; other columns go
along. Long texts are cut at white space, which no token spans, so that memory is bounded by the
longest run without white space.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import types
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.words import KEPT

WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: The same pattern for characters in PLAIN, where these classes agree with those of Unicode.
PLAIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Below U+0250 no character composes, and but for separators 1C-1F and numbers that are no digits, classes agree.
NOT_PLAIN = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbeɐ-\U0010ffff]")
NEVER = 1 << 60
LONG_WORD = 200
PIECE_CHARS = 1 << 20
#: Words whose ids an encoder keeps: when there are more than the second number, those met first, which are mostly the frequent ones.
KEPT_WORDS, MOST_WORDS = 60_000, 120_000
#: Words in one trie.
TRIE_WORDS = 8_192


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [chr(hidden.get(b, b)) for b in range(256)]


@dataclass
class Vocabulary:
    """Tokens, merges and the rule of neighbours."""

    token: dict[str, str]  # decimal id -> token as text
    added: dict[str, int]
    merge: dict[tuple[int, int], int]  # pair -> its rank
    parts: dict[int, tuple[int, int, int]]  # token -> left, right, rank
    starts: dict[str, list] = field(default_factory=dict)  # trie of tokens: character -> [below, inner token, final token]
    pair_known: dict[int, bool] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a tokenizers file."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pieces = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        pattern = pieces[0].get("pattern", {}).get("Regex")
        if not suffix or kinds != ["NFC", "Replace", "Lowercase"] or pattern != WORD_PATTERN or spec["decoder"] or spec["post_processor"]:
            raise ValueError(f"{path}: not a word-end BPE with this normaliser and pattern")
        vocab: dict[str, int] = model["vocab"]
        merge, parts = {}, {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[left + right]
            merge[vocab[left], vocab[right]] = rank
            if parts.setdefault(made, (vocab[left], vocab[right], rank))[2] != rank:
                raise ValueError(f"{left + right} is made by two merges")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self = cls({str(i): t for t, i in (vocab | added).items()}, added, merge, parts)
        reached: dict[int, bool] = {}
        for text, i in sorted(vocab.items(), key=lambda x: parts.get(x[1], (0, 0, -1))[2]):
            left, right, _ = parts.get(i, (0, 0, -1))
            reached[i] = i not in parts or (reached[left] and reached[right] and self.joined(left, right) == (left, right))
            if reached[i] and i not in added.values():
                ends = text.endswith(suffix) and text != suffix
                below = self.starts
                for c in text.removesuffix(suffix) if ends else text:
                    place = below.setdefault(c, [{}, -1, -1])
                    below = place[0]
                place[1 + ends] = i
        return self

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at one end of a token while it is built: (token, rank of the merge that ends it)."""
        found, until = [(token, NEVER)], NEVER
        while token in self.parts:
            until = self.parts[token][2]
            token = self.parts[token][side]
            found.append((token, until))
        return found[::-1]

    def joined(self, a: int, b: int) -> tuple[int, int] | None:
        """The first merge across the border while a and b are built side by side, if any.

        Of equal ranks the leftmost goes first: one inside a comes before the border, one inside b after it.
        """
        right, left = self.spine(a, 1), self.spine(b, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = right[i], left[j]
            rank = self.merge.get((x, y))
            if rank is not None and rank < x_ends and rank <= y_ends:
                return x, y
            if x_ends == y_ends == NEVER:
                return None
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def neighbours(self, a: int, b: int) -> bool:
        """Whether the text of a and b together is encoded as a, b."""
        if len(self.pair_known) > 150_000:
            self.pair_known.clear()
        known = self.pair_known[a << 32 | b] = self.joined(a, b) is None
        return known


def encode_words(v: Vocabulary, words: Iterable[str]) -> dict[str, list[int]]:
    """Ids of each word (in byte characters).

    A visit knows the starts from which the text up to here is the beginning of some token. Of those
    where a token ends, the earliest start whose own last token may precede it gives the state.
    """
    found: dict[str, list[int]] = {}
    root: dict = {}
    for word in words:
        if len(word) > LONG_WORD:  # by itself: as deep as it is long, and it shares little
            found[word] = walk(v, {word[0]: word}, len(word), chain=True)[word]
            continue
        node = root
        for c in word:
            node = node.setdefault(c, {})
        node[""] = word
    return found | walk(v, root, LONG_WORD)


def walk(v: Vocabulary, root: dict, depth: int, chain: bool = False) -> dict[str, list[int]]:
    """Depth first through a trie, or along the one word of a chain; ids of the words met."""
    found: dict[str, list[int]] = {}
    # Preorder: when a node is visited, the states above it are those of its own prefix.
    last, size = [0] * (depth + 1), [0] * (depth + 1)
    begin, known, neighbours = v.starts, v.pair_known, v.neighbours
    (first, word), = root.items() if chain else [("", "")]
    stack = [(c, below, 1, [(0, begin[c])]) for c, below in root.items()]
    while stack:
        c, node, end, live = stack.pop()
        if chain:
            ends, children = end == depth, ((word[end], word),) if end < depth else ()
        else:
            ends, children = "" in node, node.items()
        if ends:
            for start, place in live:
                token = place[2]
                if token >= 0 and (start == 0 or (ok := known.get(last[start] << 32 | token)) or ok is None and neighbours(last[start], token)):
                    break
            ids = [token]
            while start:
                ids.append(last[start])
                start -= size[start]
            ids.reverse()
            found[word if chain else node[""]] = ids
            if not chain and len(node) == 1:
                continue
        for start, place in live:
            token = place[1]
            if token >= 0 and (start == 0 or (ok := known.get(last[start] << 32 | token)) or ok is None and neighbours(last[start], token)):
                last[end], size[end] = token, end - start
                break
        for c, below in children:
            if c:
                on = [(start, x) for start, place in live if (x := place[0].get(c))]
                on.append((end, begin[c]))
                stack.append((c, below, end + 1, on))
    return found


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, kept by a Python worker from task to task with the words it knows."""
    kept = sys.modules.setdefault(KEPT, types.ModuleType(KEPT)).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


class Encoder:
    """Whole texts to ids and back, with the ids of recent words kept."""

    def __init__(self, path: str):
        self.path, self.v, self.library = path, Vocabulary.load(path), None
        self.bytes = byte_characters()
        self.split = re.compile("(" + "|".join(map(re.escape, self.v.added)) + ")")
        self.marks = tuple(self.v.added)
        self.known: dict[str, str] = {}

    def words(self, piece: str) -> list[str]:
        """Words in order. A line feed marks an added token, a space a word in byte characters; no word holds either."""
        if not any(m in piece for m in self.marks):
            return self.plain_words(piece)
        return [w for i, part in enumerate(self.split.split(piece)) for w in (["\n" + part] if i % 2 else self.plain_words(part))]

    def plain_words(self, part: str) -> list[str]:
        if not NOT_PLAIN.search(part):
            return PLAIN_WORD.findall(part.lower())
        if self.library is None:  # few texts need it
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        shown = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part)) if part else []
        return [" " + w for w, _ in shown]

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words not yet known, together."""
        new = set(words).difference(self.known)
        if not new:
            return
        if len(self.known) > MOST_WORDS:
            self.known = dict(islice(self.known.items(), KEPT_WORDS))
            new = set(words).difference(self.known)
        shown = {}
        for w in new:
            if w[0] == "\n":
                self.known[w] = str(self.v.added[w[1:]])
            else:
                shown[w] = w[1:] if w[0] == " " else "".join([self.bytes[b] for b in w.encode()])
        # Some words at a time, in order: a trie takes much more memory than its words, and neighbours share most of their prefixes.
        wanted, ids = sorted(set(shown.values())), {}
        for first in range(0, len(wanted), TRIE_WORDS):
            for s, own in encode_words(self.v, wanted[first : first + TRIE_WORDS]).items():
                ids[s] = " ".join(map(str, own))
        for w, s in shown.items():
            self.known[w] = ids[s]

    def pieces(self, text: str) -> Iterator[str]:
        """The text cut at white space."""
        at = 0
        while len(text) - at > PIECE_CHARS:
            cut = re.compile(r"[ \t-\r]").search(text, at + PIECE_CHARS)
            if not cut:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def decode(self, ids: str) -> str:
        """Tokens of ids joined by a space, each shown as it stands in the vocabulary."""
        return " ".join(map(self.v.token.__getitem__, ids.split(" "))) if ids else ""


def digests(encoder: Encoder, texts: list[str | None]) -> list[tuple[int, str, str]]:
    """Count of ids, digest of the ids, digest of the decoded text, for each text."""
    found = []
    held: list[list[str]] = []

    def flush() -> None:
        encoder.learn({w for words in held for w in words})
        for words in held:
            ids = " ".join(map(encoder.known.__getitem__, words))
            back = encoder.decode(ids)
            found.append((ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
        held.clear()

    weight = 0
    for text in texts:
        text = text or ""
        if len(text) <= PIECE_CHARS:
            held.append(encoder.words(text))
            weight += len(text)
            if weight > PIECE_CHARS:
                flush()
                weight = 0
            continue
        flush()
        weight, n, of_ids, of_text = 0, 0, hashlib.sha256(), hashlib.sha256()
        for piece in encoder.pieces(text):
            words = encoder.words(piece)
            encoder.learn(words)
            if ids := " ".join(map(encoder.known.__getitem__, words)):
                of_ids.update((" " * (n > 0) + ids).encode())
                of_text.update((" " * (n > 0) + encoder.decode(ids)).encode())
                n += ids.count(" ") + 1
        found.append((n, of_ids.hexdigest(), of_text.hexdigest()))
    flush()
    return found


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Every column but those made here, with ``ids`` (array of int) of the whole text."""
    others = [c for c in docs.columns if c not in ("ids", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_encoder = encoder(vocabulary)
        for batch in batches:
            ids = []
            for text in batch.column(len(others)).to_pylist():
                own: list[int] = []
                for piece in own_encoder.pieces(text or ""):
                    words = own_encoder.words(piece)
                    own_encoder.learn(words)
                    own += [int(i) for w in words for i in own_encoder.known[w].split(" ")]
                ids.append(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*batch.schema.names, "ids"])

    held = docs.select(*(F.col(f"`{c}`") for c in others), "text")
    return held.mapInArrow(run, T.StructType([*held.schema, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def encode_digests(docs: DataFrame, vocabulary: str, key: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: each text encoded, and its ids decoded again."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_encoder = encoder(vocabulary)
        for batch in batches:
            n, ids, text = zip(*digests(own_encoder, batch.column(1).to_pylist())) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), "text").mapInArrow(
        run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return rows.withColumnRenamed("key", key)
