"""Operators on documents against plain versions, with odd rows, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm import jaccard, language, mixing, quality, queries, range_coder, token_files, trie_bpe
from tests.llm import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ", `class` string, n_words string, row string, key string, cell long, `key.x` int"


@pytest.fixture(scope="module")
def texts():
    return plain.corpus(np.random.default_rng(5))


@pytest.fixture(scope="module")
def docs(spark, texts):
    """The corpus with further columns whose names the operators use themselves."""
    rows = [(i, t, ["en", "de", None][i % 3], f"src{i % 4}" if i % 9 else None, len(t or "")) + ("x", "y", None, "z", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA + EXTRA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality(docs, texts):
    got = {r.doc_id: r for r in quality.ledger(docs).collect()}
    for i, t in enumerate(texts):
        n, chars, symbols, lines, repeats = plain.quality(t)
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == (n, chars, symbols, lines, repeats), t
        base = bool(got[i].fail_bits & quality.mask("base"))
        assert base == (n < 10 or 100 * repeats > 20 * n)


def test_policies_and_ablation_from_bits(docs):
    rows = quality.ledger(docs).cache()
    bits = [r.fail_bits for r in rows.select("fail_bits").collect()]
    for policy, rules in quality.POLICIES.items():
        mask = quality.mask(policy)
        assert rows.where(quality.verdict(policy)).count() == sum(not b & mask for b in bits)
        for r in quality.ablation(rows, policy).collect():
            own = quality.BIT[r.rule]
            assert r.rejected == sum(bool(b & own) for b in bits)
            assert r.alone == sum(b & mask == own for b in bits)
        assert {r.rule for r in quality.ablation(rows, policy).collect()} == set(rules)
    kept = quality.apply_policy(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows.where(quality.verdict()).collect()}


def test_bpe_like_the_library(spark, docs, texts):
    library = Tokenizer.from_file(queries.word_file())
    odd = ["a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "İstanbul ΣΊΣΥΦΟΣ ς", "é́ ẞ", "中文 字 　x", "it's we'll 12½ \x1c\x85\xa0z", "\0\1\2 a\nb",
           "ab" * 400, "don't", "word " * 3, "😀😀 ok"]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    got = {r.doc_id: r for r in trie_bpe.encode_digests(frame, queries.word_file()).collect()}
    plain_ids = {r.doc_id: r.ids for r in trie_bpe.encode(frame, queries.word_file()).collect()}
    for i, t in [*enumerate(texts), *enumerate(odd, 10_000)]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert plain_ids[i] == ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_of_long_texts_in_pieces(monkeypatch):
    library = Tokenizer.from_file(queries.word_file())
    monkeypatch.setattr(trie_bpe, "PIECE_CHARS", 40)
    texts = ["some words and more words. " * 20, "x" * 500, "a b " * 30 + "y" * 90 + " c" * 40, ""]
    for t, (n, ids, _) in zip(texts, trie_bpe.digests(trie_bpe.Encoder(queries.word_file()), texts)):
        want = library.encode(t, add_special_tokens=False).ids
        assert (n, ids) == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest())


def test_token_files(spark, docs, texts, monkeypatch):
    path = queries.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    monkeypatch.setattr(token_files, "BLOCK_IDS", 256)  # documents lie over several blocks
    files = token_files.write(docs, path, 2)
    got = {r.doc_id: r for r in token_files.crc_of_ids(files).collect()}
    whole = defaultdict(list)
    for r in token_files.read(files).orderBy("part", "at").collect():
        whole[r.doc_id] += r.ids
    start = 0
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert whole[i] == ids
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_of_repeated_and_null_ids(spark):
    rows = [(None, "null id"), (3, "b"), (3, "a"), (3, "a"), (1, None)]
    files = token_files.write(spark.createDataFrame(rows, "doc_id long, text string"), queries.vocabulary("byte_bpe_50k.json"), 2)
    got = token_files.crc_of_ids(files).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 3, 3, 3]
    assert [r.n_tokens for r in got[1:]] == [1, 2, 2, 2]


def test_token_pieces_like_the_library():
    path = queries.vocabulary("byte_bpe_50k.json")
    own, library = token_files.Encoder(path), Tokenizer.from_file(path)
    rng = np.random.default_rng(1)
    odd = ["", " ", "  a", "a ", "a  b", "a \n b", "a\n b", "a <|endoftext|> b<|endoftext|>", "x\xa0 y", "\x1c a", "a　 b"]
    odd += ["".join(rng.choice(list("ab  .'s\n\t12é中\xa0"), size=rng.integers(0, 25))) for _ in range(400)]
    for t in odd:
        assert np.frombuffer(own.encode(t), np.uint16).tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_every_piece_of_a_batch_is_encoded_once():
    own, library = token_files.Encoder(queries.vocabulary("byte_bpe_50k.json")), Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    given = []

    class Counting:
        def encode_batch_fast(self, texts, **how):
            given.extend(texts)
            return library.encode_batch_fast(texts, **how)

    own.library = Counting()
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["alpha", "b\u00eata,", "gamma.\nDelta", "x<|endoftext|>"], size=90)) for _ in range(60)]
    texts += [None, "", " ", "odd  spaces here", "ends ", "a\n b", "alpha"]
    for texts in (texts, texts[::-1], texts[62:63], texts[:0]):
        ids, n = own.encode_all(pa.array(texts, pa.string()), (2, 7))
        want = [library.encode(t or "", add_special_tokens=False).ids + [2, 7] for t in texts]
        assert ids.tolist() == [x for one in want for x in one] and n.tolist() == [len(one) for one in want]
    assert sum(map(len, given)) < 5_000  # of 67,000 characters


def test_ids_not_counted_have_no_rank():
    """Neither side has to search for the place of an id that it does not count."""
    ids = np.random.default_rng(6).integers(0, 300, size=(200, 70)).astype(np.uint16)
    rank, times = range_coder.ranks_of(ids)
    starts = range_coder.epochs(200)
    for t in (0, 15, 16, 23, 24, 100, 199):
        held = max([s for s in starts if s <= t], default=0)
        equal = (ids[:held] == ids[t]).sum(0)
        assert np.array_equal(times[t], equal)
        assert np.array_equal(rank[t], np.where(equal, (ids[:held] < ids[t]).sum(0), 0))


@pytest.mark.parametrize("low, high", [(0, 1), (0, 2), (0, 40), (65535, 65536), (65500, 65536), (0, 65536)])
def test_coder_of_few_ids_met_again_before_they_count(low, high):
    rng = np.random.default_rng(high)
    ids = rng.integers(low, high, size=(900, 70)).astype(np.uint16)
    ids[rng.random(ids.shape) < 0.1] = 0  # a cell without a guess must not pass for id 0
    codes = range_coder.encode_lanes(ids)
    assert np.array_equal(range_coder.decode_lanes(codes, 900), ids)
    assert np.array_equal(range_coder.decode_lanes(codes[9:10], 900)[:, 0], ids[:, 9])


@pytest.mark.parametrize("steps, lanes", [(1, 1), (15, 2), (16, 2), (17, 3), (63, 2), (64, 3), (65, 5), (700, 4), (2100, 1)])
def test_range_coder_round_trip(steps, lanes):
    rng = np.random.default_rng(steps)
    for ids in (rng.zipf(1.2, size=(steps, lanes)).clip(0, 65535), rng.integers(0, 65536, size=(steps, lanes)), np.full((steps, lanes), 65535), rng.integers(0, 3, size=(steps, lanes))):
        ids = ids.astype(np.uint16)
        codes = range_coder.encode_lanes(ids)
        assert np.array_equal(range_coder.decode_lanes(codes, steps), ids)
        assert np.array_equal(range_coder.decode_lanes(codes[-1:], steps)[:, 0], ids[:, -1])  # a block alone


def test_coder_learns():
    ids = np.tile(np.arange(50, dtype=np.uint16), 80)[:, None]
    assert len(range_coder.encode_lanes(ids)[0]) < len(ids) // 2


def test_mixed_shares_tile_the_interval():
    """After any ids, the shares of all ids that a predictor holds lie side by side, and agreeing predictions add up."""
    rng = np.random.default_rng(8)
    seen = rng.integers(40, 60, size=(24, 1)).astype(np.uint16)
    rank, count = range_coder.ranks_of(seen)
    lanes, held = range_coder.Lanes(1), 1
    for t in range(24):
        held = t if t in range_coder.epochs(25) else held
        now = seen[t].astype(np.int64)
        lanes.predict()
        new = lanes.interval(now, rank[t].astype(np.int64), count[t].astype(np.int64), held)[2]
        lanes.update(now, new)
    lanes.predict()
    counted = np.sort(seen[:24, 0])
    guesses, shares = {int(s[0]) for s in lanes.say}, []
    for x in range(100):
        below, equal = np.array([(counted < x).sum()]), np.array([(counted == x).sum()])
        start, size, new = lanes.interval(np.array([x]), below, equal, 24)
        assert bool(new[0]) == (x not in guesses and x not in counted)
        if not new[0]:
            shares.append((int(start[0]), int(size[0])))
    at = int(lanes.mass[3][0])
    for start, size in shares:
        assert start == at and size > 0
        at += size
    assert at == 1 << 30
    assert sum(int(w[0]) for w in lanes.w) == 1 << 16


def test_coder_beats_a_general_one_on_the_given_texts(spark):
    library = token_files.Encoder(queries.vocabulary("byte_bpe_50k.json"))
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").select("text").collect()
    ids = np.frombuffer(b"".join(library.encode(r.text or "") for r in rows), np.uint16)
    files = token_files.pack(ids, [(0, 0, 1, len(ids))])
    assert sum(map(len, files)) < len(zlib.compress(ids.tobytes(), 9))  # whole, while blocks start anew
    assert np.array_equal(np.concatenate([part for _, part in token_files.unpack(files)]), ids)


def test_damaged_block():
    data = bytearray(token_files.pack(np.arange(300, dtype=np.uint16), [(0, 7, 1, 300)])[0])
    data[-1] ^= 1
    with pytest.raises(ValueError):
        list(token_files.unpack([bytes(data)]))


def test_jaccard(docs, texts):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect())
    assert got == sorted(plain.jaccard_groups(list(enumerate(texts))))


def test_jaccard_chains_and_hot_groups(spark):
    """Near copies whose ends are not linked, in cells that one pivot does not connect."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows, text = [], list(base)
    for i in range(60):
        text[(7 * i) % 120] = f"v{i}"
        rows.append((int(rng.integers(0, 10_000)), " ".join(text)))
        rows.append((10_000 + i, " ".join(base[: 119 - i % 3])))
    rows += [(20_000 + i, "exact copy of one text in many rows") for i in range(200)]
    rows = list({r[0]: r for r in rows}.values())
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(plain.jaccard_groups(rows))


def test_every_linked_pair_meets_in_a_cell():
    rng = np.random.default_rng(8)
    for size in [1, 2, 6, 7, 13, 20, 40, 150, 700]:
        for _ in range(30):
            x = rng.integers(0, 1 << 63, size=size, dtype=np.uint64)
            drop, add = rng.integers(0, size // 9 + 2, size=2)
            y = np.concatenate((x[drop:], rng.integers(0, 1 << 63, size=add, dtype=np.uint64)))
            common, total = len(x) - drop, len(x) + add
            if len(y) and 100 * common >= 85 * total:
                of, keys = jaccard.cell_keys(np.array([0, len(x), len(x) + len(y)]), np.concatenate((np.sort(x), np.sort(y))))
                assert set(keys[of == 0]) & set(keys[of == 1])


def test_one_of_each(spark, docs, texts):
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = plain.jaccard_groups(list(enumerate(texts)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, c in groups if i == c)
    rows = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, None), (4, ""), (None, "z y x w")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in jaccard.one_of_each(rows).collect()) == ["1", "3", "4", "None"]


def test_jaccard_links_texts_without_an_id(spark):
    words = [f"w{i}" for i in range(60)]
    chain = [" ".join(words[i : i + 50]) for i in (0, 3, 6)]  # the ends link only through the middle
    rows = spark.createDataFrame([(2, chain[0]), (None, chain[1]), (None, chain[1]), (1, chain[2])], "doc_id long, text string")
    got = [(r.doc_id, r.component_id) for r in jaccard.jaccard_components(rows).collect()]
    assert sorted(got, key=str) == [(1, 1), (2, 1), (None, 1), (None, 1)]


def shares(weights, caps, budget):
    """Budget dealt by weight; what a full child leaves goes to the others."""
    got, open_, left = dict.fromkeys(weights, 0), {c for c in weights if weights[c] > 0}, budget
    while open_:
        total = sum(weights[c] for c in open_)
        full = {c for c in open_ if caps[c] * total <= weights[c] * left}
        if not full:
            for c in open_:
                got[c] = weights[c] * left // total
            break
        for c in full:
            got[c] = caps[c]
        left -= sum(caps[c] for c in full)
        open_ -= full
    return got


def plain_mix(rows, weights, share, epochs, seed):
    """``rows``: (id, tokens, (level, ...)); Counter of (id, epoch)."""
    leaves = Counter()
    for _, tokens, leaf in rows:
        leaves[leaf] += tokens
    depth = len(rows[0][2])
    budget = {(): sum(leaves.values()) * share[0] // share[1]}
    for d in range(depth):
        for parent in {x[:d] for x in leaves}:
            caps = Counter()
            for leaf, tokens in leaves.items():
                if leaf[:d] == parent:
                    caps[leaf[: d + 1]] += tokens * epochs
            own = {c: weights[d].get(c[-1], 0) if weights[d] else 1 for c in caps}
            budget |= shares(own, caps, min(budget[parent], sum(caps.values())))
    found = Counter()
    for leaf, tokens in leaves.items():
        whole = min(budget[leaf] // tokens, epochs) if tokens else 0
        rest = budget[leaf] - whole * tokens
        own = [(hashlib.md5(f"{seed}|{whole + 1}|{i}".encode()).hexdigest(), i, n) for i, n, x in rows if x == leaf]
        for e in range(1, whole + 1):
            found.update((i, e) for _, i, _ in own)
        total = 0
        for _, i, n in sorted(own):
            total += n
            if rest <= 0 or total > rest:
                break
            found[i, whole + 1] += 1
    return found


@pytest.mark.parametrize("share, epochs", [((3, 5), 2), ((4, 5), 1), ((1, 1), 1), ((5, 2), 3), ((0, 1), 1)])
def test_mixing(spark, docs, texts, share, epochs):
    weights = {"language": {"en": 70, "de": 20, "": 10}, "source": {}}
    levels = {"language": F.col("lang"), "source": F.col("source")}
    got = Counter((r.row.doc_id, r.epoch) for r in mixing.mix(docs, levels, weights, share, epochs, "s").collect())
    rows = [(i, len(plain.words(t)), ((["en", "de", ""][i % 3]), f"src{i % 4}" if i % 9 else "")) for i, t in enumerate(texts)]
    assert got == plain_mix(rows, [weights["language"], {}], share, epochs, "s")


def test_mixing_of_children_without_a_weight(spark):
    rows = [(i, "a b c d e", [None, None, "it", "en"][i % 4], "src0") for i in range(400)] + [(400 + i, "a b", "fr", "src0") for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = Counter(r.row.lang for r in queries.mixed(frame, (4, 5), 1).collect())
    assert got["en"] == 100 and got["fr"] == 9 and got[None] > 90 and got["it"] > 90
    assert 1614 - 10 < 5 * (got["en"] + got["it"] + got[None]) + 2 * got["fr"] <= 1614
    # Tokens of a child that is listed with 0 take no budget from the other domains.
    weights = {"domain": {"web": 50, "news": 50}, "language": {"de": 0, "en": 1}}
    levels = {"domain": F.col("source"), "language": F.col("lang")}
    rows = [(i, "a b", "de" if i < 90 else "en", "web") for i in range(100)] + [(100 + i, "a b", "en", "news") for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = Counter(r.domain for r in mixing.mix(frame, levels, weights, (1, 2), 1, "s").collect())
    assert got == {"web": 10, "news": 90}


def test_languages(spark):
    rng = np.random.default_rng(2)
    parts = {"en": ["the", "tion", "ing", "wh"], "de": ["sch", "ung", "keit", "ein"], "fr": ["eau", "que", "oi", "ai"]}
    say = lambda lang, n: " ".join("".join(rng.choice(parts[lang], size=3)) for _ in range(n))
    rows = [(i, say(lang, 30), lang, f"{lang}.host.org") for i, lang in enumerate(["en", "de", "fr"] * 60)]
    frame = spark.createDataFrame(rows + [(900, None, None, None), (901, "", None, "de.host.org"), (902, "\x01\x02\x03" * 300, None, None)], "doc_id long, text string, lang string, source string")
    got = {r.row: r for r in language.of_documents(frame).collect()}
    assert len(got) == len(rows) + 3
    assert all(got[i].language == lang and got[i].kept and got[i].posterior > 0.9 for i, _, lang, _ in rows)
    assert got[901].language == "de"  # by its host alone
    kept = language.of_documents(frame, keep_row=True).where("kept").select("row.*")
    assert kept.columns == frame.columns

    # Held out: the text alone.
    names, model = language.train(frame.where("doc_id < 150").selectExpr("doc_id id", "lang label", "text"))
    other = spark.createDataFrame([(say(lang, 12), lang) for lang in parts for _ in range(20)], "text string, lang string")
    held = other.select(F.struct("lang").alias("row"), "text", *(F.lit(None).cast("string").alias(c) for c in ("declared", "suffix", "host")))
    found = language.fused(held, names, model).collect()
    assert all(r.row.lang == r.language for r in found)


def test_every_language_has_its_own_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_ROWS", 20)
    rows = [(i, "en", "the thing with the ring") for i in range(3000)] + [(5000 + i, "de", "schön keine zeitung") for i in range(3)]
    names, _ = language.train(spark.createDataFrame(rows, "id long, label string, text string"))
    assert names == ["de", "en"]


def test_language_of_pages_uses_declaration_suffix_and_host(spark):
    labelled = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate([("de", "der und die sch ung " * 9), ("en", "the and of ing tion " * 9)] * 20)], "id long, label string, text string")
    pages = [(i, f"http://www.a.de/{i}", "<html lang='de'><p>der und die sch ung keit</p>") for i in range(30)]
    pages += [(100 + i, f"http://b.com/{i}", "<html lang=en><p>the and of ing tion tion</p>") for i in range(30)]
    pages += [(900, "http://c.de/", None), (901, "http://www.a.de/x", "<html lang=de>"), (902, None, ""), (903, "no address", "<p>1</p>")]
    got = {r.row: r for r in language.of_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), labelled).collect()}
    assert len(got) == len(pages)
    assert got[0].language == "de" and got[100].language == "en"
    assert got[900].language == "de"  # only its suffix tells
    assert got[901].language == "de"


def test_fusion_like_plain(spark):
    """Texts, declarations, suffixes and nested hosts that agree, disagree or are missing, against the definition row by row."""
    rng = random.Random(3)
    words = {"de": "der die das und nicht wir sind heute auf dem weg nach hause".split(), "en": "the and not we are today on our way home with them".split(),
             "fr": "les des nous sommes aujourd hui avec une maison pas très".split()}
    hosts = ["a.b.de", "x.a.b.de", "b.de", "de", "news.com", "blog.news.com", "deep.blog.news.com", "com", None, "", "..", "." * 9]
    held, labelled = {}, []
    for i in range(240):
        lang = rng.choice(list(words))
        mixed = words[lang] + (words[rng.choice(list(words))] if i % 4 == 0 else [])
        text = " ".join(rng.choice(mixed) for _ in range(rng.randrange(0, 12)))
        text = rng.choice([None, "", "x", "\u4e2d\u6587 \u4e2d", "zq xj kv " * 9]) if i % 11 == 0 else text
        declared = rng.choice([lang, lang, "de", "xx", None])
        labelled.append((declared if rng.random() < 0.9 and declared != "xx" else None, text))
        host = rng.choice(hosts)
        held[i] = text, declared, host.rpartition(".")[2] if host else None, host
    labelled += [("en", None), (None, "the")]
    names, model = language.train(spark.createDataFrame([(i, *x) for i, x in enumerate(labelled)], "id long, label string, text string"))
    frame = spark.createDataFrame([(i, *x) for i, x in held.items()], "row long, text string, declared string, suffix string, host string")
    got = {r.row: r for r in language.fused(frame, names, model).collect()}
    for i, (found, posterior, by_text, kept) in plain.languages(labelled, held).items():
        assert (got[i].language, got[i].text_language, got[i].kept) == (found, by_text, kept), held[i]
        assert abs(got[i].posterior - posterior) < 1e-4
    assert {r.kept for r in got.values()} == {True, False} and any(r.language != r.text_language for r in got.values())


def test_hosts_of_very_many_labels(spark):
    names, model = ["de", "en"], np.log(np.full((2, language.FEATURES), 1 / language.FEATURES))
    far = "x." * 5000 + "de"
    held = spark.createDataFrame([(0, "some text", None, None, far), (1, "more text", None, None, far), (2, None, None, None, "de")], "row long, text string, declared string, suffix string, host string")
    assert held.count() == language.fused(held, names, model).count()


def test_languages_are_the_most_frequent_labels(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 3)
    rows = [(i, x, "some text of it") for i, x in enumerate(["d", "d", "d", "b", "b", "a", "c", None])]
    names, _ = language.train(spark.createDataFrame(rows, "id long, label string, text string"))
    assert names == ["a", "b", "d"]


def test_host_priors_are_smoothed_towards_parents(spark):
    held = spark.createDataFrame([(f"x{i}", None, None, None, "new.de") for i in range(2)], "row string, text string, declared string, suffix string, host string")
    names, model = ["de", "en"], np.log(np.full((2, language.FEATURES), 1 / language.FEATURES))
    assert {r.language for r in language.fused(held, names, model).collect()} <= {"de", "en"}


def test_no_rows(none):
    assert quality.ledger(none).count() == 0 and quality.apply_policy(none).count() == 0
    assert trie_bpe.encode_digests(none, queries.word_file()).count() == 0
    assert token_files.crc_of_ids(token_files.write(none, queries.vocabulary("byte_bpe_50k.json"), 2)).count() == 0
    assert jaccard.jaccard_components(none).count() == 0 and jaccard.one_of_each(none).count() == 0
    assert queries.mixed(none, (1, 2), 1).count() == 0
    assert language.of_documents(none).count() == 0
