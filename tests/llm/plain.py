"""Plain, slow versions of the operators, and a small awkward corpus."""

import html
import math
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0d]+")
SMALL = {chr(c): chr(c + 32) for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    w, text = words(text), text or ""
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if words(line)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def shingles(text, k=4):
    w = words("".join(SMALL.get(c, c) for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def union_find(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def jaccard_groups(rows):
    """Smallest id reachable for each row of (id, text); all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    near = {(i, j) for group in by.values() for n, i in enumerate(group) for j in group[:n]}
    linked = [(i, j) for i, j in near if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    roots, least = union_find(len(rows), linked), {}
    for i, r in enumerate(roots):
        least[r] = min(least.get(r, math.inf), rows[i][0])
    return [(rows[i][0], len(sets[i]), least[r]) for i, r in enumerate(roots)]


def vector_groups(rows, threshold=0.9):
    """(id, links, smallest id reachable) of each row of (id, vector)."""
    units = []
    for _, v in rows:
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    linked = [(i, j) for i in range(len(rows)) for j in range(i)
              if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold]
    n = Counter(i for pair in linked for i in pair)
    roots, least = union_find(len(rows), linked), {}
    for i, r in enumerate(roots):
        least[r] = min(least.get(r, math.inf), rows[i][0])
    return [(rows[i][0], n[i], least[r]) for i, r in enumerate(roots)]


def article(page):
    """The text of the article of a page of the given tables: paragraphs and headings."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    parts = (re.sub(r"<[^>]*>", "", p) for p in re.split(r"</?(?:p|h1)>", inner))
    parts = (" ".join(html.unescape(p).split()) for p in parts)
    return "\n".join(p for p in parts if p)


def corpus(rng, n=120):
    """Texts with copies, near copies, shared passages, long and short ones, and none."""
    vocabulary = ["the", "of", "and"] + ["".join(rng.choice(list("abcdefgäß"), size=rng.integers(2, 8))) for _ in range(400)]
    make = lambda k: [str(x) for x in rng.choice(vocabulary, size=k)]
    passage, found = make(50), []
    for i in range(n):
        body = make(int(rng.integers(1, 200)))
        if i % 7 == 0:
            body = body[:50] + passage + body[50:]
        found.append(body)
        if i % 5 == 0:
            found.append(list(body))
        if i % 3 == 0:
            near = list(body)
            for at in rng.integers(0, len(near), size=1 + len(near) // 60):
                near[at] = "changed"
            found.append(near)
            more = list(near)
            more[rng.integers(0, len(more))] = "again"
            found.append(more)
    texts = [" ".join(b) for b in found]
    texts += ["", None, " \n\t", "one", "one two", "One TWO", "one two three four", "one two three four five", "x" * 3000,
              " ".join(make(6000)), "same line here\nsame line here\nother\n\nsame line here", "a b c d e " * 9, "*** ### $$$ word"]
    return texts


def _runs(text, pattern):
    return re.findall(pattern, "".join(SMALL.get(c, c) for c in text or ""))


def search_terms(text):
    return _runs(text, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(rows, items, k):
    """item_id, rank, doc_id, score of the best rows of (doc_id, text) for each different item"""
    tf = [Counter(search_terms(t)) for _, t in rows]
    n, length = sum(map(bool, tf)), sum(sum(c.values()) for c in tf)
    df = Counter(t for c in tf for t in c)
    found = []
    for item, text in set(items):
        scores = []
        for (doc, _), c in zip(rows, tf):
            score = 0
            for t in set(search_terms(text)) & set(c):
                m = 100 - 90 + (90 * sum(c.values()) * n) // length
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        found += [(item, rank, None if gone else doc, -score) for rank, (score, gone, doc) in enumerate(sorted(scores)[:k], 1)]
    return found


def divergences(rows, ranks):
    """lang, source, part, item, value, rank of rows of (doc_id, text, lang, source)"""
    count, docs, every = defaultdict(Counter), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        own = Counter(_runs(text, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"))
        every.add((lang, source))
        count[lang, source].update(own)
        docs.update((lang, t) for t in own)
    price = lambda p, q: (p - q) * (p - q) // q
    found = []
    for lang in {g[0] for g in every}:
        kept = [t for (l, t), n in docs.items() if l == lang and n >= 3]
        groups = [s for l, s in every if l == lang]

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 1000000000 * (n[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(count[lang, s]) for s in groups}
        q = shares(sum((count[lang, s] for s in groups), Counter()))
        for s in groups:
            parts = {
                "pair": [(-sum(price(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s],
                "term": [(-price(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]],
            }
            for part, values in parts.items():
                values.sort(key=lambda x: (x[0], x[1].encode()))
                found += [(lang, s, part, item, -value, rank) for rank, (value, item) in enumerate(values, 1) if part == "pair" or rank <= ranks]
    return found


def levels(needs):
    """``(conversation, call) -> needed calls`` to the longest chain below each call; None on and behind cycles."""
    found = dict.fromkeys(needs)
    for _ in needs:
        new = {}
        for (conv, call), others in needs.items():
            below = [found[conv, x] for x in others]
            new[conv, call] = None if None in below else 1 + max(below, default=-1)
        if new == found:
            break
        found = new
    return found


def trigram_features(text, bits=14):
    x = [b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in (text or "").encode()]
    mix = lambda a, b, c: (a * 0x9E3779B1 ^ b * 0x85EBCA6B ^ c * 0xC2B2AE35) & 0xFFFFFFFF
    return [((mix(*x[i : i + 3]) * 0x27D4EB2F) & 0xFFFFFFFF) >> (32 - bits) for i in range(len(x) - 2)]


def languages(labelled, held, unknown="und", features=1 << 14, evidence=40, strength=20, unknown_prior=1e-3, keep_from=0.5):
    """``labelled``: (label, text); ``held``: row -> (text, declared, suffix, host). Gives row -> (language, posterior, text_language, kept)."""
    counts = defaultdict(Counter)
    for label, text in labelled:
        if label is not None and len(trigram_features(text)):
            counts[label].update(trigram_features(text))
    every = [*sorted(counts), unknown]

    def score(text, language):
        found = trigram_features(text)
        total = sum(counts[language].values()) + features / 2
        p = [math.log((counts[language][t] + 0.5) / total) if language != unknown else -math.log(features) for t in found]
        return sum(p) * min(1, evidence / max(1, len(p)))

    best = lambda values: every[values.index(max(values))]
    scores = {row: [score(x[0], language) for language in every] for row, x in held.items()}
    guesses = {row: best(s) for row, s in scores.items() if max(s) < 0}
    total = Counter(guesses.values())
    base = [(total[x] + 1) / (len(guesses) + len(every)) for x in every]
    base[-1] = min(base[-1], unknown_prior)

    def by_value(which, value):
        if value is None or not any(held[r][which] == value for r in guesses):
            return [0] * len(every)
        n = Counter(g for r, g in guesses.items() if held[r][which] == value)
        return [math.log((n[x] + 1) / (total[x] + len(every))) for x in every]

    def prior(host):
        under = lambda domain: [g for r, g in guesses.items() if held[r][3] is not None and ("." + held[r][3]).endswith("." + domain)]
        if host is None or not under(host):
            return base
        shares = base
        labels = host.split(".")
        for depth in range(1, len(labels) + 1):
            rows = under(".".join(labels[-depth:]))
            shares = [(rows.count(x) + strength * share) / (len(rows) + strength) for x, share in zip(every, shares)]
        return shares

    result = {}
    for row, (_, declared, suffix, host) in held.items():
        logs = [sum(x) + math.log(p) for *x, p in zip(scores[row], by_value(1, declared), by_value(2, suffix), prior(host))]
        posterior = 1 / sum(math.exp(x - max(logs)) for x in logs)
        result[row] = best(logs), posterior, best(scores[row]), best(logs) != unknown and posterior >= keep_from
    return result
