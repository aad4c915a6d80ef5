"""Operators on pages, vectors and conversations against plain versions."""

import itertools
import json
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import components, queries, tool_links, url_rules, vector_groups, wrappers
from tallyhouse.operators import staging
from tests.llm import plain

FOLDER = "/root/testdata/sf0.01"


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, size=(220, 2))]
    edges += [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 600)] + [(7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    roots = plain.union_find(600, edges)
    assert got == {i: roots[i] for a, b in edges for i in (a, b) if a != b}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(9, 12))
    rows = []
    for i in range(260):
        v = centres[i % 9] + rng.normal(size=12) * (0.25 if i % 2 else 0.6)
        rows.append((i, v.tolist()))
        if i % 6 == 0:
            rows.append((1000 + i, (v * 3).tolist()))
    rows += [(2000 + i, rows[0][1]) for i in range(40)]
    near = rng.normal(size=12)
    rows += [(3000 + i, (near + rng.normal(size=12) * 0.05).tolist()) for i in range(60)]
    return rows + [(4000, None), (4001, []), (4002, [0.0] * 12), (4003, [1.0] * 11 + [None]), (4004, [float("nan")] * 12), (4005, [float("inf")] + [1.0] * 11), (4006, [1.0, 2.0])]


@pytest.mark.parametrize("cell, block", [(4096, 8192), (24, 8192), (24, 16)])
def test_vector_groups(spark, vectors, monkeypatch, cell, block):
    monkeypatch.setattr(vector_groups, "CELL_ROWS", cell)
    monkeypatch.setattr(vector_groups, "BLOCK", block)
    monkeypatch.setattr(vector_groups, "STRIP", 7)
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id long, embedding array<double>, label int, unit string").repartition(4)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vector_groups.vector_groups(frame).collect())
    assert got == sorted(plain.vector_groups(vectors))


def test_pairs_at_the_threshold_do_not_depend_on_their_block(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.array([vector_groups.unit(v.tolist()) for v in rng.normal(size=(300, 64))])
    side = np.array([vector_groups.unit((v - (v @ u) * u).tolist()) for u, v in zip(x, rng.normal(size=(300, 64)))])
    y = 0.9 * x + np.sqrt(1 - 0.81) * side  # cosines of 0.9, up to the last bits
    possible = np.eye(300, dtype=bool)
    verdicts = []
    for dense in (0.0, 1.0):
        monkeypatch.setattr(vector_groups, "DENSE", dense)
        i, j = vector_groups.linked_pairs(x, y, possible)
        verdicts.append(sorted(a for a, b in zip(i.tolist(), j.tolist()) if a == b))
    assert verdicts[0] == verdicts[1] and 0 < len(verdicts[0]) < 300


@pytest.mark.parametrize("cell", [4096, 24])
def test_vectors_of_several_lengths(spark, vectors, monkeypatch, cell):
    monkeypatch.setattr(vector_groups, "CELL_ROWS", cell)
    short = [(10_000 + i, v[:7]) for i, v in vectors if v and len(v) == 12 and i % 3]
    frame = spark.createDataFrame(vectors + short, "vec_id long, embedding array<double>").repartition(4)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vector_groups.vector_groups(frame).collect())
    assert got == sorted(plain.vector_groups(vectors) + plain.vector_groups(short))
    assert sum(n for i, n, _ in got if i >= 10_000) > 100


def test_vectors_without_any_direction(spark):
    rows = spark.createDataFrame([(1, None), (2, [0.0]), (None, [1.0])], "vec_id long, embedding array<double>")
    assert sorted((str(r.vec_id), r.n_links, r.kept) for r in vector_groups.vector_groups(rows).collect()) == [("1", 0, True), ("2", 0, True), ("None", 0, True)]
    assert vector_groups.vector_groups(rows.limit(0)).count() == 0


def test_recall_over_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = {i: int((x[n] @ x.T >= 0.9).sum()) - 1 for n, (i, _) in enumerate(rows)}
    assert {r.vec_id: r.n_links for r in vector_groups.vector_groups(table).collect()} == want


def test_disk_of_vectors_does_not_grow_with_the_cells_they_reach(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(4000, 64)).astype(np.float32)
    x[::50] = x[1::50] + rng.normal(size=(80, 64)).astype(np.float32) * 0.02
    schema = "vec_id long, embedding array<float>"
    spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], schema).write.parquet(str(tmp_path / "in"))
    given = sum(f.stat().st_size for f in (tmp_path / "in").glob("*.parquet"))
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    left = lambda: sum(f.length() for f in (files.getAllFiles().apply(i) for i in range(files.getAllFiles().size())))
    rows, disk = {}, {}
    for cell in (4096, 100):
        monkeypatch.setattr(vector_groups, "CELL_ROWS", cell)
        monkeypatch.setattr(vector_groups, "BLOCK", 500)
        first, before = len(staging._WRITTEN), left()
        found = vector_groups.vector_groups(spark.read.parquet(str(tmp_path / "in")))
        folders = [Path(re.sub("^file:/*", "/", p)) for p in staging._WRITTEN[first:]]
        disk[cell] = sum(f.stat().st_size for p in folders for f in p.glob("*.parquet")) + max(0, left() - before)
        rows[cell] = sorted((r.vec_id, r.n_links, r.component_id) for r in found.collect())
    assert rows[4096] == rows[100] and sum(n for _, n, _ in rows[100]) == 160
    assert max(disk.values()) < 4 * given and disk[100] < 1.2 * disk[4096]


def test_vectors_of_single_precision_and_odd_scales(spark, monkeypatch):
    monkeypatch.setattr(vector_groups, "CELL_ROWS", 50)
    monkeypatch.setattr(vector_groups, "BLOCK", 40)
    rng = np.random.default_rng(12)
    ends = rng.normal(size=(6, 2, 10))
    x = np.array([ends[i % 6, 0] * t + ends[i % 6, 1] * (1 - t) for i, t in enumerate(rng.uniform(size=600))])  # chains across cells
    x = (x * rng.choice([1e-30, 1e-3, 1, 1e36], size=(600, 1))).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(7, x[8].tolist()), (7, (x[9] * 0.5).tolist())]  # equal ids
    rows += [(1000, [1.0] * 9 + [None]), (1001, None), (1002, [float("nan")] * 10), (1003, []), (1004, [0.0] * 10), (1005, [float("-inf")] + [1.0] * 9)]
    got = vector_groups.vector_groups(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)).collect()
    want = {i: n for i, n, _ in plain.vector_groups(rows)}
    assert {r.vec_id: r.n_links for r in got if r.vec_id not in (7, 8, 9)} == {i: n for i, n in want.items() if i not in (7, 8, 9)}
    assert len(got) == len(rows) and max(want.values()) > 50


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    got = wrappers.main_texts(pages).collect()
    assert len(got) == len(html)
    for r in got:
        assert r.text == plain.article(html[r.page_id])
        assert r.n_chars == len(r.text)


def host_page(n, body, side="Latest news of the day", tag="div"):
    return (f"<html><head><title>t{n}</title></head><body><div><p>All about the house</p></div><{tag}>{body}</{tag}>"
            f"<div><p>{side}</p></div><div class='user-comments'><p>nice {n}</p></div><form><p>mail</p></form></body>")


def test_template_comes_from_alignment(spark):
    rows = [(n, f"http://a.org/{n}", host_page(n, f"<p>Story {n} &amp; <b>mo</b>re</p><p>end {n * n}<br>of it</p>" + "<p>extra</p>" * (n % 3))) for n in range(12)]
    rows += [(100 + n, "https://B.org/x", host_page(1, "<p>copy</p>")) for n in range(8)]  # copies show no template
    rows += [(200, "http://a.org/u", host_page(7, "<p>in main</p><p>All about the house</p>", tag="main"))]
    rows += [(300, None, "<p>x"), (301, "none", None), (302, "http://c/", ""), (303, "http://c/", "<!-- <p>no</p>"), (304, "http://c/", "plain &lt;text&gt;  here"), (305, "http://c/", "<p>a<p>b<script>if (a<b) {'</p>'}</script>c<div>d")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, constants string").repartition(3)
    got = {r.page_id: r.text for r in wrappers.main_texts(frame).collect()}
    for n in range(12):
        assert got[n] == "\n".join([f"Story {n} & more", f"end {n * n} of it"] + ["extra"] * (n % 3))
    assert got[100] == got[107] == "All about the house\ncopy\nLatest news of the day"
    assert got[200] == "in main\nAll about the house"  # an article is never cut by the template
    assert [got[n] for n in range(300, 306)] == ["x", "", "", "", "plain <text> here", "a\nbc\nd"]


def test_template_cuts_articles_but_not_their_repeated_paragraphs(spark):
    body = "<div><p>All about the house</p></div><article><div><p>Read this in our shop</p></div><p>Story {n}</p><p>as ever</p><p>end {n}</p><p>Write to us</p></article><div><p>bye</p></div>"
    rows = [(n, f"http://a.org/{n}", "<html><body>" + body.format(n=n)) for n in range(9)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in wrappers.main_texts(frame).collect()}
    assert got == {n: f"Story {n}\nas ever\nend {n}" for n in range(9)}


def test_template_of_every_layout_and_of_long_pages(spark):
    long = lambda n: "".join(f"<p>story {n} {i}</p>" for i in range(450 + n))
    rows = [(n, f"http://a.org/{n}", f"<body><section>{long(n)}</section><div><p>end of a</p></div>") for n in range(12)]
    rows += [(100 + n, f"http://a.org/b{n}", f"<body><div><p>top of b</p></div><div class='b'><p>text {n}</p></div>") for n in range(4)]
    rows += [(200 + n, f"http://b.org/{n}", f"<body><section><p>text {n}</p></section><div><p>end</p></div>") for n in range(3)]
    rows += [(300, "http://a.org/c", "<body><section><p>one</p></section><div><p>end of a</p></div><section><form>mail</form></section><div class='c'><p>two</p></div>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in wrappers.main_texts(frame).collect()}
    assert all(got[n].split("\n") == [f"story {n} {i}" for i in range(450 + n)] for n in range(12))
    assert [got[100 + n] for n in range(4)] == [f"text {n}" for n in range(4)]
    assert [got[200 + n] for n in range(3)] == [f"text {n}" for n in range(3)]
    assert got[300] == "one\ntwo"  # a layout of one page takes the constants of the host's others


@pytest.mark.parametrize("around", [
    "<html class='no-js p{n}'><body class='single postid-{n} title-of-{word}'><div id='post-{n}' class='post post-{n} hentry'>{body}</div><div id=f{n}><p>All rights kept by the house</p></div>",
    "<body><section CLASS=\"box x{n}y\" data-class='d-{word}'><article id=a-{n} class='css-{n}ab entry'>{body}</article></section><section id='{word}'><p>All rights kept by the house</p></section>",
])
def test_classes_and_ids_of_single_pages_leave_one_layout(spark, around):
    body = "<p>Send this to your friends</p><div class='text t{n}'><p>Story {n} of {word}</p><p>end {n}</p></div><p>More of our news</p>"
    words = "oak ash elm fir yew box bay fig may pea".split()
    pages = [around.replace("{body}", body).replace("{n}", str(n + 10)).replace("{word}", w) for n, w in enumerate(words)]
    frame = spark.createDataFrame([(n, f"http://a.org/{n}", h) for n, h in enumerate(pages)], "page_id long, url string, html string").repartition(3)
    assert len({wrappers.layout_of(list(wrappers.blocks(h, numbered=True))) for h in pages}) == 1
    got = {r.page_id: r.text for r in wrappers.main_texts(frame).collect()}
    assert got == {n: f"Story {n + 10} of {w}\nend {n + 10}" for n, w in enumerate(words)}
    alone = wrappers.main_text(pages[0])  # what a page shows by itself has the lines around the story
    assert "Send this to your friends" in alone and "More of our news" in alone


def test_marks():
    assert wrappers.mark_of("div", " id='x' class='b a a p12'") == ".a b"
    assert wrappers.mark_of("div", " class=one") == ".one"
    assert wrappers.mark_of("div", " data-class='x'") == wrappers.mark_of("div", " class=''") == wrappers.mark_of("div", " class") == ""
    assert wrappers.mark_of("body", " class='home'") == ""


def test_halved_matching(monkeypatch):
    rng = np.random.default_rng(8)
    w = rng.integers(0, 5, size=(30, 40))
    total = lambda pairs: sum(int(w[i, j]) for i, j in pairs)
    want = total(wrappers.heaviest(lambda i: w[i], range(30), range(40)))
    monkeypatch.setattr(wrappers, "STORED", 50)
    pairs = wrappers.heaviest(lambda i: w[i], range(30), range(40))
    assert total(pairs) == want and all(a < c and b < d for (a, b), (c, d) in itertools.pairwise(pairs))


def test_largest_mapping():
    def size(node):
        return 1 + sum(map(size, node.children))

    def node(shape):
        made = wrappers.Node(shape[0])
        made.children = [node(s) for s in shape[1:]]
        return made

    def brute(a, b):
        """All order-keeping choices of children."""
        if a.label != b.label:
            return 0
        best = 0
        for k in range(min(len(a.children), len(b.children)) + 1):
            for left in itertools.combinations(a.children, k):
                for right in itertools.combinations(b.children, k):
                    best = max(best, sum(brute(x, y) for x, y in zip(left, right)))
        return 1 + best

    shapes = [("a",), ("a", ("b",), ("c", ("b",))), ("a", ("c", ("b",), ("d",)), ("b",)), ("a", ("b", ("c",)), ("b",), ("c", ("d",), ("b",))), ("b", ("a",))]
    for x, y in itertools.product(map(node, shapes), repeat=2):
        n, pairs = wrappers.matched(x, y)
        assert n == brute(x, y) * wrappers.NODE and n == len(pairs) * wrappers.NODE
        assert wrappers.matched(x, x)[0] == size(x) * wrappers.NODE


def test_deep_and_long_pages():
    assert wrappers.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert wrappers.main_text("<article>" + "<p>word</p>" * 20_000).count("\n") == 19_999
    assert wrappers.induced(["<div>" * 500 + f"x{i}" for i in range(4)]) == []


def plain_judge(url):
    """Host, path and the given rule of an address."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(plain.SMALL.get(c, c) for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = []
    for verdict, rule in url_rules.RULES:
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules(spark):
    good = [f"https://www.site{i}.net/news/{i}.html?page=1" for i in range(80)]
    spam = [f"http://cheap-pills.shop.net/buy/{i}?ref=x" for i in range(60)]
    odd = [None, "", "no scheme/at all", "http://", "ftp://EXAMPLE.org/en/12", "https://example.org/en/2", "https://a.example.org/es/?q", "http://x.com/fr/",
           "http://com/de/x", "http://xcom/de/x", "http://a.COM/de#y", "http://a.com?/de/", "http://b.org/\n/x", "http://buy.net/other", "http://example.org/es"]
    urls = good + spam + odd
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, items string, rule string").repartition(3)
    labels = spark.createDataFrame([(i, u in spam) for i, u in enumerate(urls) if i % 3 and i < 140] + [(5, None), (7, False)], "page_id long, bad boolean")
    got = {r.page_id: r for r in url_rules.judged(pages, labels).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule, verdict = plain_judge(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        # The labels make any address with an item of the spam alone a bad one.
        wanted = verdict or ("block" if u and any(x in u for x in ("cheap-pills", "shop.net", "/buy/", "ref=")) else "allow")
        assert got[i].verdict == wanted, u
    no_labels = url_rules.judged(pages, labels.limit(0))
    assert {r.verdict for r in no_labels.where("rule is null").collect()} == {"allow"}
    assert url_rules.judged(pages.limit(0), labels).count() == 0


def test_mined_rules_like_all_item_sets(spark):
    rng = np.random.default_rng(9)
    rows = [(sorted({f"i{k}" for k in rng.integers(0, 6, size=4)}), bool(rng.random() < 0.5)) for _ in range(400)]
    rows = [(x, bad or {"i1", "i3"} <= set(x)) for x, bad in rows]
    frame = spark.createDataFrame([([*x, "like " + x[0]] if x else x, bad) for x, bad in rows], "items array<string>, bad boolean")
    frame = frame.withColumn("items", F.array_sort(F.filter("items", lambda x: ~x.startswith("like") | (x == "like i0"))))
    index, of = url_rules.mined(frame)  # "like i0" occurs with i0 alone: one class
    assert {r.item: r["class"] for r in of.collect()} == {f"i{k}": f"i{k}" for k in range(6)} | {"like i0": "i0"}
    got = {tuple(r["items"]): r for r in index.collect()}
    count, bads = Counter(), Counter()
    for x, bad in rows:
        for k in range(1, len(x) + 1):
            for part in itertools.combinations(x, k):
                count[part] += 1
                bads[part] += bad
    sure = {p: bads[p] / count[p] for p in count if bads[p] >= 20 and bads[p] / count[p] >= url_rules.MIN_CONFIDENCE}
    base = sum(bad for _, bad in rows) / len(rows)
    kept = {p for p in sure if not any(set(q) < set(p) and sure[q] >= sure[p] for q in sure) and sure[p] >= url_rules.MIN_LIFT * base}
    assert set(got) == kept and kept
    assert all(got[p].confidence == pytest.approx(sure[p]) for p in kept)
    assert all(got[p].key == min(p, key=lambda i: (count[i,], i)) for p in kept)


def test_mined_rules_decide_and_long_shared_paths_are_cheap(spark):
    """The same bad word in a small and in a large table, 40 shared segments, and words within labels and slugs."""
    long = "/".join(f"part{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(40))
    for n in (300, 12_000):
        urls = [f"https://blog{i % 7}.net/{'best-casino-bonus' if i < 40 else 'calm-garden-news'}-{i}/" for i in range(n - 200)]
        urls += [f"http://deep.net/{long}/{i}" for i in range(100)] + [f"https://casino-win{i}.net/x" for i in range(100)]
        pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4)
        labels = spark.createDataFrame([(i, "casino" in u or i % 29 == 0) for i, u in enumerate(urls) if i < n - 50], "page_id long, bad boolean")
        verdicts = {r.page_id: r.verdict for r in url_rules.judged(pages, labels).collect()}
        assert all((verdicts[i] == "block") == ("casino" in u) for i, u in enumerate(urls))
        assert sum(v == "block" for v in verdicts.values()) == 140


SCHEMAS = {"add": {"x": ("integer", True), "y": ("number", True), "note": ("string", False)}, "list": {"of": ("array", True), "deep": ("object", False), "on": ("boolean", False)}}
CALL = "conv_id long, call_id string, turn long, name string, arguments string, needs array<string>"
RESULT = "conv_id long, call_id string, turn long, content string"


@pytest.fixture(scope="module")
def linked(spark):
    calls = [
        (1, "a", 1, "add", '{"y": 2.50, "x": 1}', None), (1, "b", 2, "add", '{"x": "1", "z": 0}', ["a"]), (1, "c", 3, "list", '{"on":true,"of":[ {"q":1,"p":null} ]}', ["a", "b", "lost"]),
        (1, "a", 9, "add", "{}", None), (2, "p", 1, "add", "no json", ["q"]), (2, "q", 2, "add", '{"x":1,"y":1}', ["r"]), (2, "r", 3, "add", '{"x":1,"y":1}', None),
        (3, "s", 1, "add", "[1]", ["t"]), (3, "t", 2, "nope", "{}", ["s"]), (3, "u", 3, "add", '{"x":1,"y":1}', ["t"]), (None, "a", 1, "add", None, None), (4, None, 1, "add", "", None), (3, "v", 4, "list", '{"of":[],"deep":{"b":1,"a":"ä\\"\\n"}}', None)]
    results = [(1, "a", 2, "three"), (1, "a", 3, "again"), (1, "zzz", 4, "nobody"), (2, "r", 4, None), (None, "a", 5, "x"), (3, "v", 5, "ok")]
    rows = tool_links.linked(spark.createDataFrame(calls, CALL), spark.createDataFrame(results, RESULT), SCHEMAS).collect()
    return rows


def test_links_and_problems(linked):
    got = {(r.conv_id, r.call_id): r for r in linked if r.conv_id and r.call_id}
    assert len(linked) == 14
    assert (got[1, "a"].status, got[1, "a"].n_calls, got[1, "a"].n_results, got[1, "a"].result_turn) == ("linked", 2, 2, 2)
    assert got[1, "b"].problems == ["unknown field z", "field x is not integer", "missing field y"]
    assert got[1, "c"].problems == ["unknown dependency"]
    assert got[2, "p"].problems == got[3, "s"].problems[:1] == ["arguments are not a JSON object"]
    assert got[3, "t"].problems == ["unknown function", "cyclic dependency"]
    assert got[1, "zzz"].status == "no call" and got[1, "zzz"].name is None
    assert got[2, "q"].status == "no result"
    assert sum(r.conv_id is None for r in linked) == 2 and sum(r.call_id is None for r in linked) == 1


def test_topological_order(linked):
    got = {(r.conv_id, r.call_id): r for r in linked if r.conv_id and r.call_id}
    order = [k for k, r in sorted(got.items(), key=lambda x: (x[1].level if x[1].level is not None else 99, x[1].turn or 0))]
    assert [k for c, k in order if c == 2] == ["r", "q", "p"]
    assert [k for c, k in order if c == 1][:3] == ["a", "b", "c"]
    assert got[3, "u"].level is None and got[3, "s"].level is None and got[3, "v"].level == 0


def test_levels_are_longest_chains(spark, monkeypatch):
    """Random needs, forward and backward, some in cycles, one chain of 700 calls written backwards, one call that 300 others need."""
    rng = random.Random(5)
    needs = {}
    for conv in range(40):
        n = rng.randrange(1, 12)
        for i in range(n):
            needs[conv, f"c{i}"] = sorted({f"c{rng.randrange(n)}" for _ in range(rng.randrange(3)) if conv % 3 or rng.random() < 0.4})
    needs |= {(50, f"c{i}"): [f"c{i + 1}"] if i < 699 else [] for i in range(700)}
    needs |= {(51, f"c{i}"): ["c0"] if i else [] for i in range(300)}
    turn = {k: rng.randrange(1000) for k in needs}
    calls = [(conv, call, turn[conv, call], "add", "{}", n) for (conv, call), n in needs.items()]
    rounds, real = [], tool_links.settled
    monkeypatch.setattr(tool_links, "settled", lambda df, name: rounds.append(name) or real(df, name))
    results = spark.createDataFrame([], RESULT)
    got = {(r.conv_id, r.call_id): r.level for r in tool_links.linked(spark.createDataFrame(calls, CALL), results, SCHEMAS).collect()}
    assert got == plain.levels(needs)
    assert {None, 0, 1, 2, 699} <= set(got.values())
    assert rounds.count("tool-paths") < 60 and rounds.count("tool-followed") < 10


def test_canonical_json(linked):
    for r in linked:
        value = json.loads(r.json)
        assert r.json == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    got = {(r.conv_id, r.call_id): json.loads(r.json) for r in linked}
    assert got[3, "v"]["arguments"] == {"deep": {"a": 'ä"\n', "b": 1}, "of": []}
    assert got[1, "a"]["result"] == "three" and got[1, "c"]["arguments"] == {"of": [{"p": None, "q": 1}], "on": True}


def test_chats(spark):
    turns = spark.createDataFrame([(1, 0, "system", "be"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo"), (1, 3, "user", "so"), (2, 0, "user", None), (2, 1, "assistant", "x"), (2, 1, "assistant", "x"), (None, None, None, None), (3, 0, "assistant", "alone")],
                                  "conv_id long, turn long, role string, text string")
    calls, results = tool_links.chat_calls(turns)
    rows = tool_links.linked(calls, results, tool_links.CHAT_SCHEMAS).orderBy("conv_id", "call_id").collect()
    assert [(r.conv_id, r.call_id, r.status) for r in rows] == [
        (1, "turn-0", "no result"), (1, "turn-1", "linked"), (1, "turn-3", "no result"), (2, "turn-0", "invalid"), (3, "turn--1", "no call")]
    assert {r.call_id: r.needs for r in calls.collect()}["turn-3"] == ["turn-0", "turn-1"]
    none = turns.limit(0)
    assert tool_links.linked(*tool_links.chat_calls(none), tool_links.CHAT_SCHEMAS).count() == 0


def test_tool_links_stay_in_the_jvm(spark):
    calls, results = tool_links.chat_calls(spark.read.parquet(f"{FOLDER}/conversations.parquet"))
    plan = tool_links.linked(calls, results, tool_links.CHAT_SCHEMAS)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_oracles(spark):
    from tests.compare import connect, differences

    con = connect(FOLDER)
    for name, sql in queries.ORACLES.items():
        assert differences(queries.QUERIES[name](spark, FOLDER), con, sql) == [], name
    con.close()


def test_pipeline_runs_stage_by_stage(spark):
    """The stages against plain versions of what they decide, on the given table."""
    import corpus_pipeline

    from tallyhouse.llm import quality

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.schema == docs.schema or out.columns == docs.columns, name
        before, after = docs.collect(), out.cache().collect()
        kept[name] = {r.doc_id for r in after}
        assert set(after) <= set(before)
        if name == "quality_rules":
            bits = {r.doc_id: r.fail_bits for r in quality.ledger(docs).collect()}
            assert kept[name] == {i for i, b in bits.items() if not b & quality.mask(quality.CURRENT)}
        if name == "language_id":
            assert kept[name] == {r.doc_id for r in before}
        if name == "jaccard_join":
            assert kept[name] == {i for i, _, c in plain.jaccard_groups([(r.doc_id, r.text) for r in before]) if i == c}
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in docs.collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, last))


ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, scores int, digest string, label string, fail_bits long, n_words string"


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null and repeated ids, null and empty texts, null languages, a long text, columns with the operators' own names."""
    import corpus_pipeline

    given = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(150).collect()
    more = ("r", 1, "d", None, 3, "w")
    rows = [(r.doc_id, r.text, r.lang, r.source, len(r.text or "")) + more for r in given]
    first = next(r for r in rows if r[1] and len(r[1].split()) > 60)
    rows += [first, (None, first[1], None, None, 1) + more, (None, None, None, None, None) + more, (10**9, "", "en", "", 0) + more]
    rows += [(10**9 + 1, " ".join(f"{w}{i % 977}" for i in range(300) for w in first[1].split()[:40]), first[2], "hot", 5) + more]
    spark.createDataFrame(rows, ODD_SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    judged = Counter()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        before, after = Counter(map(tuple, docs.collect())), Counter(map(tuple, out.cache().collect()))
        assert not after - before, name  # rows of the predecessor only, none more often
        judged[name] = sum(before.values()) - sum(after.values())
        docs = out
    assert judged["quality_rules"] >= 2 and judged["jaccard_join"] >= 1
    assert not [r for r in docs.collect() if not r.text]
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in docs.collect())


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], ODD_SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
