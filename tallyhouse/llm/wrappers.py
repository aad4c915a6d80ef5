"""Main text of pages by wrapper induction: same-host trees are aligned, what stays the same is template.

1. Every page is parsed to a tree of elements with hashes of their texts. Pages of a host with the same containers (CONTAINERS
   that enclose text, with their paths of names and classes) are of one layout; ids, classes with digits and those of the body are mostly
   a page's own and tell nothing. Equal trees of a layout count once: copies of a page show nothing.
2. Every tree of a layout with at least MIN_PAGES of them is aligned to one of them, its reference, by simple tree matching:
   the largest mapping of nodes that keeps parents, order and labels. A text that at least SHARE of all these trees, and MIN_PAGES, hold in
   nodes matched to one node of the reference is a constant of the layout's template. Whole trees take part.
3. Every page is aligned to its reference again. Left out are matched constants, and elements whose
   name, class, id or role says menu, header, footer, sidebar, notice, advert, form, script, style or comment. A constant
   between varying siblings of its own kind lies within a slot and stays: pages may well repeat each other's paragraphs. If a page
   has an article (or main element), only its blocks are tried; if the template would leave nothing of it, it stays whole.
   Pages of layouts with too few trees lose the texts that are constants of another layout of the host under the same path.

Inside a block, white space becomes one space, character references are decoded; blocks are joined by one
line feed. Whole pages are read, whatever their length.

Defined results: a null or empty page gives the empty text; a null url or one without a host belongs to
the host ``""``; repeated pages are pages of their own; unclosed elements end with their parents; other columns
are not returned.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.staging import settled

MIN_PAGES = 3
SHARE = 0.8  # of the different pages of a layout, that hold a constant
NODE = 1 << 20
DEEPEST = 100  # levels of elements that paths tell apart
STORED = 1 << 20  # scores of a matching that are held at once; larger ones are halved

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
CLASS = re.compile(r"(?<![\w-])class\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
DIGIT = re.compile(r"\d")

RAW = frozenset("script style template noscript iframe svg canvas object".split())
ESCAPED = frozenset("textarea title xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Names that don't end a block of text; raw elements have no text of their own.
INLINE = RAW | frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr br img".split())
#: A start tag of these ends an open paragraph.
BLOCK = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ASIDE = frozenset("nav header footer aside form head script style select button dialog menu title textarea noscript template iframe svg canvas object".split())
ASIDE_NAMES = frozenset(
    "ad ads adv advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies discussion footer form "
    "header masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promotion related "
    "replies reply search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
MAIN = frozenset(("article", "main"))
#: Elements that tell layouts apart; a path counts up to its first other one.
CONTAINERS = frozenset("html head body div section article main header footer nav aside form".split())


class Node:
    """An element: its label for matching, its own texts, its children; ``shape``, ``size`` and ``every`` (texts) are of its subtree."""

    __slots__ = ("label", "texts", "children", "shape", "size", "every")

    def __init__(self, label: str):
        self.label, self.texts, self.children = label, [], []

    def sealed(self) -> Node:
        """This node, with what is known of subtrees filled in."""
        for child in self.children:
            child.sealed()
        self.shape = hash((self.label, *(c.shape for c in self.children)))
        self.size = 1 + sum(c.size for c in self.children)
        self.every = frozenset(self.texts).union(*(c.every for c in self.children))
        return self


def is_aside(name: str, attributes: str) -> bool:
    """Whether an element is named as something beside the main text."""
    if name in ASIDE:
        return True
    for key, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        value = "".join(values)
        if key.lower() == "role":
            if value.lower() in ASIDE_ROLES:
                return True
        elif name not in MAIN and name != "body" and name != "html":
            if ASIDE_NAMES.intersection(w.lower() for w in WORD.findall(value)):
                return True
    return False


def mark_of(name: str, attributes: str) -> str:
    """What tells an element from others of its name: its classes, but for those with digits, which are mostly a page's own.

    Ids tell nothing here, nor do classes of the whole page, which often name its article.
    """
    if "class" not in attributes.lower() or name == "body" or name == "html":
        return ""
    found = CLASS.search(attributes)
    kept = sorted({c for c in "".join(g or "" for g in found.groups()).split() if not DIGIT.search(c)}) if found else []
    return "." + " ".join(kept).replace("/", "_").replace("#", "_") if kept else ""


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """``("start" | "end" | "text", name, attributes or text)``; raw elements have no content."""
    at, size = 0, len(page)
    while at < size:
        found = TOKEN.match(page, at)
        at, name = found.end(), found[1]
        if name is None:
            if not found[0].startswith(("<!", "<?")):
                yield "text", "", found[0]
            continue
        name = name.lower()
        if found[0][1] == "/":
            yield "end", name, ""
            continue
        yield "start", name, found[2]
        if name in RAW or name in ESCAPED:
            close = re.compile(f"</{re.escape(name)}\\b[^>]*>", re.I).search(page, at)
            if name in ESCAPED:
                yield "text", "", page[at : close.start() if close else size]
            at = close.end() if close else size
            yield "end", name, ""


def blocks(page: str, numbered: bool = False) -> Iterator[tuple[str, bool, bool, str]]:
    """``(path, aside, in main, text)`` of each block of text, in page order.

    A path has names and classes only; ``numbered`` adds the number of each element, so that it tells siblings apart.
    """
    count = 0
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # name, path, aside, in main
    held: list[str] = []
    where = stack[0]

    def cut() -> Iterator[tuple[str, bool, bool, str]]:
        text = "".join(held)
        held.clear()
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            yield where[1], where[2], where[3], text

    for kind, name, rest in events(page):
        if kind == "text":
            if not held:
                where = next(s for s in reversed(stack) if s[0] not in INLINE)
                where = (where[0], where[1], stack[-1][2], stack[-1][3])
            elif stack[-1][2] != where[2]:  # an inline advert within a block
                yield from cut()
                where = (where[0], where[1], stack[-1][2], stack[-1][3])
            held.append(rest)
        elif kind == "start":
            if name == "br" or name == "wbr":
                held.append(" " if name == "br" else "")
                continue
            if name not in INLINE:
                yield from cut()
            if name in VOID:
                continue
            ends = CLOSES.get(name) or (("p",) if name in BLOCK else ())
            if name in MAIN:  # never part of an unclosed menu or header
                while len(stack) > 1 and any(s[0] in ASIDE for s in stack):
                    stack.pop()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ends:
                    del stack[i:]
                    break
                if stack[i][0] not in INLINE:
                    break
            above = stack[-1]
            mark = mark_of(name, rest)
            if numbered:
                count += 1
                mark += f"#{count}"
            main = above[3] or name in MAIN or "role=\"main\"" in rest
            deeper = name not in INLINE and len(stack) < DEEPEST
            stack.append((name, f"{above[1]}/{name}{mark}" if deeper else above[1], above[2] or is_aside(name, rest), main))
        else:
            if name not in INLINE:
                yield from cut()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
    yield from cut()


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def grown(found: list[tuple[str, bool, bool, str]]) -> tuple[Node, list[Node]]:
    """The tree of the (numbered) blocks of a page, with hashes of texts, and the node of each block."""
    root = Node("")
    path: list[tuple[str, Node]] = [("", root)]
    held = []
    for where, _, _, text in found:
        names = where.split("/")[1:]
        depth = 1
        while depth < len(path) and depth <= len(names) and path[depth][0] == names[depth - 1]:
            depth += 1
        del path[depth:]
        for name in names[depth - 1 :]:
            node = Node(name.rpartition("#")[0])
            path[-1][1].children.append(node)
            path.append((name, node))
        path[-1][1].texts.append(text_hash(text))
        held.append(path[-1][1])
    return root, held


def plain_path(where: str) -> str:
    """A numbered path without its numbers."""
    return "/".join(n.rpartition("#")[0] for n in where.split("/"))


def layout_of(found: list[tuple[str, bool, bool, str]]) -> int:
    """A fingerprint of the containers that enclose the (numbered) blocks of a page."""
    paths = set()
    for where in {f[0] for f in found}:
        names = plain_path(where).split("/")[1:]
        end = next((i for i, n in enumerate(names) if n.partition(".")[0] not in CONTAINERS), len(names))
        paths.add("/".join(names[:end]))
    return text_hash("\n".join(sorted(paths)))


def packed(node: Node) -> list:
    return [node.label, node.texts, [packed(c) for c in node.children]]


def unpacked(data: list) -> Node:
    node = Node(data[0])
    node.texts, node.children = data[1], [unpacked(c) for c in data[2]]
    return node


def heaviest(weight: Callable[[int], np.ndarray], rows: range, cols: range) -> list[tuple[int, int]]:
    """The pairs of the heaviest mapping of rows to columns that keeps their order; halved until the scores fit into STORED."""
    if not rows or not cols:
        return []

    def scores(some: range, step: int) -> Iterator[np.ndarray]:
        last = np.zeros(len(cols) + 1, np.int64)
        yield last
        for i in some[::step]:
            last = last.copy()
            last[1:] = np.maximum.accumulate(np.maximum(last[1:], last[:-1] + weight(i)[cols.start : cols.stop][::step]))
            yield last

    if len(rows) > 1 and len(rows) * len(cols) > STORED:
        half = len(rows) // 2
        for up in scores(rows[:half], 1):
            pass
        for down in scores(rows[half:], -1):
            pass
        cut = int((up + down[::-1]).argmax())
        return heaviest(weight, rows[:half], cols[:cut]) + heaviest(weight, rows[half:], cols[cut:])
    score = list(scores(rows, 1))
    found, i, j = [], len(rows), len(cols)
    while i and j:
        if score[i][j] == score[i - 1][j]:
            i -= 1
        elif score[i][j] == score[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.append((rows[i], cols[j]))
    return found[::-1]


def _largest(a: Node, b: Node, known: dict[tuple[int, int], int]) -> int:
    """Nodes in the largest mapping of two sealed trees; subtrees of equal shapes are measured once."""
    if a.label != b.label:
        return 0
    if a.shape == b.shape:
        return a.size
    if (a.shape, b.shape) not in known:
        known[a.shape, b.shape] = 1 + sum(_largest(a.children[i], b.children[j], known) for i, j in _children(a, b, known, frozenset()))
    return known[a.shape, b.shape]


def _children(a: Node, b: Node, known: dict[tuple[int, int], int], common: frozenset[int]) -> list[tuple[int, int]]:
    """Which children match: the most nodes, and among such mappings the most pairs with ``common`` texts."""
    x, y = a.children, b.children
    first, end = 0, min(len(x), len(y))
    own = lambda n: n.every & common if common else common
    # No other pair can be better than two equal shapes without texts that matter.
    while first < end and x[first].shape == y[first].shape and not own(x[first]) and not own(y[first]):
        first += 1
    found = [(i, i) for i in range(first)]
    if first == end:
        return found
    rest = y[first:]
    shapes: dict[int, int] = {}
    code = np.array([shapes.setdefault(n.shape, len(shapes)) for n in rest])
    kinds = list({n.shape: n for n in rest}.values())
    at: dict[int, list[int]] = {}
    for j, n in enumerate(rest):
        for t in own(n):
            at.setdefault(t, []).append(j)
    tables: dict[int, np.ndarray] = {}

    def weight(i: int) -> np.ndarray:
        n = x[first + i]
        if n.shape not in tables:
            tables[n.shape] = np.array([NODE * _largest(n, k, known) for k in kinds], np.int64)[code]
        w = tables[n.shape]
        if here := own(n):
            w = w.copy()
            for t in here:
                w[at.get(t, [])] += 1
            w[tables[n.shape] == 0] = 0
        return w

    return found + [(first + i, first + j) for i, j in heaviest(weight, range(len(x) - first), range(len(rest)))]


def matched(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the score of the largest mapping, and its pairs of nodes.

    A pair scores NODE; among mappings of the children of a pair that are of one size, those with more equal texts win.
    """
    a.sealed()
    b.sealed()
    if a.label != b.label:
        return 0, []
    common, known = a.every & b.every, {}
    found, score = [(a, b)], 0
    for x, y in found:
        score += NODE + (x.texts == y.texts != [])
        found.extend((x.children[i], y.children[j]) for i, j in _children(x, y, known, common))
    return score, found


def in_order(root: Node) -> list[Node]:
    """All nodes in page order."""
    found = [root]
    for child in root.children:
        found += in_order(child)
    return found


def held_alike(reference: Node, page: Node) -> set[tuple[int, int]]:
    """``(node number of the reference, text)`` of every text of the matched nodes of a page."""
    number = {id(n): i for i, n in enumerate(in_order(reference))}
    return {(number[id(a)], t) for a, b in matched(reference, page)[1] for t in b.texts}


def paths_of(root: Node, above: str = "") -> list[str]:
    """The path of every node, in page order."""
    found = [above]
    for child in root.children:
        found += paths_of(child, f"{above}/{child.label}")
    return found


def induced(pages: list[str]) -> list[list[int]]:
    """The constants of one layout, as ``[node, text]`` of its first page, from all its pages."""
    trees = [grown(list(blocks(p, numbered=True)))[0] for p in dict.fromkeys(p for p in pages if p)]
    seen = Counter(x for t in trees for x in held_alike(trees[0], t))
    return [list(x) for x, n in sorted(seen.items()) if n >= max(MIN_PAGES, SHARE * len(trees))]


def template_blocks(root: Node, held: list[Node], found: list, reference: Node, constants: set[tuple[int, int]]) -> list[bool]:
    """For each block of a page, whether it is template: a matched constant that doesn't lie within a varying slot."""
    number = {id(n): i for i, n in enumerate(in_order(reference))}
    partner = {id(b): number[id(a)] for a, b in matched(reference, root)[1]}
    fixed = [(partner.get(id(n)), text_hash(f[3])) in constants for n, f in zip(held, found)]
    varying: dict[tuple[str, str], list[int]] = {}  # of each kind of sibling: the first and the last block that vary
    kind = [(f[0].rpartition("/")[0], n.label) for f, n in zip(found, held)]
    for i, k in enumerate(kind):
        if not fixed[i]:
            varying.setdefault(k, [i, i])[1] = i
    return [x and not (k in varying and varying[k][0] < i < varying[k][1]) for i, (x, k) in enumerate(zip(fixed, kind))]


def main_text(page: str | None, template: tuple[Node, set[tuple[int, int]]] | None = None, elsewhere: frozenset[tuple[int, int]] = frozenset()) -> str:
    """The main text of a page whose layout has this reference and these constants, or else those by path."""
    found = list(blocks(page or "", numbered=True))
    cut = [False] * len(found)
    if template and template[1]:
        cut = template_blocks(*grown(found), found, *template)
    elif elsewhere:
        cut = [(text_hash(plain_path(where)), text_hash(text)) in elsewhere for where, _, _, text in found]
    inside = [(text, c) for (_, aside, main, text), c in zip(found, cut) if main and not aside]
    if inside:
        return "\n".join([text for text, c in inside if not c] or [text for text, _ in inside])
    return "\n".join(text for (_, aside, _, text), c in zip(found, cut) if not aside and not c)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``host, layout, print, tree`` of each page ``host, html``."""
    for batch in batches:
        out = []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = list(blocks(page.as_py() or "", numbered=True))
            if found:
                tree = json.dumps(packed(grown(found)[0]), separators=(",", ":"))
                out.append((host, layout_of(found), text_hash(tree), tree))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["host", "layout", "print", "tree"])


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``host, layout, node, path, text, n`` of the pages ``host, layout, tree, reference`` of a task."""
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        rows = [(*k, n) for k, n in seen.items()]
        seen.clear()
        types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["host", "layout", "node", "path", "text", "n"])

    for batch in batches:
        last, reference, paths = None, None, []
        for host, layout, tree, other in zip(*(c.to_pylist() for c in batch.columns)):
            if other != last:
                last, reference = other, unpacked(json.loads(other))
                paths = [text_hash(p) for p in paths_of(reference)]
            seen.update((host, layout, node, paths[node], text) for node, text in held_alike(reference, unpacked(json.loads(tree))))
            if len(seen) > 50_000:
                yield out()
    yield out()


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages with their layouts."""
    for batch in batches:
        layouts = [layout_of(list(blocks(p.as_py() or "", numbered=True))) for p in batch.column(2)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(layouts, pa.int64())], names=[*batch.schema.names, "layout"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, last, template, elsewhere = [], None, None, frozenset()
        for page, *known in zip(batch.column(2), *(batch.column(i).to_pylist() for i in (3, 4, 5))):
            if known != last:
                last, (reference, constants, others) = known, known
                template = (unpacked(json.loads(reference)), {(c["node"], c["text"]) for c in constants}) if constants else None
                elsewhere = frozenset((o["path"], o["text"]) for o in others or ())
            texts.append(main_text(page.as_py(), template, elsewhere))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def host_of(url):
    """The host of an address, in lower case; empty without one."""
    return F.coalesce(F.lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def templates(held: DataFrame) -> DataFrame:
    """``host, layout, reference, constants, others``: one row for each layout for which there is something to cut."""
    trees = settled(held.select("host", "html").mapInArrow(_trees, "host string, layout long, print long, tree string"), "wrapper-trees")
    one = ["host", "layout"]
    different = settled(trees.select(*one, "print").distinct(), "wrapper-different")
    sizes = settled(different.groupBy(*one).agg(F.count(F.lit(1)).alias("pages"), F.min("print").alias("print")), "wrapper-layouts")
    large = sizes.where(F.col("pages") >= MIN_PAGES)
    references = trees.join(large, [*one, "print"]).dropDuplicates(one).select(*one, "pages", F.col("tree").alias("reference"))
    references = settled(references, "wrapper-references")
    aligned = trees.dropDuplicates([*one, "print"]).join(references, one).select(*one, "tree", "reference")
    counts = aligned.mapInArrow(_matches, "host string, layout long, node int, path long, text long, n long")
    counts = counts.groupBy(*one, "node", "path", "text").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_PAGES)
    constants = settled(counts.join(references.select(*one, "pages"), one).where(F.col("n") >= SHARE * F.col("pages")), "wrapper-constants")
    own = constants.groupBy(*one).agg(F.collect_list(F.struct("node", "text")).alias("constants")).join(references, one)
    others = constants.select("host", "path", "text").distinct().groupBy("host").agg(F.collect_list(F.struct("path", "text")).alias("others"))
    few = sizes.where(F.col("pages") < MIN_PAGES).join(others, "host").select(*one, "others")
    return settled(own.select(*one, "reference", "constants").unionByName(few, allowMissingColumns=True), "wrapper-templates")


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    held = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = held.mapInArrow(_layouts, f"page_id {kind}, url string, html string, host string, layout long")
    rows = rows.join(templates(held), ["host", "layout"], "left").select("page_id", "url", "html", "reference", "constants", "others")
    return rows.mapInArrow(_extracted, f"page_id {kind}, url string, text string, n_chars long")
