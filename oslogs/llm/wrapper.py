"""Main text of web pages by wrapper induction.

The pages of a host come out of the same template. Their element trees are aligned by simple tree matching (the largest
order-preserving match of children with equal labels, level by level): nodes whose text is the same on all aligned pages
are template, the others are slots. The slot region that holds the article is found once per host on the aligned tree, and
every page gives the text below those of its nodes that align with it.

Trees are merged where the pages are read, one per host and batch; those are merged per host in rounds of a bounded
number, so that a host with a third of all pages is no larger a task than any other.
"""

from __future__ import annotations

import hashlib
import json
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oslogs.llm import dom
from oslogs.llm.common import map_batches, written

MERGED = 32  # trees of a host that one task merges
NODES = 3000  # beyond so many, a host's tree loses nodes that few pages have; pages keep their text
WIDEST = 64  # runs of children that are aligned in their order
SPREAD = 16  # parts of each host in the join with its pages

# What is never part of an article, by element and by the whole words of class, id and role.
LEFT_OUT = frozenset(
    "head nav footer aside form script style noscript template iframe button select input textarea label svg canvas audio video object dialog menu "
    "noembed noframes xmp map datalist fieldset".split()
)
LEFT_OUT_WORDS = frozenset(
    "ad ads adsense advert advertisement adverts advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription share sharing social comment comments "
    "disqus respond reply replies related recommended widget toolbar pagination pager login signup search hidden complementary contentinfo skip".split()
)
HEADER_WORDS = frozenset({"header", "banner"})
COMMENT_WORDS = frozenset("comment comments disqus respond reply replies".split())
ARTICLE_WORDS = frozenset({"articlebody", "main", "article", "hentry"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAVES = HEADINGS | frozenset("p pre blockquote ul ol dl li dd dt table tr td th figure figcaption".split())


def left_out(node: dom.Node, inside_article: bool) -> bool:
    if node.tag in LEFT_OUT:
        return True
    if node.tag in ("html", "body", "article", "main", "#root") or node.tag in HEADINGS:
        return node.tag == "article" and bool(node.tokens & {"comment", "comments", "reply"})
    if node.tag == "header" or node.tokens & HEADER_WORDS:
        return not (inside_article and _has_heading(node))
    return bool(node.tokens & LEFT_OUT_WORDS)


def _kind(node: dom.Node) -> tuple:
    return node.tag, node.words, bool(node.tokens & (LEFT_OUT_WORDS | HEADER_WORDS))


def _has_heading(node: dom.Node) -> bool:
    ahead = list(node.children)
    while ahead:
        c = ahead.pop()
        if isinstance(c, dom.Node):
            if c.tag in HEADINGS:
                return True
            ahead += c.children
    return False


BY_TAG, BY_WORD = 1, 2


class Tree:
    """A node of an aligned tree: its label, the sum of its own text (0: it varies), signs of text, pages, children.

    ``out`` marks what is no article (BY_TAG: never; BY_WORD: unless it turns out to hold the article); ``nodes`` are the page's elements, one or a run of equal neighbours.
    """

    __slots__ = ("label", "sum", "chars", "pages", "children", "out", "nodes", "form")

    def __init__(self, label: str, total: int, chars: int, pages: int, children: list[Tree], out: int, nodes: list[dom.Node] | None = None):
        self.label, self.sum, self.chars, self.pages, self.children, self.out, self.nodes = label, total, chars, pages, children, out, nodes or []
        self.form: bytes | None = None

    def shape(self) -> bytes:
        """A digest of the labels of the whole tree."""
        for t in reversed(list(self.below())) if self.form is None else ():
            if t.form is None:
                t.form = hashlib.md5(json.dumps([t.label, len(t.children)]).encode() + b"".join(c.form for c in t.children)).digest()
        return self.form

    def below(self) -> Iterator[Tree]:
        """The nodes of the tree, parents before their children, in their order."""
        ahead = [self]
        while ahead:
            t = ahead.pop()
            yield t
            ahead += t.children[::-1]

    def dump(self) -> list:
        return [[t.label, t.sum, t.chars, t.pages, int(t.out), len(t.children)] for t in self.below()]

    @staticmethod
    def load(rows: list) -> Tree:
        ready: list[Tree] = []
        for label, total, chars, pages, out, n in reversed(rows):
            children = [ready.pop() for _ in range(n)]
            ready.append(Tree(label, total, chars, pages, children, out))
        return ready[0]


def _own_text(node: dom.Node) -> list[str]:
    """Text of a node outside the block elements below it."""
    out, ahead = [], node.children[::-1]
    while ahead:
        c = ahead.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.tag not in dom.BLOCKS and c.tag not in LEFT_OUT:
            ahead += c.children[::-1]
    return out


def _blocks_below(node: dom.Node):
    ahead = node.children[::-1]
    while ahead:
        c = ahead.pop()
        if isinstance(c, dom.Node):
            if c.tag in dom.BLOCKS or c.tag in LEFT_OUT:
                yield c
            else:
                ahead += c.children[::-1]


@dom.deep
def tree_of(nodes: list[dom.Node], inside: bool = False):
    """The tree of one element, or of a run of neighbours with one label; inline elements count as their text."""
    first = nodes[0]
    label = first.tag + ("." + ".".join(sorted(first.words)) if first.words else "")
    text = " ".join(" ".join("".join(_own_text(n)) for n in nodes).split())
    if first.tag in LEFT_OUT:
        return Tree(label, zlib.crc32(text.encode()) or 1, len(text), 1, [], BY_TAG, nodes)
    out = 0 if not left_out(first, inside) else BY_TAG if first.tag in ("header", "article") or inside and first.tokens & COMMENT_WORDS else BY_WORD
    if out:
        label += ".!"
    inside = inside or first.tag == "article"
    runs: list[list[dom.Node]] = []
    for n in nodes:
        for c in _blocks_below(n):
            if runs and _kind(runs[-1][0]) == _kind(c):
                runs[-1].append(c)
            else:
                runs.append([c])
    if len(nodes) > 1 or len(runs) > WIDEST:  # of neighbours, and where there are many, children of a like kind are one
        by: dict[tuple, list[dom.Node]] = {}
        for run in runs:
            by.setdefault(_kind(run[0]), []).extend(run)
        runs = list(by.values())
    children = []
    for r in runs:
        children.append((yield tree_of.each(r, inside)))
    return Tree(label, zlib.crc32(text.encode()) or 1, len(text), 1, children, out, nodes)


@dom.deep
def match(a: list[Tree], b: list[Tree]):
    """The order-preserving pairs of two lists of children with the largest total of simple tree matching."""
    n, m = len(a), len(b)
    if n == m and all(x.label == y.label for x, y in zip(a, b)):
        return [(i, i) for i in range(n)]
    weight = []
    for x in a:
        weight.append([])
        for y in b:
            weight[-1].append((yield _score.each(x, y)) if x.label == y.label else 0)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            take = best[i + 1][j + 1] + weight[i][j] if weight[i][j] else 0
            best[i][j] = max(take, best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if weight[i][j] and best[i][j] == best[i + 1][j + 1] + weight[i][j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


_SCORES: dict[tuple[bytes, bytes], int] = {}


@dom.deep
def _score(a: Tree, b: Tree):
    """Simple tree matching: how many nodes of two trees can be paired, roots with roots."""
    if a.label != b.label:
        return 0
    key = a.shape(), b.shape()
    if key not in _SCORES:
        score = 1
        for i, j in (yield match.each(a.children, b.children)):
            score += yield _score.each(a.children[i], b.children[j])
        if len(_SCORES) > 100_000:
            _SCORES.clear()
        _SCORES[key] = score
    return _SCORES[key]


@dom.deep
def merge(a: Tree, b: Tree):
    """Two aligned trees as one: text that differs varies from now on, nodes that only one has stay in their order."""
    children, i, j = [], 0, 0
    for p, q in [*match(a.children, b.children), (len(a.children), len(b.children))]:
        children += a.children[i:p] + b.children[j:q]
        if p < len(a.children):
            children.append((yield merge.each(a.children[p], b.children[q])))
        i, j = p + 1, q + 1
    return Tree(a.label, a.sum if a.sum == b.sum else 0, a.chars + b.chars, a.pages + b.pages, children, a.out)


def trimmed(tree: Tree) -> Tree:
    """The tree without rare nodes, where it has grown beyond NODES."""
    @dom.deep
    def keep(t: Tree, least: int):
        children = []
        for c in t.children:
            if c.pages >= least:
                children.append((yield keep.each(c, least)))
        return Tree(t.label, t.sum, t.chars, t.pages, children, t.out)

    least = 2
    while sum(1 for _ in tree.below()) > NODES and least <= tree.pages:
        tree, least = keep(tree, least), least * 2
    return tree


def varying(tree: Tree, alone: bool, never: tuple[int, ...] = (BY_TAG, BY_WORD)) -> dict[int, int]:
    """By node (id), signs of text at and below it and outside what is left out (never), that varies between pages (alone: all)."""
    out: dict[int, int] = {}
    for t in reversed(list(tree.below())):
        out[id(t)] = 0 if t.out in never else (t.chars if alone or not t.sum else 0) + sum(out[id(c)] for c in t.children)
    return out


@dom.deep
def _articles(tree: Tree, never: tuple[int, ...] = (BY_TAG, BY_WORD)):
    if tree.out in never:
        return []
    tag, *words = tree.label.split(".")
    if tag == "article":
        return [tree]
    inner = []
    for c in tree.children:
        inner += yield _articles.each(c, never)
    return inner or ([tree] if tag == "main" or ARTICLE_WORDS & set(words) else [])


def restored(tree: Tree) -> list[Tree]:
    """The nodes left out by a word that hold the greater part of the varying text; they no longer count as left out."""
    weight = varying(tree, False, (BY_TAG,))
    if tree.pages == 1 or not weight[id(tree)]:
        weight = varying(tree, True, (BY_TAG,))
    out = [t for t in tree.below() if t.out == BY_WORD and 2 * weight[id(t)] > weight[id(tree)]]
    for t in out:
        t.out = 0
    return out


def region(tree: Tree) -> tuple[list[Tree], bool]:
    """The nodes of an aligned tree whose text is the article, and whether constant text inside them is template.

    What the pages themselves name as article or main part is taken whole if it holds text. Otherwise the way goes from the
    root to the child that has three quarters of the varying text, down to where text blocks begin.
    """
    signs = varying(tree, True)
    named = _articles(tree)
    if not any(signs[id(a)] and a.label.split(".")[0] == "article" for a in named):  # an element that holds the article is not left out for a word
        named = max(named, _articles(tree, (BY_TAG,)), key=lambda found: sum(signs[id(a)] for a in found))
    if sum(signs[id(a)] for a in named):
        return named, False
    changing = varying(tree, False)
    alone = tree.pages == 1 or not changing[id(tree)]
    weight = signs if alone else changing
    node = tree
    while node.children:
        best = max(node.children, key=lambda c: weight[id(c)])
        if any(c.label.split(".")[0] in HEADINGS and not c.out for c in node.children) or best.label.split(".")[0] in LEAVES:
            break
        if weight[id(best)] < 0.75 * max(1, weight[id(node)]):
            break
        node = best
    return [node], not alone


def _wraps(node: dom.Node, whole: int) -> bool:
    """Whether an inline element, which no tree holds, has blocks below it and the greater part of a page's text."""
    return node.tag not in dom.BLOCKS and node.tag not in LEFT_OUT and any(True for _ in _blocks_below(node)) and 2 * sum(map(len, dom.texts(node))) > whole


class Wrapper:
    """The article of pages that align with a host's tree."""

    def __init__(self, tree: Tree):
        self.tree = tree
        self.kept = {id(t) for t in restored(tree)}
        self.region, self.drops = region(tree)
        self.places: dict[bytes, tuple] = {}

    def _constant(self, t: Tree) -> bool:
        return self.drops and bool(t.sum) and t.pages >= 3 and 2 * t.pages >= self.tree.pages

    def _find(self, page: Tree) -> tuple[list[int], dict[int, Tree]]:
        """Numbers (in the order of below()) of the page's nodes that align with the region, and template nodes of all that align."""
        number = {id(p): k for k, p in enumerate(page.below())}
        wanted = {id(t) for t in self.region}
        ways: list[int] = []
        pairs: dict[int, Tree] = {}
        ahead = [(self.tree, page)]
        while ahead:
            t, p = ahead.pop()
            pairs[number[id(p)]] = t
            if id(t) in wanted:
                ways.append(number[id(p)])
            ahead += [(t.children[i], p.children[j]) for i, j in match(t.children, p.children)][::-1]
        return ways, pairs

    def text(self, page: dom.Node) -> str:
        tree = tree_of([page])
        shape = tree.shape()
        if shape not in self.places:
            if len(self.places) > 10_000:
                self.places.clear()
            self.places[shape] = self._find(tree)
        ways, pairs = self.places[shape]
        if not ways and tree.pages != self.tree.pages:  # this page has nothing of the region: it is its own template
            return Wrapper(tree).text(page)
        template: set[int] = set()
        roots: list[dom.Node] = []
        below = list(tree.below())
        kept = {id(n) for way, t in pairs.items() if id(t) in self.kept for n in below[way].nodes}
        whole = sum(map(len, dom.texts(page)))
        for way in ways:
            roots += below[way].nodes
        if self.drops:
            for way, t in pairs.items():
                node = below[way]
                if not t.children and self._constant(t) and t.sum == node.sum:
                    template.update(map(id, node.nodes))
        blocks: list[str] = []
        held: list[str] = []

        def flush() -> None:
            if block := " ".join("".join(held).split()):
                blocks.append(block)
            held.clear()

        @dom.deep
        def walk(node: dom.Node, inside: bool):
            block = node.tag in dom.BLOCKS
            if block:
                flush()
            for c in node.children:
                if isinstance(c, str):
                    held.append(c)
                elif c.tag == "br":
                    held.append(" ")
                elif (not left_out(c, inside) or id(c) in kept or _wraps(c, whole)) and id(c) not in template:
                    yield walk.each(c, inside or c.tag == "article")
                elif c.tag in dom.BLOCKS:
                    flush()
            if block:
                flush()

        for root in roots:
            walk(root, root.tag == "article")
            flush()
        return "\n\n".join(blocks)


@lru_cache(maxsize=512)
def wrapper(text: str) -> Wrapper:
    return Wrapper(Tree.load(json.loads(text)))


def _host(url):
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def induce(df: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host and tree (JSON) of every host: all its pages' trees, aligned. Pages without a host or text don't count."""

    def rows(batches):
        for batch in batches:
            trees: dict[str, Tree] = {}
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tree = tree_of([dom.parse(text)])
                trees[host] = merge(trees[host], tree) if host in trees else tree
            yield {"host": list(trees), "tree": [json.dumps(trimmed(t).dump()) for t in trees.values()]}

    pages = df.select(_host(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{html_col}`").alias("html")).where("host is not null and html != ''")
    trees = written(map_batches(pages, rows, "host string, tree string"), "trees")

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for text in sorted(frame["tree"]):
            tree = Tree.load(json.loads(text))
            whole = tree if whole is None else merge(whole, tree)
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "tree": [json.dumps(trimmed(whole).dump())]})

    while (most := trees.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        parts = math.ceil(most / MERGED)
        salted = trees.withColumn("part", F.pmod(F.xxhash64("tree", F.monotonically_increasing_id()), F.lit(parts)))
        trees = written(salted.groupBy("host", "part").applyInPandas(together, "host string, tree string"), "trees")
    return trees


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id_col, url_col, text and n_chars (code points) of every page: its article, blocks joined by an empty line.

    A null or empty page has an empty text. A page whose url is null or has no host is its own template. Repeated rows
    stay; an empty table gives an empty one; other columns are not read.
    """
    trees = induce(df, url_col, html_col)
    pages = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").alias("html"))
    pages = pages.withColumn("host", _host(F.col("url"))).withColumn("part", F.pmod(F.xxhash64("id", "url"), F.lit(SPREAD)))
    spread = trees.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))))

    def rows(batches):
        for batch in batches:
            out = []
            for text, tree in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                page = dom.parse(text or "")
                out.append((wrapper(tree) if tree else Wrapper(tree_of([page]))).text(page) if text else "")
            yield {"id": batch.column(0), "url": batch.column(1), "text": out, "n_chars": [len(t) for t in out]}

    joined = pages.join(spread, ["host", "part"], "left").select("id", "url", "html", "tree")
    out = map_batches(joined, rows, "id bigint, url string, text string, n_chars bigint")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
