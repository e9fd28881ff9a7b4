"""Main-text extraction by wrapper induction (operator 7).

Pages of one host share a template. Each page's block-level DOM is reduced to a
skeleton tree (runs of alike siblings become one repeated node) with a hash of
the text that stands directly in every node.

1. Pages are grouped by host and layout (their skeleton's upper levels). A group's
   reference tree is the skeleton of one page (the smallest hash of URL and text).
2. Every page's skeleton is aligned to its group's reference by simple tree
   matching, and the pages are counted for every reference node and every text
   block that stands directly in it. A block that the same node has on ``SHARE`` of
   the group's pages, and on at least ``MIN_PAGES``, is part of the template; what
   varies is content. So a page that words its notice in its own way changes
   nothing for the others, and a constant paragraph among varying ones is found.
3. Every page is aligned to its group's wrapper again. Its text is taken from the
   content region: the ``article`` or ``main`` element with the most text, and
   without one the whole body; elements that are page furniture by their tag or
   class are left out (a class word does not count where the element holds a
   ``main`` element or most of the page's text), and so are template blocks. A page
   whose region would lose all its text as template (copies of one page) keeps it.

Statistics cover all pages; only skeletons and hashes take part in steps 1 and
2. Step 3 shuffles each page once to meet its group's wrapper; a hot group's side
of that join is split by the adaptive skew join. Trees are walked with explicit
stacks, so a page may be nested to any depth.

Defined results: null or empty html gives empty text; pages without a host are
aligned with each other like those of one host; null and repeated page_ids and
urls give a row per input row; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import html as html_lib
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.llm.url_filter import host_of
from quillfeed.session import cut_lineage

MIN_PAGES = 3  # a block must be the same on this many pages of a group to count as template
SHARE = 0.9  # and on this share of them
LAYOUT_DEPTH = 3  # levels of a skeleton that make its layout: html, body, and what stands in them
SLICE = 500  # pages that a task hands back at once
TEXT_SCHEMA = "page_id long, url string, text string, n_chars long"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noframes noembed xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table"
    " caption tbody td tfoot th thead tr ul".split())
#: Elements that never hold main text.
FURNITURE = frozenset(
    "aside button dialog embed footer form head iframe input menu nav noembed noframes noscript object option script"
    " search select style svg template textarea title".split())
#: Words of class, id and role values that name page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment comments commentlist"
    " consent cookie cookies dfp disclaimer disqus footer gdpr hidden masthead menu modal nav navbar navigation"
    " newsletter notice notification notifications pager pagination popup promo promoted promotion recommended related"
    " replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar widget"
    " widgets".split())
#: What follows one of these in a name says something about an element, not what it is (no-sidebar).
ABOUT_WORDS = frozenset(["no", "has", "with", "without"])
#: Class words that stay furniture however much text they hold: readers' comments and layers over the page.
NEVER_TEXT = frozenset(
    "comment comments commentlist consent cookie cookies disqus gdpr hidden modal popup replies respond".split())
HEADER_WORDS = frozenset(["header", "topbar"])  # furniture outside the content region
P_CLOSERS = BLOCKS - {"body", "html", "head", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
CLOSED_BY = {  # an open element of the key ends where one of these begins
    "p": P_CLOSERS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "thead", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "th": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "option": {"option", "optgroup"}, "head": {"body"},
}
SCOPES = frozenset("article aside body button div fieldset footer form header html main nav section table td th ul ol dl".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Page:
    """Block-level elements in page order (tag, parent, class words) and the
    text blocks (element, text) between their boundaries."""

    def __init__(self, source: str):
        self.tags, self.parents, self.words = ["#root"], [-1], [frozenset()]
        self.blocks: list[tuple[int, str]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#root", 0)]  # (tag, nearest kept element)
        text: list[str] = []
        at, n = 0, len(source)

        def flush():
            if text:
                joined = " ".join(html_lib.unescape("".join(text)).split())
                if joined:
                    self.blocks.append((stack[-1][1], joined))
                text.clear()

        while at < n:
            found = _TOKEN.search(source, at)
            if found is None:
                text.append(source[at:])
                break
            if found.start() > at:
                text.append(source[at:found.start()])
            at = found.end()
            close, tag = found.group(1), found.group(2)
            if close:
                close = close.lower()
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == close:
                        if close in BLOCKS or any(t in BLOCKS or t in FURNITURE for t, _ in stack[depth:]):
                            flush()
                        del stack[depth:]
                        break
                    if close not in BLOCKS and stack[depth][0] in SCOPES:
                        break  # a stray inline end tag closes nothing beyond its block
                continue
            if not tag:
                continue
            tag = tag.lower()
            if tag in BLOCKS:
                flush()
                for depth in range(len(stack) - 1, 0, -1):
                    open_tag = stack[depth][0]
                    if tag in CLOSED_BY.get(open_tag, ()):
                        del stack[depth:]
                        break
                    if open_tag in SCOPES and open_tag != "td" and open_tag != "th":
                        break
            elif tag == "br":
                text.append(" ")
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else n
                continue
            attributes = found.group(3)
            words = _class_words(attributes) if attributes else frozenset()
            if tag in VOID or (attributes and attributes.endswith("/") and tag not in BLOCKS):
                continue
            if tag in BLOCKS or tag in FURNITURE or words:
                if tag not in BLOCKS and (tag in FURNITURE or words & FURNITURE_WORDS):
                    flush()
                self.tags.append(tag)
                self.parents.append(stack[-1][1])
                self.words.append(words)
                stack.append((tag, len(self.tags) - 1))
            else:
                stack.append((tag, stack[-1][1]))
        flush()

    def children(self) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in self.tags]
        for i in range(1, len(self.tags)):
            out[self.parents[i]].append(i)
        return out


def _class_words(attributes: str) -> frozenset:
    words = set()
    for m in _ATTR.finditer(attributes):
        name = m.group(1).lower()
        value = next((g for g in m.groups()[1:] if g is not None), "")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            words.add("hidden")
        elif name == "role":
            words.add({"complementary": "sidebar", "contentinfo": "footer", "banner": "banner"}.get(value.lower(), value.lower()))
        elif name in ("class", "id"):
            for name_words in ([w.lower() for w in _WORDS.findall(v) if not w.isdigit()] for v in value.split()):
                cut = next((k for k, w in enumerate(name_words) if w in ABOUT_WORDS), len(name_words))
                words.update(name_words[:cut])
                if cut < len(name_words):
                    words.add("-".join(name_words[cut:]))
    return frozenset(words)


# -- skeletons ---------------------------------------------------------------
Tree = tuple[list[str], list[int]]  # signature and parent of every node, in preorder


def skeleton(page: Page) -> tuple[Tree, list[int]]:
    """The page's tree and the skeleton node of each element. Alike neighbouring
    siblings share a node."""
    children = page.children()
    node_of = [0] * len(page.tags)
    signs: list[str] = []
    parents: list[int] = []
    todo: list[tuple[list[int], int]] = [([0], -1)]
    while todo:
        members, parent = todo.pop()
        number = len(signs)
        signs.append(" ".join([page.tags[members[0]], *sorted(page.words[members[0]])]))
        parents.append(parent)
        runs: list[tuple[str, list[int]]] = []
        for m in members:
            node_of[m] = number
            for c in children[m]:
                sign = " ".join([page.tags[c], *sorted(page.words[c])])
                if runs and runs[-1][0] == sign:
                    runs[-1][1].append(c)
                else:
                    runs.append((sign, [c]))
        todo.extend((run, number) for _, run in reversed(runs))
    return (signs, parents), node_of


def shape(tree: Tree) -> str:
    return json.dumps(tree, ensure_ascii=False, separators=(",", ":"))


def layout(tree: Tree, levels: int = LAYOUT_DEPTH) -> int:
    """Signed 64-bit hash of the tree's upper levels."""
    signs, parents = tree
    depth = [0] * len(signs)
    upper = []
    for i in range(1, len(signs)):
        depth[i] = depth[parents[i]] + 1
        if depth[i] <= levels:
            upper.append(f"{depth[i]} {signs[i]}")
    return xxhash.xxh3_64_intdigest("\n".join(upper).encode("utf-8", "surrogatepass")) - (1 << 63)


def simple_tree_matching(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Largest top-down, order-keeping alignment of two trees: pairs of nodes with
    equal signatures."""
    kids: list[list[list[int]]] = []
    for signs, parents in (a, b):
        below: list[list[int]] = [[] for _ in signs]
        for i in range(1, len(signs)):
            below[parents[i]].append(i)
        kids.append(below)
    if a[0][0] != b[0][0]:
        return []
    # Pairs that can be aligned, each after the pair of its parents.
    order = [(0, 0)]
    for x, y in order:
        order.extend((c, d) for c in kids[0][x] for d in kids[1][y] if a[0][c] == b[0][d])
    weight: dict[tuple[int, int], int] = {}

    def table(x: int, y: int) -> list[list[int]]:
        xs, ys = kids[0][x], kids[1][y]
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, c in enumerate(xs):
            for j, d in enumerate(ys):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight.get((c, d), 0))
        return best

    for x, y in reversed(order):
        weight[x, y] = 1 + table(x, y)[-1][-1]
    pairs: list[tuple[int, int]] = []
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        best = table(x, y)
        xs, ys = kids[0][x], kids[1][y]
        i, j = len(xs), len(ys)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                todo.append((xs[i - 1], ys[j - 1]))
                i, j = i - 1, j - 1
    return sorted(pairs)


class Aligner:
    """Cached alignments of skeletons to a reference; pages of a host repeat few shapes."""

    def __init__(self, limit: int = 4096):
        self.cache: dict[tuple[str, str], dict[int, int]] = {}
        self.limit = limit

    def __call__(self, mine: str, reference: str) -> dict[int, int]:
        found = self.cache.get((mine, reference))
        if found is None:
            if len(self.cache) >= self.limit:
                self.cache.clear()
            a = json.loads(mine)
            pairs = simple_tree_matching(a, json.loads(reference)) if mine != reference else ((i, i) for i in range(len(a[0])))
            found = self.cache[mine, reference] = dict(pairs)
        return found


def block_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


# -- one page's text -----------------------------------------------------------
def main_blocks(page: Page, node_of: list[int] | None = None, template: frozenset = frozenset()) -> list[str]:
    """The content region's blocks; ``template`` has the blocks to leave out, as
    (skeleton node, hash of the text)."""
    n = len(page.tags)
    parents, tags, words = page.parents, page.tags, page.words
    region = [False] * n
    for i in range(1, n):
        region[i] = region[parents[i]] or tags[i] in ("article", "main") or "main" in words[i] and "role" in words[i]

    def content(text_of: frozenset) -> list[tuple[int, str]]:
        """The region's blocks; elements in ``text_of`` are no furniture by class."""
        out = [False] * n  # page furniture
        for i in range(1, n):
            top = tags[i] in ("article", "main", "body", "html") or i in text_of
            out[i] = (out[parents[i]] or tags[i] in FURNITURE or (not top and bool(words[i] & FURNITURE_WORDS))
                      or (not region[i] and not top and (tags[i] == "header" or bool(words[i] & HEADER_WORDS))))
        below, seen, order = [0] * n, [False] * n, []  # text below each element; regions as their text comes
        for element, text in page.blocks:
            if not out[element]:
                below[element] += len(text)
                at = element
                while at > 0 and not seen[at]:
                    seen[at] = True
                    if tags[at] in ("article", "main"):
                        order.append(at)
                    at = parents[at]
        for i in range(n - 1, 0, -1):
            below[parents[i]] += below[i]
        size = {i: below[i] for i in order}
        root = 0
        if size:
            # The innermost region that has the most text (an article inside main, not a teaser beside it).
            most = max(size.values())
            root = max((e for e, s in size.items() if 2 * s > most and tags[e] == "article"), key=lambda e: size[e], default=None) \
                or max(size, key=lambda e: (size[e], e))
        inside = [i == root for i in range(n)]
        for i in range(1, n):
            inside[i] = inside[i] or inside[parents[i]]
        return [(e, t) for e, t in page.blocks if inside[e] and not out[e]]

    blocks = content(frozenset())
    # An element named like furniture that holds a main element or most of the page's text is none.
    named = [i for i in range(1, n) if words[i] & (FURNITURE_WORDS | HEADER_WORDS) and not words[i] & NEVER_TEXT
             and tags[i] not in FURNITURE and tags[i] != "header"]
    if named:
        never = [False] * n
        for i in range(1, n):
            never[i] = never[parents[i]] or tags[i] in FURNITURE or bool(words[i] & NEVER_TEXT)
        held = [0] * n
        for element, text in page.blocks:
            if not never[element]:
                held[element] += len(text)
        for i in range(n - 1, 0, -1):
            held[parents[i]] += held[i]
        around = set()  # of a main element, whatever its share
        for i in (i for i in range(1, n) if tags[i] == "main" and not never[i]):
            while i > 0 and i not in around:
                around.add(i)
                i = parents[i]
        wide = frozenset(i for i in named if i in around or 2 * held[i] > held[0])
        if wide:
            blocks = content(wide) or blocks
    if template and node_of is not None:
        kept = [(e, t) for e, t in blocks if (node_of[e], block_hash(t)) not in template]
        blocks = kept or blocks
    return [t for _, t in blocks]


def extract_page(source: str | None, reference: str | None = None, template: frozenset = frozenset(),
                 align: Aligner | None = None) -> str:
    """Main text of one page, given its group's wrapper (reference shape and the
    template blocks as (reference node, hash of the text))."""
    if not source:
        return ""
    page = Page(source)
    if not reference or not template:
        return "\n\n".join(main_blocks(page))
    tree, node_of = skeleton(page)
    to_reference = (align or Aligner())(shape(tree), reference)
    by_node: dict[int, list[int]] = {}
    for node, found in template:
        by_node.setdefault(node, []).append(found)
    constant = frozenset((mine, h) for mine, theirs in to_reference.items() for h in by_node.get(theirs, ()))
    return "\n\n".join(main_blocks(page, node_of, constant))


# -- the job ---------------------------------------------------------------------
def with_layout(pages: DataFrame) -> DataFrame:
    """page_id, url and html with the host and the layout of the page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                found = [layout(skeleton(Page(h.as_py() or ""))[0]) for h in part.column("html")]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.int64())], names=[*part.schema.names, "layout"])

    return rows.mapInArrow(run, "page_id long, url string, html string, host string, layout long")


def induce_wrappers(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """host, layout, reference (shape) and template: the reference's nodes and the
    hashes of the blocks that stand in them on ``share`` of the group's pages, and
    on at least ``min_pages``."""

    def outline(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for host, first, source in zip(frame["host"], frame["first"], frame["html"]):
                page = Page(source or "")
                tree, node_of = skeleton(page)
                blocks = sorted({(node_of[e], block_hash(t)) for e, t in page.blocks})
                rows.append((host, layout(tree), first, shape(tree), [n for n, _ in blocks], [h for _, h in blocks]))
            yield pd.DataFrame(rows, columns=["host", "layout", "first", "shape", "nodes", "hashes"])

    keyed = pages.select(host_of(F.col("url")).alias("host"), F.xxhash64("url", "html").alias("first"), "html")
    outlines = cut_lineage(keyed.mapInPandas(
        outline, "host string, layout long, first long, shape string, nodes array<int>, hashes array<long>"))
    group = ["host", "layout"]
    reference = outlines.groupBy(*group).agg(F.min(F.struct("first", "shape")).alias("r"), F.count(F.lit(1)).alias("pages"))
    reference = cut_lineage(reference.where(F.col("pages") >= min_pages).select(*group, F.col("r.shape").alias("reference"), "pages"))

    def aligned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        align = Aligner()
        for frame in frames:
            rows = []
            for host, kind, mine, nodes, hashes, ref in zip(*(frame[c] for c in (*group, "shape", "nodes", "hashes", "reference"))):
                to = align(mine, ref)
                rows.extend({(host, kind, to[n], h) for n, h in zip(nodes, hashes) if n in to})
            yield pd.DataFrame(rows, columns=[*group, "node", "hash"])

    seen = outlines.join(reference.drop("pages"), group).mapInPandas(aligned, "host string, layout long, node int, hash long")
    blocks = seen.groupBy(*group, "node", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    blocks = blocks.join(reference.select(*group, "pages"), group).where(F.col("n") >= F.col("pages") * share)
    # No longer than a page's blocks over the share.
    template = blocks.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("node", "hash"))).alias("template"))
    return reference.drop("pages").join(template, group)


def extract_main_text(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url, text and n_chars for each row of ``pages`` (page_id, url, html)."""
    wrappers = cut_lineage(induce_wrappers(pages, min_pages, share)).withColumnsRenamed({"host": "__host", "layout": "__layout"})
    mine = with_layout(pages)
    joined = mine.join(wrappers, (F.col("host") == F.col("__host")) & (F.col("layout") == F.col("__layout")), "left").select(
        "page_id", "url", "html", "reference", F.col("template.node").alias("nodes"), F.col("template.hash").alias("hashes"))

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        align = Aligner()
        for frame in frames:
            texts = [extract_page(h, r, frozenset(zip(n, x)) if n is not None else frozenset(), align)
                     for h, r, n, x in zip(frame["html"], frame["reference"], frame["nodes"], frame["hashes"])]
            yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    return joined.mapInPandas(extract, TEXT_SCHEMA)
