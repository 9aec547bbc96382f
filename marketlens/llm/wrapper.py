"""Main text of web pages by wrapper induction.

The block trees of a host's pages are aligned with the tree that most of them have, by simple tree matching: two nodes
match if their labels are equal, and the children of matched nodes are matched in order so that most nodes
match. A text that stands in the same node on most pages of a host is template; what varies is content. Marks
on the elements (names of elements, classes, roles) say which varying slots are menus, adverts or comments.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm import html_tree
from marketlens.llm.html_tree import Block, Node
from marketlens.llm.url_filter import host_of

LEAST_PAGES = 3  # different pages that a host must have for a text to be template
TEMPLATE_PERCENT = 50
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE = frozenset("nav header footer aside form menu noscript button select textarea head title iframe object svg canvas video "
                    "audio template dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words of class and id names that mark what is not the article.
MARKS = frozenset("""
ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright
discussion disqus dialog foot footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay
pager pagination popup promo promotion rail recommendations recommended related replies reply respond search share sharing sidebar
signup skip social sponsor sponsored subscribe subscription toast toolbar topbar widget widgets
""".split())
ABOUT = frozenset("has with without no not is".split())  # such names tell of another element
FOREIGN = frozenset("comment comments discussion disqus replies reply respond related recommended recommendations".split())
FLUSH = 1 << 15
_WORD = re.compile(r"[-_:.]+")
_NO_MARKS: frozenset[str] = frozenset()


@functools.lru_cache(maxsize=html_tree.CACHED)
def _marks_of(names: tuple[str, ...]) -> frozenset[str]:
    found = set()
    for name in names:
        parts = _WORD.split(name)
        if parts[0] not in ABOUT:
            found |= {parts[0], parts[-1]}
    return frozenset(found & MARKS)


def _marks(node: Node) -> frozenset[str]:
    return _marks_of(node.names) if node.names else _NO_MARKS


def _is_outside(node: Node) -> bool:
    return node.tag in OUTSIDE or bool(_marks(node)) or bool(node.role) and not ROLES.isdisjoint(node.role.split())


def _is_article(node: Node) -> bool:
    return node.tag == "article" or bool(node.role) and "articlebody" in node.role.split()


def _is_main(node: Node) -> bool:
    return node.tag == "main" or bool(node.role) and "main" in node.role.split()


def _path(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _regions(blocks: list[Block]) -> set[Node]:
    """The outermost articles that hold text and are neither comments nor asides; without one, the main elements."""
    above: dict[Node | None, tuple[bool, Node | None, Node | None]] = {None: (False, None, None)}

    def of(node: Node | None) -> tuple[bool, Node | None, Node | None]:
        """Whether a node is in comments or an aside, its outermost article and main element; worked out once per node."""
        found = above.get(node)
        if found is None:
            aside, article, main = of(node.parent)
            found = (aside or node.tag == "aside" or not _marks(node).isdisjoint(FOREIGN), article or (node if _is_article(node) else None),
                     main or (node if _is_main(node) else None))
            above[node] = found
        return found

    articles, mains = set(), set()
    for block in blocks:
        aside, article, main = of(block.node)
        if not aside:
            articles.add(article)
            mains.add(main)
    articles.discard(None)
    mains.discard(None)
    return articles or mains


def marked(blocks: list[Block]) -> list[tuple[bool, bool]]:
    """For each block: whether its marks let it be main text, and whether it stands in an article or main element.

    Where a page has such elements, only their text is main text.
    """
    regions = _regions(blocks)
    seen: dict[tuple[int, bool], tuple[bool, bool]] = {}
    out = []
    for block in blocks:
        node, heading = block.node, block.node.tag in HEADINGS
        key = id(node), heading
        if key not in seen:
            inside, good = False, True
            for n in _path(node):
                if n in regions:
                    inside = True
                    break
                if n.tag in ("html", "body"):
                    continue
                # The heading of an article may stand in a header of its own.
                if _is_outside(n) and not (heading and n.tag == "header" and regions and any(m in regions for m in _path(n))):
                    good = False
                    break
            seen[key] = good and (inside or not regions), inside and good
        good, inside = seen[key]
        if good and not inside and not heading and node.tag != "p" and block.linked >= len("".join(block.text.split())):
            good = False  # nothing but links: a menu
        out.append((good, inside))
    return out


def _tree(outline: str) -> tuple[list[str], list[list[int]]]:
    labels, children, path = [], [], []
    for line in outline.split("\n"):
        depth, label = line.split(" ", 1)
        del path[int(depth):]
        if path:
            children[path[-1]].append(len(labels))
        path.append(len(labels))
        labels.append(label)
        children.append([])
    return labels, children


def outline_of(root: Node) -> str:
    """The condensed tree as text, a line per node."""
    return "\n".join(f"{depth} {label}" for depth, label in html_tree.condense(root))


class _Prefix:
    """Highest total among places before a given one (a binary indexed tree), with the cell that has it."""

    def __init__(self, n: int):
        self.best = [(0, -1)] * (n + 1)

    def before(self, j: int) -> tuple[int, int]:
        top = (0, -1)
        while j > 0:
            top = max(top, self.best[j], key=lambda x: x[0])
            j -= j & -j
        return top

    def put(self, j: int, total: int, cell: int) -> None:
        j += 1
        while j < len(self.best):
            if total > self.best[j][0]:
                self.best[j] = total, cell
            j += j & -j


@functools.lru_cache(maxsize=512)
def align(wrapper: str, page: str) -> tuple[int, ...]:
    """For each node of a page's outline the node of the wrapper that it matches, or -1: a simple tree matching of most nodes."""
    (labels, kids), (page_labels, page_kids) = _tree(wrapper), _tree(page)
    chosen: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def weight(a: int, b: int) -> int:
        places: dict[str, list[int]] = {}
        for j, child in enumerate(page_kids[b]):
            places.setdefault(page_labels[child], []).append(j)
        best, cells = _Prefix(len(page_kids[b])), []
        for child in kids[a]:
            new = []
            for j in places.get(labels[child], ()):
                total, last = best.before(j)
                new.append((total + weight(child, page_kids[b][j]), child, j, last))
            for cell in new:
                cells.append(cell)
                best.put(cell[2], cell[0], len(cells) - 1)
        total, at = best.before(len(page_kids[b]))
        pairs = []
        while at >= 0:
            _, child, j, last = cells[at]
            pairs.append((child, page_kids[b][j]))
            at = last
        chosen[a, b] = pairs
        return total + 1

    matched = [-1] * len(page_labels)
    weight(0, 0)
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        matched[b] = a
        todo += chosen[a, b]
    return tuple(matched)


def text_key(text: str) -> int:
    """64-bit hash of a text."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[tuple[str, str]] = Counter()

    def given() -> pa.RecordBatch:
        keys = list(counts)
        out = pa.RecordBatch.from_arrays([pa.array([h for h, _ in keys], pa.string()), pa.array([o for _, o in keys], pa.string()),
                                          pa.array([counts[k] for k in keys], pa.int64())], names=["host", "outline", "n"])
        counts.clear()
        return out

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts[host, outline_of(html_tree.read(page.as_py())[0])] += 1
            if len(counts) >= FLUSH:
                yield given()
    yield given()


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, node, text, page: the texts in nodes of the wrapper; ``page`` stands for all texts that may be main text, so that
    copies of an article count once, whatever menus and adverts are around it."""
    schema = pa.schema([("host", pa.string()), ("node", pa.int32()), ("text", pa.int64()), ("page", pa.int64())])
    for batch in batches:
        found: set[tuple[str, int, int, int]] = set()
        for host, page, wrapper in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            root, blocks = html_tree.read(page.as_py())
            if not blocks:
                continue
            matched = align(wrapper, outline_of(root))
            keys = [text_key(b.text) for b in blocks]
            content = text_key("\n".join(b.text for b, (good, _) in zip(blocks, marked(blocks)) if good))
            found.add((host, -1, 0, content))
            found.update((host, matched[b.node.number], k, content) for b, k in zip(blocks, keys) if matched[b.node.number] >= 0)
            if len(found) >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
                found = set()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)


def induce(pages: DataFrame) -> DataFrame:
    """Wrapper of each host from columns host, html: host, outline, template (nodes with the texts that most pages have there).

    The outline is that of most pages of the host (of those as frequent the shortest, then the greatest). Pages whose possible main
    text is the same are copies and count once. Hosts of fewer than ``LEAST_PAGES`` pages have no wrapper.
    """
    counts = pages.mapInArrow(_outlines, "host string, outline string, n long").groupBy("host", "outline").agg(F.sum("n").alias("n"))
    best = F.max_by("outline", F.struct("n", -F.length("outline"), "outline")).alias("outline")
    wrappers = counts.groupBy("host").agg(best, F.sum("n").alias("n")).where(F.col("n") >= LEAST_PAGES).select("host", "outline")
    path = session.scratch(pages.sparkSession, "wrappers")
    wrappers.write.parquet(os.path.join(path, "outlines"))
    wrappers = pages.sparkSession.read.parquet(os.path.join(path, "outlines"))
    slots = (pages.join(wrappers, "host").select("host", "html", "outline")
             .mapInArrow(_slots, "host string, node int, text long, page long").distinct())
    per = slots.groupBy("host", "node", "text").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES * TEMPLATE_PERCENT / 100)
    per.write.parquet(os.path.join(path, "slots"))
    per = pages.sparkSession.read.parquet(os.path.join(path, "slots"))
    total = per.where("node = -1").select("host", F.col("n").alias("total")).where(F.col("total") >= LEAST_PAGES)
    constant = (per.where("node >= 0").join(total, "host").where(F.col("n") * 100 >= F.col("total") * TEMPLATE_PERCENT)
                .groupBy("host").agg(F.collect_list(F.struct("node", "text")).alias("template")))
    # Written, so that the planner knows the size and can spare the pages a shuffle.
    wrappers.join(constant, "host", "left").write.parquet(os.path.join(path, "wrappers"))
    return pages.sparkSession.read.parquet(os.path.join(path, "wrappers"))


def main_text(page: str, wrapper: str | None, template: frozenset[tuple[int, int]]) -> str:
    """The content of one page: what its marks allow and the wrapper of its host does not know as template."""
    root, blocks = html_tree.read(page)
    matched = align(wrapper, outline_of(root)) if wrapper and template else None
    kept = []
    for block, (good, inside) in zip(blocks, marked(blocks)):
        # Copies of one article on a host are no template: inside an article the marks alone decide.
        constant = matched is not None and not inside and (matched[block.node.number], text_key(block.text)) in template
        if good and not constant:
            kept.append(block.text)
    return "\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, frozenset[tuple[int, int]]] = {}
    for batch in batches:
        texts = []
        for host, page, wrapper, template in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4).to_pylist(),
                                                 batch.column(5)):
            if host not in known:
                if len(known) >= FLUSH:
                    known.clear()
                known[host] = frozenset((e["node"], e["text"]) for e in template.as_py() or ())
            texts.append(main_text(page.as_py(), wrapper, known[host]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The main text of each page: page_id, url, text, n_chars.

    Character references are decoded, white space in a block becomes one space (a line break too), blocks are joined by a line feed in
    page order. Text in menus, headers (but an article's own heading), footers, sidebars, notices, adverts, forms, scripts, styles and comments
    goes, and all outside the article where the page has one. Null and empty pages have an empty text; pages whose URL has
    no host share one; every row is a page, null ids are kept, repeated rows stay; other columns are left out.
    """
    spark = pages.sparkSession
    session.ship(spark)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        host_of(F.col(url).cast("string")).alias("host"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    wrappers = induce(rows.select("host", "html"))
    return (rows.join(wrappers, "host", "left").select("page_id", "url", "host", "html", "outline", "template")
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long"))
