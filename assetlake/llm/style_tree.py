"""Main text of web pages by a site style tree.

All pages of a host are merged into one tree: a node is a path of elements with their classes.
For each node with text the importance of its content is the entropy of its texts over the
host's pages (0 if every page shows the same, 1 if none repeats), lessened by the share of link
text; the importance of its presentation is the entropy of the child elements its parent shows.
Branches in which both are below ``threshold`` are noise and leave every page of the host, also
those inside an article.  A site may publish one article, or a whole page, many times: an article
counts once in the nodes below it, and equal pages count once in the others.  A node that fewer than
``min_pages`` such pages show tells nothing and is kept.

After the tree comes a check of what the markup itself says: elements whose very kind is not the
article (menus, footers, scripts, adverts by class, reader comments ...) leave too, since a site may
show other ones on each page, and where there is an article or main element the rest leaves.

Only hashes of texts are gathered, per host and node, by partial counts; the noisy nodes go back
to the pages by a broadcast if they are at most BROADCAST_ROWS (checked by a count), else by a join.

Edge cases: a null or empty page has an empty text; broken markup (unclosed or stray tags, cut
pages) is read as browsers do; a page without any text is empty; equal pages give equal texts; a
null url is a host of its own; rows repeated under one page_id are each returned.  Other columns
are ignored.
"""

from __future__ import annotations

import html
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored

from .words import blocks

BROADCAST_ROWS = 200_000
# Fixed values of HTML: elements without content, of raw text, and those that make blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Kinds of elements, and words in class, id and role, that are never the article.
NOISE = frozenset(
    "head script style noscript template iframe nav footer aside form button select textarea input svg canvas object dialog menu".split()
)
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice notification popup modal "
    "newsletter subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments disqus share "
    "sharing social related recommended widget pagination pager toolbar login signup search complementary contentinfo alert".split()
)
HEADER_WORDS = frozenset("header masthead topbar".split())
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
TOKEN = regex.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(>|\Z)|</[^>]*(?:>|\Z)", regex.DOTALL)
NAMED = regex.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", regex.IGNORECASE)
CUT = regex.compile(r"[\s_\-]+")


class Block:
    """A piece of text between block borders."""

    __slots__ = ("path", "noise", "article", "main", "parts", "links")

    def __init__(self, path: str, noise: bool, article: bool, main: bool):
        self.path, self.noise, self.article, self.main = path, noise, article, main
        self.parts: list[str] = []
        self.links = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def _noise(tag: str, words: set[str], in_article: bool) -> bool:
    if tag in NOISE or words & NOISE_WORDS:
        return True
    return not in_article and (tag == "header" or bool(words & HEADER_WORDS))


def read_page(page: str | None) -> tuple[list[Block], dict[str, list[str]]]:
    """The blocks of a page in order, and the child elements shown below each path."""
    found: list[Block] = []
    children: dict[str, list[str]] = {}
    stack: list[tuple] = [("", "", False, False, False, False)]  # tag, path, noise, article, main, link
    block: Block | None = None
    page = page or ""
    at = 0

    def add(text: str) -> None:
        nonlocal block
        if text:
            top = stack[-1]
            if block is None:
                _, path, noise, article, main, _ = top
                block = Block(path, noise, article, main)
                found.append(block)
            if block.noise == top[2]:
                block.parts.append(text)
                if top[5]:
                    block.links += len(text)

    while at < len(page):
        match = TOKEN.search(page, at)
        add(page[at : match.start()] if match else page[at:])
        if not match:
            break
        at = match.end()
        closing, tag, attributes = match[1], (match[2] or "").lower(), match[3]
        if not tag or not match[4]:  # comments, declarations, a tag cut off by the end of the page
            continue
        if closing:
            if any(e[0] == tag for e in stack):
                while stack.pop()[0] != tag:
                    pass
            if tag in BLOCKS:
                block = None
            elif block is not None and block.noise != stack[-1][2]:
                block = None
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            block = None
            _close(stack, tag)
        parent = stack[-1]
        words = {w.lower() for m in NAMED.finditer(attributes) for w in CUT.split(m[1] or m[2] or m[3] or "")} if attributes else set()
        in_article = parent[3] or tag == "article"
        noise = parent[2] or _noise(tag, words, in_article)
        name = tag + "".join(f".{w}" for w in sorted(words))
        children.setdefault(parent[1], []).append(name)
        if tag in RAW:
            end = regex.compile(rf"</{tag}\s*[^>]*>", regex.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        path = f"{parent[1]}/{name}" if tag in BLOCKS or not parent[1] or noise != parent[2] else parent[1]
        if noise != parent[2]:
            block = None
        stack.append((tag, path, noise, in_article, parent[4] or tag == "main", parent[5] or tag == "a"))
    return found, children


def _close(stack: list[tuple], tag: str) -> None:
    """Ends the elements that a new block implicitly ends: an open paragraph, a list item by the next one."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] == "p":
            del stack[i:]
            break
        if stack[i][0] in BLOCKS:
            break
    if tag in CLOSED_BY and stack[-1][0] in CLOSED_BY[tag]:
        stack.pop()


def main_text(page: str | None, noisy: frozenset[int] | set[int] = frozenset()) -> str:
    """The article of a page, without the branches whose nodes are in ``noisy``."""
    kept = [b for b in _article(read_page(page)[0]) if node_key(b.path) not in noisy]
    return "\n".join(t for t in (b.text() for b in kept) if t)


def _article(found: list[Block]) -> list[Block]:
    """The blocks that the markup allows: those of an article, else of a main element, else all that are no noise."""
    allowed = [b for b in found if not b.noise]
    return [b for b in allowed if b.article] or [b for b in allowed if b.main] or allowed


def node_key(path: str) -> int:
    return xxhash.xxh3_64_intdigest(path.encode("utf-8", "surrogatepass")) - (1 << 63)


def style_tree(pages: DataFrame, host: str = "host") -> DataFrame:
    """host, node, pages, content and presentation (importances) of every node with text."""

    def rows_of(name: str | None, html: str | None) -> Iterator[tuple]:
        found, children = read_page(html)
        said = [(b, b.text()) for b in found]
        marked = {id(b) for b in _article(found) if b.article or b.main}
        whole = node_key(html or "")
        article = node_key("\n".join(text for b, text in said if id(b) in marked))
        texts: dict[tuple[int, int], list[int]] = {}  # a text counts once on a page
        shown_by: dict[int, int] = {}  # node or parent: the article or page that shows it
        for b, text in said:
            if text:
                node, parent, page = node_key(b.path), node_key(b.path.rpartition("/")[0]), article if id(b) in marked else whole
                seen = texts.setdefault((node, node_key(text)), [parent, 0, len(text)])
                seen[1] = max(seen[1], b.links)
                shown_by.setdefault(node, page)
                if page == article:
                    shown_by[parent] = page
                shown_by.setdefault(parent, page)
        parents = {v[0] for v in texts.values()}
        for (node, text), (parent, links, chars) in texts.items():
            yield name, node, parent, 0, text, shown_by[node], links, chars
        for path, names in children.items():
            if (node := node_key(path)) in parents:
                yield name, node, 0, 1, node_key(" ".join(names)), shown_by[node], 0, 0

    def shown(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "html"):
            rows = [r for page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for r in rows_of(*page)]
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "host string, node long, parent long, kind int, shown long, page long, links long, chars long"
    names = [c.split()[0] for c in schema.split(", ")]
    seen = pages.select(F.col(host).alias("host"), "html").mapInArrow(shown, schema)
    once = seen.groupBy("host", "node", "kind", "shown", "page").agg(
        F.max("parent").alias("parent"), F.max("links").alias("links"), F.max("chars").alias("chars")
    )
    once = stored(once, "shown")
    showing = once.select("host", "node", "kind", "page").distinct().groupBy("host", "node", "kind").agg(F.count(F.lit(1)).alias("pages"))
    counts = once.groupBy("host", "node", "kind", "shown").agg(
        F.count(F.lit(1)).alias("n"), F.max("parent").alias("parent"), F.sum("links").alias("links"), F.sum("chars").alias("chars")
    )
    total = F.sum("n")
    entropy = F.when(total <= 1, 1.0).otherwise(1 - F.sum(F.col("n") * F.log2("n")) / total / F.log2(total))
    nodes = counts.groupBy("host", "node", "kind").agg(
        F.max("parent").alias("parent"),
        (entropy * (1 - F.coalesce(F.try_divide(F.sum("links"), F.sum("chars")), F.lit(0.0)))).alias("importance"),
    )
    same = nodes["host"].eqNullSafe(showing["host"]) & (nodes["node"] == showing["node"]) & (nodes["kind"] == showing["kind"])
    nodes = stored(nodes.join(showing, same).select(*[nodes[c] for c in nodes.columns], "pages"), "style_tree")
    style = nodes.where("kind = 1").select("host", F.col("node").alias("parent"), F.col("importance").alias("presentation"))
    content = nodes.where("kind = 0").select("host", "node", "parent", "pages", F.col("importance").alias("content"))
    same = content["host"].eqNullSafe(style["host"]) & (content["parent"] == style["parent"])
    return content.join(style, same, "left").select(
        content["host"], "node", "pages", "content", F.coalesce("presentation", F.lit(0.0)).alias("presentation")
    )


def extract(pages: DataFrame, threshold: float = 0.3, min_pages: int = 4) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    tree = style_tree(rows)
    noisy = tree.where((F.col("pages") >= min_pages) & (F.col("content") < threshold) & (F.col("presentation") < threshold))
    noisy = stored(noisy.groupBy("host").agg(F.collect_set("node").alias("noisy")), "noisy")  # nodes of one site's templates
    few = (noisy.agg(F.sum(F.size("noisy"))).first()[0] or 0) <= BROADCAST_ROWS
    noisy = noisy.withColumnRenamed("host", "site")
    rows = rows.join(F.broadcast(noisy) if few else noisy, rows["host"].eqNullSafe(noisy["site"]), "left")

    def text_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "html"):
            texts = [main_text(h, set(n or ())) for h, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            lengths = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "noisy").mapInArrow(text_of, "page_id long, url string, text string, n_chars long")
