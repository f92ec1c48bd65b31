"""Main text of web pages by site style trees.

The pages of one host are laid over each other: elements at the same place of the layout are one style node. A style
node is named by the tags, classes, ids and roles on the way to it (digits as ``#``, repeats of one step as one step);
inline elements are part of their block. For each style node the whole site gives its importance:

* content: a text block on n of the node's m pages has entropy log(n) / log(m), 0 if it is on one page and 1 if on all.
  Content importance is 1 minus the mean entropy of the node's blocks, and that of an inner node counts all blocks
  below it;
* presentation: what a node is made for. Tags such as nav, footer or form, and class words such as menu, sidebar or
  comments have none, wherever they stand; article and main have full weight; nodes whose text is nearly all link text
  have none unless they are inside such a landmark.

Branches of low importance are removed from each page: those without presentation importance, and those with content
importance below ``content`` (below ``landmark`` inside article or main) on sites of at least ``min_pages`` pages with the node, which
are the texts that a site repeats from page to page. Of the latter only those blocks go whose own importance, 1 minus their own entropy,
is below the same bound: what is on one page only, or on few, stays. If a landmark is left, the text is what it holds; else all that is left.

Pages of a host with the same blocks (apart from noise, and from links outside landmarks) are copies and count as one page, so that
copies of a page are not taken for what the site repeats. Sites may be of any size: statistics are counts per (host, node, text hash), combined before they are shuffled, and no task
gathers the pages of a host. The list of low nodes of each host is joined to its pages.

White space within a block (elements and line breaks end a block) becomes one space and blocks are joined by one. NULL, empty and
cut-off html are read as far as they go. Rows without a url, or whose url has no host, belong to no site and are judged by presentation
alone; repeated rows are copies.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize, measure

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Start tags that end an open element of the same group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Start tags that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)

# What layouts are made for: tags and class words without importance, and landmarks of the main text.
NOISE_TAGS = frozenset("nav footer aside form script style noscript iframe button select menu dialog template head svg canvas object audio video map".split())
NOISE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising advertorial banner banners billboard sponsor sponsored promo promos promotion
    nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars rail aside widget widgets
    footer foot colophon copyright masthead topbar toolbar
    cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay paywall
    newsletter subscribe subscription signup login form search
    comment comments commentlist respond reply replies discussion disqus
    share sharing social related recommended recommendations trending pagination pager skip""".split()
)
#: Beside these a word tells the state of a whole layout, as in "has-sidebar".
STATE_WORDS = frozenset("has with without no".split())
LANDMARK_TAGS = frozenset(("article", "main"))
LANDMARK_ROLES = frozenset(("main", "article"))
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")
_LONG = 400


@dataclass(frozen=True)
class Settings:
    min_pages: int = 5
    content: float = 0.3
    landmark: float = 0.1
    links: float = 0.8
    #: So many rows of low nodes are sent to all tasks; more are joined by host.
    broadcast_rows: int = 50_000


@dataclass
class _Element:
    tag: str
    path: str
    noise: bool
    landmark: bool


@dataclass
class Block:
    path: str
    noise: bool
    landmark: bool
    pieces: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def _open(tag: str, attributes: str, parent: _Element) -> _Element:
    values: dict[str, str] = {}
    for name, *given in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        values.setdefault(name.lower(), entities.unescape("".join(given)))
    style = "".join(f".{re.sub(r'[/\d]+', '#', values[k].strip().lower())}" for k in ("class", "id", "role") if values.get(k, "").strip())
    step = f"{tag}{style}"
    path = parent.path if parent.path.rpartition("/")[2] == step else f"{parent.path}/{step}"
    if len(path) > _LONG:  # the name of a deep node: its upper part, and a hash of the whole
        path = f"{path[: _LONG // 2].rpartition('/')[0]}/{hashlib.md5(path.encode()).hexdigest()}"
    role = values.get("role", "").strip().lower()
    words = {w.lower() for k in ("class", "id") for w in _WORD.findall(values.get(k, ""))}
    in_landmark = parent.landmark and not parent.noise
    noisy_words = bool(words & NOISE_WORDS) and not words & STATE_WORDS
    page_header = (tag == "header" or "header" in words) and not in_landmark  # those of articles hold their titles
    landmark = parent.landmark or role in LANDMARK_ROLES or tag in LANDMARK_TAGS and not noisy_words
    noise = (tag in NOISE_TAGS or page_header or role in NOISE_ROLES or noisy_words) and tag not in ("html", "body", "main")
    return _Element(tag, path, parent.noise or noise, landmark)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, each with its style node."""
    root = _Element("", "", False, False)
    stack, out = [root], []
    current: Block | None = None
    links = 0

    def add(text: str) -> None:
        nonlocal current
        if current is None:
            if not text.strip():
                return
            top = stack[-1]
            current = Block(top.path, top.noise, top.landmark)
            out.append(current)
        text = entities.unescape(text) if "&" in text else text
        current.pieces.append(text)
        if links:
            current.linked += len(text)

    at = 0
    while at < len(page):
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        if tag.start() > at:
            add(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:  # a comment or declaration
            continue
        closing = bool(tag[1])
        if name in INLINE:
            links = max(0, links + (-1 if closing else 1)) if name == "a" else links
            continue
        current, links = None, 0
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    del stack[k:]
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            stop = end.start() if end else len(page)
            at = page.find(">", stop) + 1 if end else stop
            at = at or len(page)
            continue
        if name in VOID:
            continue
        if name in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag not in ("li", "dd", "dt"):
                    break
        if name in CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in CLOSES[name]:
                    del stack[k:]
                    break
                if stack[k].tag in ("ul", "ol", "dl", "table", "select"):
                    break
        if not tag[3].rstrip().endswith("/") or name not in ("svg", "path"):
            stack.append(_open(name, tag[3], stack[-1]))
    return out


def _host() -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _content(path: str, text: str) -> int:
    """Hash of a block's text at its style node."""
    return int.from_bytes(hashlib.blake2b(f"{path}\n{text}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def block_statistics(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(host, node, content, n, size, linked, pages)`` of every text at a style node, stored as a table; copies of a page count once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, page in zip(batch["host"], batch["html"]):
                seen: dict[tuple[str, int], list[int]] = {}
                own: list[int] = []
                for block in blocks(page):
                    if block.noise or not (text := block.text):
                        continue
                    content = _content(block.path, text)
                    counts = seen.setdefault((block.path, content), [0, 0])
                    counts[0] += len(text)
                    counts[1] += min(block.linked, len(text))
                    if block.landmark or block.linked <= settings.links * len(text):
                        own.append(content)
                if not seen:
                    continue
                copy = _content("", repr(own or [content for _, content in seen]))
                # One page in `pages` for each node on it: on its first block there.
                met: set[str] = set()
                first = [not (path in met or met.add(path)) for path, _ in seen]
                sizes, linked = zip(*seen.values())
                rows.append((host, copy, [path for path, _ in seen], [content for _, content in seen], sizes, linked, first))
            yield pd.DataFrame(rows, columns=["host", "copy", "node", "content", "size", "linked", "first"])

    schema = "host string, copy long, node array<string>, content array<long>, size array<long>, linked array<long>, first array<boolean>"
    found = pages.select(_host().alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).filter("host <> ''").mapInPandas(run, schema)
    columns = ["node", "content", "size", "linked", "first"]
    distinct = found.groupBy("host", "copy").agg(F.min(F.struct(*columns)).alias("page"))
    spread = distinct.select("host", F.explode(F.arrays_zip(*[F.col(f"page.{c}").alias(c) for c in columns])).alias("b")).select("host", "b.*")
    contents = spread.groupBy("host", "node", "content").agg(
        F.count("*").alias("n"), F.sum("size").alias("size"), F.sum("linked").alias("linked"), F.sum(F.col("first").cast("long")).alias("pages")
    )
    return materialize(contents, "block-contents")


def node_statistics(contents: DataFrame) -> DataFrame:
    """``(host, node, pages, entropy, linked)`` of every style node: pages with it, mean entropy and link share of the blocks at and below it."""
    leaves = contents.groupBy("host", "node").agg(
        F.sum("n").alias("blocks"), F.sum(F.col("n") * F.log("n")).alias("logs"), F.sum("size").alias("size"), F.sum("linked").alias("linked"), F.sum("pages").alias("pages")
    )
    # Inner nodes have the blocks of all nodes below them, and the pages of the most frequent one.
    steps = F.split("node", "/")
    ways = F.transform(F.sequence(F.lit(2), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    totals = leaves.withColumn("node", F.explode(F.when(F.size(steps) > 1, ways).otherwise(F.array("node")))).groupBy("host", "node").agg(
        F.sum("blocks").alias("blocks"), F.sum("logs").alias("logs"), F.sum("size").alias("size"), F.sum("linked").alias("linked"), F.max("pages").alias("pages")
    )
    entropy = F.when(F.col("pages") > 1, F.least(F.lit(1.0), F.col("logs") / F.col("blocks") / F.log("pages"))).otherwise(0.0)
    return totals.select("host", "node", "pages", entropy.alias("entropy"), (F.col("linked") / F.col("size")).alias("linked"))


def low_nodes(pages: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, int]:
    """``(host, node, content, links, repeated, deep)`` of what to remove, and the number of rows.

    Rows with a ``node`` are style nodes whose text is nearly all links, or repeated; those without a ``node``, which have a
    ``content``, are the blocks that are repeated themselves. ``deep`` ones are repeated enough to go inside landmarks too.
    """
    s = settings
    contents = block_statistics(pages, s)

    def marked(entropy: Column) -> list[Column]:
        return [(1 - entropy < s.content).alias("repeated"), (1 - entropy < s.landmark).alias("deep")]

    links = (F.col("linked") > s.links).alias("links")
    nodes = node_statistics(contents).filter(F.col("pages") >= s.min_pages).select("host", "node", F.lit(0).cast("long").alias("content"), links, *marked(F.col("entropy")))
    leaves = contents.groupBy("host", "node").agg(F.sum("pages").alias("of")).filter(F.col("of") >= s.min_pages)
    repeats = contents.filter("n > 1").select("host", "node", "content", "n").join(leaves, ["host", "node"])
    texts = repeats.select("host", F.lit(None).cast("string").alias("node"), "content", F.lit(False).alias("links"), *marked(F.log("n") / F.log("of")))
    table, seen = measure(nodes.unionByName(texts).filter("links or repeated or deep"), "low-nodes", rows=F.count("*"))
    return table, seen["rows"]


Low = dict[str | int, tuple[bool, bool, bool]]


def _removed(block: Block, low: Low) -> bool:
    """True if the node or one above it is to be removed: for its links, or as repeated if the block is repeated as well."""
    if not low:
        return False
    _, repeated, deep = low.get(_content(block.path, block.text), (False, False, False))
    path = block.path
    at = len(path)
    while at > 0:
        node_links, node_repeated, node_deep = low.get(path[:at], (False, False, False))
        if deep and node_deep or not block.landmark and (node_links or repeated and node_repeated):
            return True
        at = path.rfind("/", 0, at)
    return False


def main_text(page: str, low: Low) -> str:
    """Text of the blocks that stay; ``low`` has links, repeated and deep of the nodes and blocks that ``low_nodes`` names."""
    left = [b for b in blocks(page) if not b.noise and not _removed(b, low)]
    if any(b.landmark for b in left):
        left = [b for b in left if b.landmark]
    return " ".join(filter(None, (b.text for b in left)))


def extract(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(page_id, url, text)`` of every row of ``pages``."""
    low, rows = low_nodes(pages, settings)
    per_host = low.groupBy("host").agg(F.collect_list(F.struct("node", "content", "links", "repeated", "deep")).alias("low"))
    if rows <= settings.broadcast_rows:
        per_host = F.broadcast(per_host)
    given = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), _host().alias("host"))
    joined = given.join(per_host, "host", "left").select("page_id", "url", "html", *[F.col(f"low.{c}").alias(c) for c in ("node", "content", "links", "repeated", "deep")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for page, nodes, contents, *marks in zip(*(batch[c] for c in ("html", "node", "content", "links", "repeated", "deep"))):
                names = [] if nodes is None else [int(c) if n is None else n for n, c in zip(nodes, contents)]
                texts.append(main_text(page, dict(zip(names, zip(*marks))) if names else {}))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    out = joined.mapInPandas(run, "page_id string, url string, text string")
    return out.withColumn("page_id", F.col("page_id").cast("long"))
