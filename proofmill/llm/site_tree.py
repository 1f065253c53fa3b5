"""Main text of web pages with a site style tree.

Every page is parsed once into text blocks and nodes. A node is known by its path of tags and class or id names
(digits folded), so the DOMs of one host merge into one tree. For each node of the tree the entropy of its presentation
(the tags of its children) and of its content (its text), over the host's different pages and scaled to 0..1, make its
importance: what looks and reads the same on every page is low, what differs is high.

A branch of a page is removed if
* its tag or names mark it as menu, header, footer, sidebar, notice, advert, form, script, style or comments (importance 0), or
* it lies outside the article where the page has one, or
* the importance of its node is below ``LOW``. Importance is weighed by evidence: a node counts as ``PRIOR`` pages of full importance
  besides those it was seen on, so what is the same everywhere sinks smoothly with the number of pages (1/3 on two, 1/6 on five). Plain text nodes
  (paragraphs, headings, list items, cells) are not removed as nodes: all of a page's paragraphs share one. Outside an article their texts
  are leaves of the tree, each with an importance of its own: the share of the node's pages that lack the text, weighed in the same way.
  Inside the article texts go with a marked or low branch only: a heading or sentence that all articles of a host share stays.

Pages of one host with the same text count once, so copies of a page do not make its article look like boilerplate.

Scale. Pages are parsed in one pass; nodes give one row per page and node (no text). Counts per (host, node, value)
combine before the shuffle, so a host with a third of all pages is no heavy task. Low nodes come back to the pages by a join
on the host: Spark broadcasts them if they are small and splits the large host otherwise.

Defined results. Null or empty html gives an empty text. Repeated rows get a row each; null ids and urls stay null (pages
without a host share the host null). An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmill.llm.common import sliced
from proofmill.session import ship_code, stored

LOW = 0.2
#: Pages of full importance that every node and leaf counts besides those seen.
PRIOR = 1
#: Weight of presentation beside content in a node's importance.
PRESENTATION = 0.25

# HTML elements by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BREAKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
PLAIN = set("p h1 h2 h3 h4 h5 h6 li dd dt td th pre blockquote figcaption caption b i em strong a span u s small code br ul ol dl table tbody tr".split())
NEVER = set("head script style template noscript iframe svg canvas object nav footer aside form button select textarea input option dialog menu search title".split())
CONTENT = {"article", "main"}
#: Element and class or id names that mark what is no article text.
MARKED = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager "
    "sidebar aside widget footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login "
    "comment comments commentlist disqus replies respond share sharing social related recommended search skip copyright disclaimer".split()
)
#: Marks only outside the article, where it may hold the title.
OUTER = {"header"}
#: Elements that a new element of the given kind closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)|([^\s=/>"']+)""", re.S)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("content", "kept", "key", "kids", "learned", "tag", "text")

    def __init__(self, tag: str, key: int, kept: bool, content: bool, learned: tuple[int, ...]) -> None:
        self.tag, self.key, self.kept, self.content, self.learned = tag, key, kept, content, learned
        self.kids: list[str] = []
        self.text: list[str] = []


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        out.setdefault((m[1] or m[3]).lower(), (m[2] or "").strip("\"'"))
    return out


def _open(parent: Node, tag: str, source: str) -> Node:
    given = _attributes(source) if "=" in source or "hidden" in source else {}
    names = f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}".strip()
    words = {w.lower() for w in _NAMES.findall(names)}
    top = tag in ("html", "body") or (tag in CONTENT and not parent.content)  # names of the whole page or article say nothing about it
    marked = tag in NEVER or (not top and not words.isdisjoint(MARKED)) or (not parent.content and (tag in OUTER or (not top and not words.isdisjoint(OUTER))))
    hidden = "hidden" in given or given.get("aria-hidden") == "true" or bool(_HIDDEN.search(given.get("style", "")))
    name = f"{tag}.{_DIGITS.sub('#', names)}"
    key = xxhash.xxh64_intdigest(name, parent.key & 0xFFFFFFFF) - (1 << 63)
    learned = parent.learned if top or (tag in PLAIN and not names) else (*parent.learned, key)
    return Node(tag, key, parent.kept and not marked and not hidden, parent.content or tag in CONTENT, learned)


def parse(source: str) -> tuple[list[tuple[str, tuple[int, ...], bool]], dict[int, tuple[int, int]], bool]:
    """Kept text blocks in page order with the nodes above them (those that importance may remove, then the text's own node and leaf) and
    whether they are in the article; presentation and content hash of each node; whether the page has an article."""
    root = Node("", 0, True, False, ())
    stack, blocks, has_article = [root], [], False
    seen: dict[int, tuple[list[str], list[str]]] = {}
    run: list[str] = []

    def end_block() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            node = stack[-1]
            if text:
                for n in stack[1:]:
                    n.text.append(text)
                if node.kept:
                    leaf = xxhash.xxh64_intdigest(f"{node.key} {text}") - (1 << 63)
                    blocks.append((text, (*node.learned, node.key, leaf), node.content))

    def close(node: Node) -> None:
        kids, texts = seen.setdefault(node.key, ([], []))
        kids += [*dict.fromkeys(node.kids), "/"]
        texts += node.text

    def add(text: str) -> None:
        if text:
            run.append(text)

    at = 0
    while True:
        m = _TAG.search(source, at)
        if m is None:
            add(source[at:])
            break
        add(source[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BREAKS:
                end_block()
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth and (tag in BREAKS or not any(n.tag in BREAKS for n in stack[depth + 1 :])):
                if tag not in BREAKS and any(n.tag in RAW | NEVER for n in stack[depth:]):
                    end_block()
                while len(stack) > depth:
                    close(stack.pop())
            continue
        if tag in BREAKS or tag in NEVER:
            end_block()
        if tag in BREAKS and tag != "br":
            closes = CLOSES.get(tag, set()) | {"p"}
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    while len(stack) > i:
                        close(stack.pop())
                    break
                if stack[i].tag in BREAKS:
                    break
        node = _open(stack[-1], tag, m[3])
        stack[-1].kids.append(tag)
        has_article = has_article or (tag in CONTENT and node.kept)
        if tag in VOID or m[3].endswith("/") and tag not in BREAKS | RAW:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
            at = stop.end() if stop else len(source)
            continue
        stack.append(node)
    end_block()
    while len(stack) > 1:
        close(stack.pop())
    nodes = {k: (xxhash.xxh64_intdigest(" ".join(kids)) - (1 << 63), xxhash.xxh64_intdigest("\n".join(texts)) - (1 << 63)) for k, (kids, texts) in seen.items()}
    return blocks, nodes, has_article


_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("nodes", pa.list_(pa.int64())), ("own", pa.int64()), ("leaf", pa.int64())]))
_NODES = pa.list_(pa.struct([("node", pa.int64()), ("style", pa.int64()), ("content", pa.int64())]))


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        bodies, blocks, nodes = [], [], []
        for source in batch.column("html").to_pylist():
            found, tree, has_article = parse(source or "")
            kept = [(t, n, inside) for t, n, inside in found if inside or not has_article]
            bodies.append(xxhash.xxh64_intdigest("\n".join(t for t, _, _ in kept)) - (1 << 63))
            blocks.append([{"text": t, "nodes": list(n[:-2]), "own": n[-2], "leaf": None if inside else n[-1]} for t, n, inside in kept])
            nodes.append([{"node": k, "style": s, "content": c} for k, (s, c) in tree.items()])
        yield pa.RecordBatch.from_arrays(
            [*batch.select(["row", "page_id", "url"]).columns, pa.array(bodies, pa.int64()), pa.array(blocks, _BLOCKS), pa.array(nodes, _NODES)],
            names=["row", "page_id", "url", "body", "blocks", "nodes"],
        )


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def importance(nodes: DataFrame) -> DataFrame:
    """(host, node, pages, importance) from one row per (host, body, node): the site style tree's weights."""
    once = nodes.groupBy("host", "node", "body").agg(F.first("style").alias("style"), F.first("content").alias("content"))
    values = once.select("host", "node", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("style").alias("value")), F.struct(F.lit(1).alias("kind"), F.col("content").alias("value")))).alias("v"))
    counts = values.groupBy("host", "node", "v.kind", "v.value").agg(F.count("*").alias("n"))
    sums = counts.groupBy("host", "node", "kind").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log2("n")).alias("s"))
    entropy = F.when(F.col("m") > 1, 1 - F.col("s") / F.col("m") / F.log2("m")).otherwise(1.0)  # of n/m, by log m
    weight = F.when(F.col("kind") == 0, PRESENTATION).otherwise(1 - PRESENTATION)
    return sums.groupBy("host", "node").agg(F.max("m").alias("pages"), F.sum(weight * entropy).alias("importance"))


def weighed(pages: Column, importance: Column) -> Column:
    return (pages * importance + PRIOR) / (pages + PRIOR)


def low_leaves(parsed: DataFrame, weights: DataFrame, low: float) -> DataFrame:
    """(host, node) of the texts that stand under the same node on nearly all of its pages; pages of one text count once."""
    leaves = F.array_distinct(F.transform("blocks", lambda b: F.struct(b["own"].alias("node"), b["leaf"].alias("leaf"))))
    once = parsed.groupBy("host", "body").agg(F.first(leaves).alias("leaves"))
    counts = once.select("host", F.explode("leaves").alias("x")).where("x.leaf IS NOT NULL").groupBy("host", "x.node", "x.leaf").agg(F.count("*").alias("n"))
    often = counts.where(weighed(F.col("n"), F.lit(0)) < low)  # no other text can be low, however few pages its node has
    return often.join(weights, ["host", "node"]).where(weighed(F.col("pages"), 1 - F.col("n") / F.col("pages")) < low).select("host", F.col("leaf").alias("node"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", low: float = LOW) -> DataFrame:
    """page_id, url, text for every row of ``pages``."""
    ship_code(pages.sparkSession)
    source = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    parsed = source.mapInArrow(_pages, "row long, page_id long, url string, body long, blocks array<struct<text:string,nodes:array<long>,own:long,leaf:long>>, nodes array<struct<node:long,style:long,content:long>>")
    parsed = stored(parsed.withColumn("host", host_of("url")), "pages")
    nodes = parsed.select("host", "body", F.explode("nodes").alias("x")).select("host", "body", "x.*")
    weights = stored(importance(nodes), "style-tree")
    tree = weights.where(weighed(F.col("pages"), F.col("importance")) < low)
    # Only nodes that some block can be removed by: a host's list stays as short as its templates.
    above = parsed.select("host", F.explode(F.array_distinct(F.flatten("blocks.nodes"))).alias("node")).distinct()
    low_nodes = tree.join(above, ["host", "node"], "left_semi").select("host", "node").unionByName(low_leaves(parsed, weights, low))
    lows = stored(low_nodes.groupBy("host").agg(F.collect_list("node").alias("lows")), "low-nodes")
    joined = parsed.select("page_id", "url", "host", "blocks").join(lows, "host", "left")
    none = F.expr("array()").cast("array<long>")
    left = F.filter("blocks", lambda b: ~F.arrays_overlap(b["nodes"], F.coalesce("lows", none)) & ~F.coalesce(F.array_contains(F.coalesce("lows", none), b["leaf"]), F.lit(False)))
    return joined.select("page_id", "url", F.array_join(F.transform(left, lambda b: b["text"]), "\n").alias("text"))
