"""HTML extraction: main text of pages, after removal of the subtrees that a site repeats."""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.llm.common import bitmap, checkpoint, in_bitmap

#: Elements that are never main text, elements without an end tag, and elements that start a block (fixed values).
DROP = {"nav", "header", "footer", "aside", "form", "script", "style", "head", "template", "noscript", "iframe", "svg", "button", "select", "textarea", "dialog", "menu", "object", "canvas", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p", "pre", "section", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"} | DROP
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
#: Words of class and id attributes, and roles, that mark what isn't the article.
MARKED = re.compile(r"(?i)(?:^|[\s_-])(?:ad|ads|advert|advertisement|adverts|banner|sponsor|sponsored|promo|cookie|cookies|consent|notice|popup|modal|newsletter|subscribe|signup|login|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|sidebar|footer|header|masthead|comment|comments|disqus|respond|share|social|related|recommended|widget|toolbar)(?:$|[\s_-])")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|([^<]+)|<", re.S)
_ATTR = re.compile(r"(?i)\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
#: A link-dense subtree is the site's when it is on LEAST_PAGES distinct pages of a host. Any other one must besides be on
#: LEAST_SHARE of them or, so that the host's size doesn't matter, on MANY_PAGES.
LEAST_PAGES, LEAST_SHARE, MANY_PAGES = 3, 0.3, 10
#: Share of a subtree's characters inside links from which it is link-dense, and of a page's characters inside articles
#: from which the articles are its main text.
LINKS, ARTICLE = 0.5, 0.5
FILTER_BITS = 24


@dataclass
class _Open:
    """An open element: whether it is dropped, within an article or main, within an article; its content so far (texts, and digests of
    its children), characters, those of them in links, and the place in the stack of the last block element up to it."""

    tag: str
    node: int
    dropped: bool = False
    main: bool = False
    article: bool = False
    block_at: int = 0
    content: list[str] = field(default_factory=list)
    size: int = 0
    linked: int = 0


def blocks_of(page: str) -> tuple[list[tuple[str, bool, int]], list[int], list[int]]:
    """(blocks, parents, trees) of a page: blocks in order, as (text, inside an article, the innermost subtree around it or -1); for each
    subtree the next one around it (a smaller index, or -1) and its hash.

    Subtrees are hashed by tag, texts and the hashes of their children, so the time is linear in the page whatever the nesting;
    the lowest bit is set for the link-dense. Inside an article element only link-dense ones are, as what an article says may well
    be repeated on a site. Unclosed elements end with their parent.
    """
    stack = [_Open("", 0)]
    parents, trees = [-1], [None]
    opened: dict[str, list[int]] = defaultdict(list)  # places in the stack of the open elements of a tag
    blocks: list[tuple[str, bool, int]] = []
    buffer: list[str] = []
    linked_chars = 0  # characters of the buffer that stand in links

    def flush() -> None:
        nonlocal linked_chars
        text = " ".join(entities.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            top = stack[-1]
            top.content.append(text)
            top.size += len(text)
            top.linked += len(text) if opened["a"] else min(len(text), linked_chars)
            if not top.dropped:
                blocks.append((text, top.main, top.node))
        linked_chars = 0

    def close() -> None:
        own = stack.pop()
        opened[own.tag].pop()
        if own.content:
            digest = hashlib.md5("\x00".join([own.tag, *own.content]).encode()).digest()
            dense, top = own.linked >= LINKS * own.size, stack[-1]
            if not own.dropped and (not own.article or dense):
                value = int.from_bytes(digest[:8], "little", signed=True)
                trees[own.node] = value | 1 if dense else value & ~1
            top.content.append(digest.hex())
            top.size += own.size
            top.linked += own.linked

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[4] is not None or m[0] == "<":
            buffer.append(m[0])
            if opened["a"]:
                linked_chars += len(m[0].strip())
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in BLOCK:
            flush()
        if m[1]:
            if opened[tag]:
                if tag not in BLOCK and stack[-1].block_at > opened[tag][-1]:
                    continue  # an inline end tag doesn't close blocks
                if tag not in BLOCK and stack[-1].tag != tag:
                    flush()
                while True:
                    done = stack[-1].tag == tag
                    if done and (stack[-1].dropped != stack[-2].dropped or tag in BLOCK):
                        flush()
                    close()
                    if done:
                        break
            continue
        if tag in VOID:
            continue
        if tag in {"p", "li", "td", "th", "tr", "dt", "dd", "option"} and stack[-1].tag == tag:
            close()
        found = {a.lower(): (b or c or d) for a, b, c, d in _ATTR.findall(m[3])} if m[3] else {}
        drop = tag in DROP or found.get("role", "").lower() in ROLES or any(MARKED.search(found.get(x, "")) for x in ("class", "id"))
        drop = drop and tag not in {"html", "body", "article", "main"}
        if drop and tag not in BLOCK:
            flush()
        if m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        top = stack[-1]
        opened[tag].append(len(stack))
        parents.append(top.node)
        trees.append(None)
        stack.append(_Open(tag, len(trees) - 1, top.dropped or drop, top.main or tag in {"article", "main"}, top.article or tag == "article", len(stack) if tag in BLOCK else top.block_at))
    flush()
    while len(stack) > 1:
        close()
    # Only subtrees with a hash are told.
    place, kept = [-1] * len(trees), []
    for i in range(1, len(trees)):
        place[i] = place[parents[i]]
        if trees[i] is not None:
            kept.append((place[i], trees[i]))
            place[i] = len(kept) - 1
    return [(t, inside, place[i]) for t, inside, i in blocks], [p for p, _ in kept], [h for _, h in kept]


def main_text(blocks: list[dict], parents: list[int], trees: list[int], gone: set[int]) -> str:
    """The text of the blocks that are in no subtree that is gone; of the articles alone, if they hold ARTICLE of its characters."""
    out: list[bool] = []
    for parent, tree in zip(parents, trees, strict=True):
        out.append((parent >= 0 and out[parent]) or tree in gone)
    left = [b for b in blocks if b["at"] < 0 or not out[b["at"]]]
    inside = [b["text"] for b in left if b["inside"]]
    whole = [b["text"] for b in left]
    return " ".join(inside if sum(map(len, inside)) >= ARTICLE * sum(map(len, whole)) else whole)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, many_pages: int = MANY_PAGES) -> DataFrame:
    """Main text of whole pages: (id, url, text, n_chars).

    Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles go by element, role, class and
    id. On every page subtrees whose hash is on ``least_pages`` distinct pages of the host go too if they are link-dense
    or also on ``least_share`` of the host's pages or on ``many_pages``; inside an article element only the link-dense. Copies of a page count once. Where articles (article or
    main elements) hold at least half of the characters that are left, they alone are the text; otherwise, as with articles that
    are teasers beside the body, all that is left is.
    White space inside a block becomes one space; blocks are joined by one space. Null and empty html give an empty text; a null url
    is a host of its own. Repeated rows give repeated rows; extra columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.struct([("text", pa.string()), ("inside", pa.bool_()), ("at", pa.int32())])
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                rest, parents, trees = [], [], []
                for x in part.column(2):
                    own, around, hashes = blocks_of(x.as_py() or "")
                    rest.append([{"text": t, "inside": inside, "at": at} for t, inside, at in own])
                    parents.append(around)
                    trees.append(hashes)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), part.column(4), pa.array(rest, pa.list_(block)), pa.array(parents, pa.list_(pa.int32())), pa.array(trees, pa.list_(pa.int64()))], ["id", "url", "host", "page", "rest", "parents", "trees"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                texts = [main_text(*(x.as_py() for x in row[:3]), set(row[3].as_py() or ())) for row in zip(*part.columns[2:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    host = F.lower(F.coalesce(F.try_parse_url(F.col(url_col), F.lit("HOST")), F.lit("")))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"), F.xxhash64(F.coalesce(F.col(html_col), F.lit(""))).alias("page"))
    kind = pages.schema[id_col].dataType.simpleString()
    parsed = checkpoint(rows.mapInArrow(run, f"id {kind}, url string, host string, page long, rest array<struct<text: string, inside: boolean, at: int>>, parents array<int>, trees array<long>"))
    # Distinct pages of each host, and of each of its subtrees; pre-aggregated, so a hot host is no hot task.
    pages_of = parsed.groupBy("host", "page").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("n_pages"))
    trees = parsed.select("host", "page", F.explode("trees").alias("tree")).distinct().groupBy("host", "tree").agg(F.count("*").alias("m")).where(F.col("m") >= least_pages)
    enough = (F.col("tree").bitwiseAND(F.lit(1)) == 1) | (F.col("m") >= F.least(least_share * F.col("n_pages"), F.lit(float(many_pages))))
    site = trees.join(pages_of, "host").where(enough).select("host", "tree")
    gone = parsed.select("host", "page", F.explode("trees").alias("tree")).distinct().join(site, ["host", "tree"]).groupBy("host", "page").agg(F.collect_set("tree").alias("gone"))
    gone = checkpoint(gone)
    # Texts travel only of pages that hold such a subtree (and of the few others that a bitmap lets pass).
    sent = pages.sparkSession.sparkContext.broadcast(bitmap(gone, "page", FILTER_BITS))

    def holding(wanted: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = in_bitmap(sent.value, batch.column(3).to_numpy(zero_copy_only=False) & ((1 << FILTER_BITS) - 1))
                yield batch.filter(pa.array(held == wanted))

        return parsed.mapInArrow(run, parsed.schema)

    columns = ("id", "url", "rest", "parents", "trees")
    out = holding(True).join(gone, ["host", "page"], "left").select(*columns, "gone")
    out = out.union(holding(False).select(*columns, F.lit(None).cast("array<long>").alias("gone")))
    return out.mapInArrow(cut, f"id {kind}, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
