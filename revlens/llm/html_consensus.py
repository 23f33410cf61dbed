"""Main-text extraction by consensus paths of a host.

Each page is parsed into elements and text blocks. Blocks in menus, headers,
footers, sidebars, notices, adverts, forms and comments (by tag or by a word
of class, id or role) are boilerplate; a wrapper that is named by such a word only in
part ("content-sidebar-wrap") or is a form is not, if hardly any other text is left without it. Of the
rest, blocks with at most half their text in links are the page's main blocks
(where there are none, those with any text outside links).

A block's container is the innermost element around it that is no paragraph, list
or the like; its generalised path is the tags and classes down to it, digits folded. Each
page scores its containers by their text outside links, and the scores are summed per host and path in Spark. Text that
stands on at least ``REPEATED`` of a host's different pages gives no score. Paths with at least
``LEAST_SHARE`` of a host's score win. Every page is then extracted anew: a
main block stays if its path wins, or if its text does not repeat on the host, so
no article of an uncommon layout is lost; blocks of links stay inside the innermost element around the winners.
Where hardly anything of a host is unrepeated, repetition says nothing and is left out.

Inside a block white space becomes one blank; blocks are joined by line feeds.
Paths are kept as rolling 64-bit hashes, so memory is linear in the page. Pages
are not shuffled: they are joined to their host's paths and repeated texts,
which are few. A host with very many pages can be split.

Defined results: NULL html counts as empty; a page without main text gives an
empty string; NULL or odd urls form hosts of their own ("" for no host); all
paths that reach the share win, so there are no ties; equal pages of a host count as one page when repetition is
counted and get equal results; NULL page ids are kept; empty tables give empty results; other
columns are ignored; deeply nested and very long pages take linear time and space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Share of a host's score that makes a path win.
LEAST_SHARE = 0.05
#: Share of a host's different pages on which a text counts as repeated; and the least number of them.
REPEATED, LEAST_PAGES = 0.5, 3
#: Share of a host's text that must be unrepeated for repetition to tell anything.
LEAST_OWN = 0.25
#: A partly named wrapper is no boilerplate if it holds so many times the text that is left without it.
WRAPS = 4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead tr ul br".split()
)
CLOSED_BY = {
    "p": BLOCK - {"br"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "thead", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "option": frozenset({"option", "optgroup"}),
    "head": frozenset({"body"}),
}
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption address ul ol dl table tbody".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside menu dialog button select head".split())
WRAPPING_TAGS = frozenset("form fieldset".split())

# Words of class, id or role that name boilerplate.
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "complementary consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation "
    "newsletter notice notices notification pager pagination popup promo promotion promoted recommended related "
    "replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar "
    "widget widgets".split()
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


# How an element is named: not as boilerplate, in part or as a wrapper, plainly.
CLEAR, PARTLY, PLAINLY = 0, 1, 2


class Node:
    """An element: rolling hash of its path, whether it is named as
    boilerplate, and the innermost element so named around or at it."""

    __slots__ = ("tag", "path", "parent", "depth", "named", "suspect", "mass", "cleared", "dull", "in_article")

    def __init__(self, tag, name, parent, named):
        self.tag, self.parent, self.named = tag, parent, named
        self.path = xxhash.xxh64_intdigest(name, parent.path if parent else 0)
        self.depth = parent.depth + 1 if parent else 0
        self.suspect = self if named else parent.suspect if parent else None
        self.in_article = tag in ("article", "main") or bool(parent and parent.in_article)
        self.mass, self.cleared, self.dull = 0, False, True


def _attributes(text: str) -> tuple[str, int]:
    """(classes for the path, how it is named)."""
    classes, named = "", CLEAR
    for m in _ATTRIBUTE.finditer(text):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("hidden", "aria-hidden"):
            if name == "hidden" or value.lower() == "true":
                named = PLAINLY
            continue
        if name == "class":
            classes = ".".join(sorted(re.sub(r"\d+", "#", c) for c in value.split()))
        for token in value.split():
            words = [w.lower() for w in _WORD.findall(token)]
            if any(w in BOILERPLATE_WORDS for w in words):
                named = max(named, PLAINLY if len(words) == 1 else PARTLY)
    return classes, named


def parse(html: str) -> list[tuple[str, int, Node]]:
    """Blocks of a page in order: (text, characters of it in links, element)."""
    root = Node("#page", "#page", None, CLEAR)
    stack = [root]
    is_open: dict[str, int] = {}
    blocks: list[tuple[str, int, Node]] = []
    pieces: list[str] = []
    linked = link_depth = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                blocks.append((text, min(linked, len(text)), stack[-1]))
            pieces.clear()
        linked = 0

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text:
            pieces.append(text)
            if link_depth:
                linked += len(text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                link_depth = max(0, link_depth - 1)
            if tag in BLOCK:
                flush()
                while is_open.get(tag):
                    top = stack.pop()
                    is_open[top.tag] -= 1
                    if top.tag == tag:
                        break
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            if not m[3].rstrip().endswith("/"):
                at = close.end() if close else end
            continue
        if tag == "a":
            link_depth = 1
        if tag not in BLOCK:
            continue
        flush()
        if tag in VOID:
            continue
        while len(stack) > 1 and tag in CLOSED_BY.get(stack[-1].tag, ()):
            is_open[stack.pop().tag] -= 1
        if tag in ("html", "body") and is_open.get(tag):
            continue
        classes, named = _attributes(m[3]) if m[3] else ("", CLEAR)
        up = stack[-1]
        link_depth = 0
        # html and body carry classes of the whole page, which say nothing;
        # nor do words on an article, whose header is part of it
        if tag in ("html", "body", "article", "main"):
            named = CLEAR
        elif tag in BOILERPLATE_TAGS:
            named = PLAINLY
        elif tag in WRAPPING_TAGS:
            named = max(named, PARTLY)
        if up.in_article and (tag == "header" or "header" in classes.split(".")):
            named = CLEAR
        stack.append(Node(tag, f"{tag}.{classes}" if classes else tag, up, named))
        is_open[tag] = is_open.get(tag, 0) + 1
    flush()
    _clear_wrappers(blocks)
    return blocks


def _clear_wrappers(blocks: list[tuple[str, int, Node]]) -> None:
    """Clear partly named elements that hold the page's text: as long as the
    largest of those not inside another suspect holds ``WRAPS`` times the text that is free of suspects."""
    free, own = 0, {}
    for text, linked, node in blocks:
        if node.suspect is None:
            free += len(text) - linked
        else:
            own[node.suspect] = own.get(node.suspect, 0) + len(text) - linked
    # every suspect around such text, outer before inner
    suspects: dict[Node, list[Node]] = {}
    for node in own:
        inner = None
        while node is not None and node not in suspects:
            suspects[node] = []
            if inner is not None:
                suspects[node].append(inner)
            inner, node = node, node.parent.suspect if node.parent else None
        if node is not None and inner is not None:
            suspects[node].append(inner)
    for node in sorted(suspects, key=lambda n: -n.depth):
        node.mass = own.get(node, 0) + sum(x.mass for x in suspects[node])
    inside = {x for held in suspects.values() for x in held}
    outer = [n for n in suspects if n not in inside]
    while True:
        held = [n for n in outer if n.named == PARTLY and n.mass >= max(1, WRAPS * free)]
        if not held:
            break
        widest = max(held, key=lambda n: n.mass)
        widest.cleared = True
        free += own.get(widest, 0)
        outer.remove(widest)
        outer += suspects[widest]
    for node in sorted(suspects, key=lambda n: n.depth):
        around = node.parent.suspect if node.parent else None
        node.dull = not node.cleared or (around is not None and around.dull)


def _dull(node: Node) -> bool:
    return node.suspect is not None and node.suspect.dull


def container(node: Node) -> Node:
    while node.tag in LEAF and node.parent is not None:
        node = node.parent
    return node


def text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text)


def signed(x: int) -> int:
    """A 64-bit hash as Spark's long."""
    return x - (1 << 64) if x >= 1 << 63 else x


def main_blocks(blocks: list[tuple[str, int, Node]]) -> list[int]:
    """Places of the page's main blocks."""
    plain = [i for i, (text, linked, node) in enumerate(blocks) if not _dull(node) and linked < len(text)]
    return [i for i in plain if 2 * blocks[i][1] <= len(blocks[i][0])] or plain


def votes(blocks: list[tuple[str, int, Node]]) -> list[tuple[int, int, int]]:
    """(path of the container, hash of the text, score) of each main block."""
    out = []
    for i in main_blocks(blocks):
        text, linked, node = blocks[i]
        out.append((signed(container(node).path), signed(text_hash(text)), len(text) - linked))
    return out


def _common(nodes: list[Node]) -> Node:
    """The innermost element that holds all of ``nodes``."""
    one = nodes[0]
    for other in nodes[1:]:
        while one.depth > other.depth:
            one = one.parent
        while other.depth > one.depth:
            other = other.parent
        while one is not other:
            one, other = one.parent, other.parent
    return one


def main_text(blocks: list[tuple[str, int, Node]], winners: set[int], repeated: set[int]) -> str:
    """The page's main blocks that a winning path holds or that do not repeat
    on the host, and blocks of links among them, in page order."""
    main = main_blocks(blocks)
    won = [i for i in main if signed(container(blocks[i][2]).path) in winners]
    keep = set(won) | {i for i in main if signed(text_hash(blocks[i][0])) not in repeated}
    if not keep:
        return ""
    around = _common([container(blocks[i][2]) for i in won or sorted(keep)])
    seen = set(main)
    inside: dict[Node, bool] = {around: True}
    for i, (_, _, node) in enumerate(blocks):
        if i in seen or _dull(node):
            continue
        line = []
        while node is not None and node not in inside:
            line.append(node)
            node = node.parent
        held = node is not None and inside[node]
        for x in line:
            inside[x] = held
        if held:
            keep.add(i)
    return "\n".join(blocks[i][0] for i in sorted(keep))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, pages, paths, texts, scores = [], [], [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = signed(text_hash(html or ""))
            for path, text, score in votes(parse(html or "")):
                hosts.append(host)
                pages.append(page)
                paths.append(path)
                texts.append(text)
                scores.append(score)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string())] + [pa.array(x, pa.int64()) for x in (pages, paths, texts, scores)],
            ["host", "page", "path", "text", "score"],
        )


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        columns = [batch.column(c).to_pylist() for c in ("html", "paths", "repeated")]
        for html, paths, repeated in zip(*columns, strict=True):
            texts.append(main_text(parse(html or ""), set(paths or ()), set(repeated or ())))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def host_facts(pages: DataFrame) -> DataFrame:
    """(host, paths, repeated): the winning paths of each host, at most ``1 /
    LEAST_SHARE``, and the texts that repeat on it, at most ``1 / REPEATED`` times the blocks of a page.

    Scores and page counts are aggregated inside tasks first, so a host with
    most of the pages is no hot key."""
    rows = stored(
        pages.mapInArrow(_vote_batches, "host string, page long, path long, text long, score long"), "votes"
    )
    size = rows.groupBy("host").agg(F.count_distinct("page").alias("pages"))
    often = rows.groupBy("host", "text").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= LEAST_PAGES)
    repeated = stored(
        often.join(size, "host").where(F.col("n") >= REPEATED * F.col("pages")).select("host", "text"), "repeated"
    )
    scored = rows.groupBy("host", "path", "text").agg(F.sum("score").alias("score"))
    marked = scored.join(repeated.withColumn("again", F.lit(True)), ["host", "text"], "left")
    own = F.when(F.col("again").isNull(), F.col("score")).otherwise(0)
    by_path = stored(marked.groupBy("host", "path").agg(F.sum("score").alias("score"), F.sum(own).alias("own")), "paths")
    total = by_path.groupBy("host").agg(F.sum("score").alias("all_score"), F.sum("own").alias("all_own"))
    telling = F.col("all_own") >= LEAST_OWN * F.col("all_score")
    won = F.when(telling, F.col("own") >= LEAST_SHARE * F.col("all_own")).otherwise(
        F.col("score") >= LEAST_SHARE * F.col("all_score")
    )
    best = by_path.join(total, "host").where(won & (F.col("score") > 0)).groupBy("host", telling.alias("telling")).agg(
        F.sort_array(F.collect_list("path")).alias("paths")
    )
    texts = repeated.groupBy("host").agg(F.sort_array(F.collect_list("text")).alias("repeated"))
    none = F.array().cast("array<bigint>")
    facts = best.join(texts, "host", "left").select(
        "host", "paths", F.when(F.col("telling"), F.coalesce("repeated", none)).otherwise(none).alias("repeated")
    )
    return stored(facts, "host_facts")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"),
        host_of(F.col(url)).alias("host"),
    )
    facts = host_facts(rows.select("host", "html"))
    joined = rows.join(facts, "host", "left").select("page_id", "url", "html", "paths", "repeated")
    schema = f"page_id {pages.schema[page_id].dataType.simpleString()}, url string, text string"
    return joined.mapInArrow(_extract_batches, schema).withColumn("n_chars", F.length("text").cast("long"))
