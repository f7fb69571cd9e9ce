"""Main text of web pages, with a suffix array over each host's pages.

Markup decides first: what stands in menus, footers, forms, adverts, comments and
the like goes, and paragraphs of the article stay. What it leaves open (text in
bare containers, and pages without an article) forms a token stream per page;
the streams of a host are searched for long strings that repeat across distinct
pages, and blocks that strings of three pages or more cover are boilerplate.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeway.llm.common import fresh, stored, with_fields
from bronzeway.llm.suffixes import CLASS_LIMIT, covered_spans, removed_runs
from bronzeway.llm.urls import url_parts

#: Tokens of a repeated string that shows boilerplate, and the share of a block's
#: tokens that such strings must cover.
REPEATED_TOKENS = 8
COVERED_SHARE = 0.5
#: Distinct pages of a host that must have a string: two versions of an article are no menu.
LEAST_PAGES = 3
#: Characters by which a token stands in a stream.
TOKEN_WIDTH = 8

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S
)
_SPLIT = re.compile(r"[^a-z0-9]+")

# Fixed names of the markup language and of usual class names.
RAW = set("script style textarea title noscript xmp iframe noembed noframes".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol p pre search section summary table tbody tfoot thead tr ul".split()
)
TEXTUAL = set("p h1 h2 h3 h4 h5 h6 li blockquote pre dt dd figcaption caption tr table".split())
CONTAINERS = {"article", "main"}
DROPPED = set(
    "nav footer aside form script style template noscript button select option datalist textarea"
    " input iframe object canvas svg math audio video map dialog menu head title search".split()
)
DROPPED_ROLES = set(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar"
    " toolbar".split()
)
DROPPED_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion"
    " banner cookie cookies consent gdpr notice notices notification notifications alert popup modal"
    " overlay newsletter subscribe subscription social share sharing sidebar menu nav navbar"
    " navigation breadcrumb breadcrumbs footer comment comments respond reply replies disqus related"
    " recommended recommendations widget login signin signup search toolbar pagination pager"
    " copyright disclaimer paywall skip".split()
)
HEADERS = {"header", "masthead", "topbar"}
# What an article that stands alone isn't, whatever else its classes say.
COMMENTS = set("comment comments reply replies respond disqus".split())
# Elements that mark words of a sentence: their classes tell a style.
PHRASES = set("b i em strong u mark code q cite abbr sub sup kbd samp var time dfn s del ins bdi bdo".split())
ARTICLE_WORDS = ({"article", "body"}, {"post", "content"}, {"entry", "content"}, {"article", "content"})


class Block(NamedTuple):
    text: str
    open: bool  # markup doesn't decide whether it belongs to the article


def _attributes(text: str) -> dict[str, str]:
    if "=" not in text and "hidden" not in text:
        return {}
    return {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)
    }


def _kind(name: str, attributes: str, inside: bool) -> str:
    """dropped, container or "" for a start tag; ``inside`` an article's container."""
    if name in DROPPED or (name in HEADERS and not inside):
        return "dropped"
    found = _attributes(attributes)
    words = set(_SPLIT.split(f"{found.get('class', '')} {found.get('id', '')}".lower()))
    role = found.get("role", "").lower()
    style = found.get("style", "").replace(" ", "").lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style:
        return "dropped"
    content = found.get("itemprop", "").lower() == "articlebody" or role in ("main", "article")
    content = content or any(w <= words for w in ARTICLE_WORDS)
    words -= set() if inside or name not in CONTAINERS else DROPPED_WORDS - COMMENTS
    if name not in ("html", "body") and name not in PHRASES and not content:
        if role in DROPPED_ROLES or words & DROPPED_WORDS or (not inside and words & HEADERS):
            return "dropped"
    return "container" if content or name in CONTAINERS else ""


def page_blocks(page: str | None) -> list[Block]:
    """Blocks of text that may belong to the article, in page order.

    If the page has an article's container, only what stands in one counts, else
    all of its body. White space inside a block is one space; character references
    are decoded. NULL and empty pages have no blocks. Elements that aren't closed
    reach to the end of the element around them, a cut tag to the end of the page.
    """
    page = page or ""
    blocks: list[tuple[str, bool, bool]] = []  # text, in a container, in a textual element
    pieces: list[str] = []
    stack: list[tuple[str, str]] = []  # open elements other than inline ones: name, kind
    dropped = containers = textual = 0
    at = 0

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            blocks.append((text, containers > 0, textual > 0))
        pieces.clear()

    def take(text: str) -> None:
        if not dropped and text:
            pieces.append(html.unescape(text) if "&" in text else text)

    def close(depth: int) -> None:
        nonlocal dropped, containers, textual
        while len(stack) > depth:
            name, kind = stack.pop()
            dropped -= kind == "dropped"
            containers -= kind == "container"
            textual -= name in TEXTUAL

    end = len(page)
    while at < end:
        found = _PIECE.search(page, at)
        if not found:
            take(page[at:])
            break
        take(page[at : found.start()])
        at = found.end()
        slash, name, attributes = found[1] or found[4], found[2] or found[5], found[3] or found[6] or ""
        if not name:
            continue
        if at == end and page[-1] != ">":
            break  # a tag that the end of the page cuts
        name = name.lower()
        if slash:
            if name in BLOCKS:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    if name in BLOCKS or not any(n in BLOCKS for n, _ in stack[depth + 1 :]):
                        close(depth)
                    break
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            at = stop.start() if stop else end
            after = page.find(">", at)
            at = end if after < 0 else after + 1
            continue
        if name in BLOCKS:
            flush()
            # A paragraph ends where another block begins, an item where the next does.
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p" or (stack[depth][0] == name and name in ("li", "dt", "dd", "tr")):
                    close(depth)
                    break
                if stack[depth][0] in BLOCKS:
                    break
        elif name in ("br", "td", "th"):
            take(" ")
        if name in VOID or attributes.endswith("/"):
            continue
        kind = _kind(name, attributes, containers > 0)
        if name in BLOCKS or kind:
            if kind == "dropped" and not dropped:
                flush()
            stack.append((name, kind))
            dropped += kind == "dropped"
            containers += kind == "container"
            textual += name in TEXTUAL
    flush()
    has = any(inside for _, inside, _ in blocks)
    return [Block(t, not (inside and text)) for t, inside, text in blocks if inside or not has]


def token_stream(host: str, blocks: list[Block]) -> str:
    """The open blocks' tokens, each as a few characters that also depend on the host."""
    seed = xxhash.xxh3_64_intdigest(host)
    found = []
    for block in blocks:
        if block.open:
            for token in block.text.split():
                number = xxhash.xxh3_64_intdigest(token, seed)
                found.append(f"{number & 0xFFFFFFFF:0{TOKEN_WIDTH}x}")
    return "".join(found)


def join_blocks(blocks: list[Block], runs: list[tuple[int, int]]) -> str:
    """The article: all blocks but open ones that ``runs`` of the stream cover."""
    covered = np.zeros(sum(len(b.text.split()) for b in blocks if b.open) + 1, np.int64)
    for start, end in runs:
        covered[-(-start // TOKEN_WIDTH)] += 1
        covered[end // TOKEN_WIDTH] -= 1
    covered = np.cumsum(covered) > 0
    kept, at = [], 0
    for block in blocks:
        if block.open:
            n = len(block.text.split())
            if covered[at : at + n].sum() < COVERED_SHARE * n:
                kept.append(block.text)
            at += n
        else:
            kept.append(block.text)
    return "\n\n".join(kept)


_BLOCKS = "array<struct<text: string, open: boolean>>"


def extract_text(
    pages: DataFrame,
    url: str = "url",
    page: str = "html",
    tokens: int = REPEATED_TOKENS,
    limit: int = CLASS_LIMIT,
) -> DataFrame:
    """Replace the html by ``text``, its article, and ``n_chars``, its length.

    Blocks are joined by two line breaks. NULL, empty and text-less pages have an
    empty text; pages of any length are read whole, and no rows give none. Pages whose url
    is NULL or has no host form a host of their own. Open text goes where strings cover it
    that LEAST_PAGES distinct streams of the host have: pages with equal streams count as
    one and all get its text, and a page's own repeats aren't boilerplate. Repeated rows
    are pages each. Input columns ``text`` and ``n_chars`` are replaced, others pass
    through, whatever their names.
    """
    keep = [c for c in pages.columns if c.lower() not in (page.lower(), "text", "n_chars")]
    host, held, stream, key, runs = (fresh(c, pages.columns) for c in ("host", "blocks", "stream", "key", "runs"))
    rows = pages.select(*(F.col(f"`{c}`") for c in keep), url_parts(F.col(url))[0].alias(host), F.col(page).alias(held))
    kind = pa.list_(pa.struct([("text", pa.string()), ("open", pa.bool_())]))
    kept = rows.select(*(f"`{c}`" for c in keep))

    def parsed(batches):
        for batch in batches:
            found = [page_blocks(source) for source in batch.column(held).to_pylist()]
            streams = [token_stream(n, b) for n, b in zip(batch.column(host).to_pylist(), found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array([[b._asdict() for b in blocks] for blocks in found], kind), pa.array(streams, pa.string())],
                names=[*keep, held, stream],
            )

    every = stored(rows.mapInArrow(parsed, with_fields(kept, **{held: _BLOCKS, stream: "string"})), "pages")
    length = tokens * TOKEN_WIDTH
    # Pages with the same open text are one; those without any have no stream to search.
    texts = every.filter(F.length(stream) >= length).select(F.xxhash64(stream).alias("short"), F.col(stream).alias("text"))
    texts = texts.groupBy("short").agg(F.first("text").alias("text"))
    spans = stored(covered_spans(texts, texts, length, length // 2, limit, across=True), "spans")
    windows = shared_windows(spans, texts, length)
    found = windows.groupBy("short").agg(F.array_sort(F.collect_list("start")).alias(runs)).withColumnRenamed("short", key)

    def assemble(batches):
        for batch in batches:
            out = []
            for blocks, starts in zip(batch.column(held).to_pylist(), batch.column(runs).to_pylist()):
                covered = removed_runs([(s, 1) for s in starts or ()], length)
                out.append(join_blocks([Block(**b) for b in blocks], covered))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    closed = every.filter(F.length(stream) < length).withColumn(runs, F.lit(None).cast("array<bigint>"))
    opened = every.filter(F.length(stream) >= length).withColumn(key, F.xxhash64(stream)).join(found, key, "left")
    columns = [*(f"`{c}`" for c in keep), f"`{held}`", f"`{runs}`"]
    both = closed.select(*columns).union(opened.select(*columns))
    return both.mapInArrow(assemble, with_fields(kept, text="string", n_chars="bigint"))


def shared_windows(spans: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """(short, start) of repeated windows that LEAST_PAGES distinct texts have."""
    each = spans.select("short", F.explode("spans").alias("s")).select(
        "short", F.explode(F.sequence(F.col("s.start"), F.col("s.start") + F.col("s.n") - 1)).alias("start")
    )
    window = F.xxhash64(F.substring("text", F.col("start").cast("int") + 1, F.lit(length)))
    each = each.distinct().join(texts, "short").select("short", "start", window.alias("window"))
    pages = each.select("window", "short").distinct().groupBy("window").agg(F.count("*").alias("n"))
    return each.join(pages.filter(F.col("n") >= LEAST_PAGES).select("window"), "window", "left_semi").select("short", "start")
