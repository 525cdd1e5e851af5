"""HTML extraction by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one decides a block
from itself: blocks of menus, page headers and footers, sidebars, notices,
adverts, forms and reader comments (by element, role, class or id) and
link-heavy blocks are out; blocks with many stop words, and long ones with
some, are in; short ones, and ones with few stop words inside the marked
article, are left open. On a page without a marked article whose longer
blocks hold hardly any known stop word (another language), length and link
density alone decide: long blocks are in, the others are left open (and in
without links, where the neighbours are equally near). Pass two gives each open block the label of its nearest decided
neighbour in the same region (the marked article, or the page without
one); an open block without any stays in.

Pages are independent, so each is handled where it is read: no shuffle.

Defined results: null or empty html gives the empty text; markup that is
cut off or never closed is read as far as it goes; equal pages and
repeated rows each get their own row; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table

#: Characters below which a block is too short to decide, and above which few stop words suffice.
SHORT, LONG = 70, 200
#: Shares of stop words among the words, and of link text among the characters.
STOP_HIGH, STOP_LOW, LINKS = 0.30, 0.15, 0.5
#: Share of stop words in the longer blocks of a page below which its language is none of the known ones.
FOREIGN = 0.05

# Element names by their role in a page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp".split())
DROPPED_TAGS = frozenset(
    "aside audio button canvas dialog footer form header iframe menu nav noscript object select svg template video".split()
)
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "related share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
COMMENT_WORDS = frozenset("comment comments disqus".split())
# Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it not of on or that the their they this to "
    "was were which with you "
    "aber als auch auf aus bei das dem den der des die ein eine einen er es für hat ich im ist mit nach nicht noch oder "
    "sich sie sind über um und von wie wird zu zum zur "
    "au aux avec ce cette dans de des du elle en est et il ils la le les mais ne nous ou par pas pour que qui se son sont "
    "sur un une vous "
    "al como con del el ella esta este la las lo los más no para pero por se si sin su sus un una y".split()
)

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME_WORDS = re.compile(r"[a-z0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    links: int  # characters of link text
    dropped: bool  # inside a container that is no article text
    article: bool  # inside the marked article
    kept: bool | None = None


def _container(tag: str, attributes: str) -> str | None:
    """Why an element's content is no article text: 'comment' or 'other'; None if it may be."""
    names: set[str] = set()
    found = {}
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), a or b or c)
        names = set(_NAME_WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}".lower()))
    if names & COMMENT_WORDS and tag not in ("html", "body"):
        return "comment"
    if tag in DROPPED_TAGS or found.get("role", "").lower() in DROPPED_ROLES:
        return "other"
    if tag in ("html", "body", "article", "main"):
        return None
    hidden = found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", ""))
    if names & DROPPED_WORDS or hidden or re.search(r"(?:^|\s)hidden(?:\s|$)", attributes):
        return "other"
    return None


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, white space collapsed, character references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, str | None]] = []  # open elements and why they are dropped
    text: list[str] = []
    links = dropped = article = anchors = breaks = 0
    at, end = 0, len(page)

    def flush():
        nonlocal links
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append(Block(joined, min(links, len(joined)), dropped > 0, article > 0))
            text.clear()
        links = 0

    def close(depth: int):
        nonlocal dropped, article, anchors
        for name, why in stack[depth:]:
            dropped -= why is not None
            article -= name in ("article", "main")
            anchors -= name == "a"
        del stack[depth:]

    def say(raw: str):
        nonlocal links, breaks
        if raw:
            plain = _html.unescape(raw)
            text.append(plain)
            if plain.strip():
                breaks = 0
                if anchors:
                    links += len(" ".join(plain.split()))

    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue  # a comment or declaration
        tag = tag.lower()
        if tag == "br":
            breaks += 1
            if breaks > 1:
                flush()
            text.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
        elif tag in RAW_TAGS:
            stop = re.compile(f"</{tag}", re.IGNORECASE).search(page, at)
            at = stop.start() if stop else end
        elif tag not in VOID_TAGS and not attributes.endswith("/"):
            why = _container(tag, attributes)
            if tag in ("article", "main") and why is None and dropped:
                # an article never stands in a menu or advert: that one was not closed
                depth = next(i for i, e in enumerate(stack) if e[1])
                if stack[depth][1] != "comment":
                    close(depth)
            elif tag in ("p", "li", "dd", "dt", "option", "tr", "td", "th") and stack and stack[-1][0] == tag:
                close(len(stack) - 1)
            stack.append((tag, why))
            dropped += why is not None
            article += tag in ("article", "main")
            anchors += tag == "a"
    flush()
    return out


def _foreign(blocks: list[Block]) -> bool:
    """Whether the blocks that could be running text hold hardly any known stop word."""
    words = [w for b in blocks if not b.dropped and len(b.text) >= SHORT and b.links <= LINKS * len(b.text)
             for w in _WORD.findall(b.text.lower())]
    return bool(words) and sum(w in STOP_WORDS for w in words) < FOREIGN * len(words)


def label(blocks: list[Block]) -> None:
    """Both passes; sets ``kept`` of every block."""
    marked = any(b.article and not b.dropped for b in blocks)
    foreign = not marked and _foreign(blocks)
    strong = []
    for b in blocks:
        if b.dropped or (marked and not b.article) or b.links > LINKS * len(b.text):
            b.kept = False
            strong.append(False)
            continue
        words = _WORD.findall(b.text.lower())
        density = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        if len(b.text) < SHORT:
            if b.links and not marked:
                b.kept = False
        elif foreign:
            b.kept = True if len(b.text) > LONG else None
        elif density >= STOP_HIGH or (density >= STOP_LOW and len(b.text) > LONG):
            b.kept = True
        elif density < STOP_LOW and not marked:
            b.kept = False
        strong.append(b.kept is None and (not b.links if foreign else density >= STOP_LOW))
    # what stands outside the marked article is no neighbour of what stands inside
    region = [i for i, b in enumerate(blocks) if b.kept is not False or not marked]
    decided = [(n, blocks[i].kept) for n, i in enumerate(region) if blocks[i].kept is not None]
    nearest: list[bool] = []
    j = 0
    for n, i in enumerate(region):
        while j < len(decided) and decided[j][0] < n:
            j += 1
        near = [decided[k] for k in (j - 1, j) if 0 <= k < len(decided)]
        if not near:
            nearest.append(True)
        elif len(near) == 2 and abs(near[0][0] - n) == abs(near[1][0] - n) and near[0][1] != near[1][1]:
            nearest.append(strong[i])
        else:
            nearest.append(min(near, key=lambda d: abs(d[0] - n))[1])
    for i, kept in zip(region, nearest):
        if blocks[i].kept is None:
            blocks[i].kept = kept


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    label(blocks)
    return "\n".join(b.text for b in blocks if b.kept)


def extract(pages: DataFrame, html_col: str = "html", with_blocks: bool = False) -> DataFrame:
    """row (a struct of the other columns), text and, if asked for, blocks (text, kept, links)."""
    others = [c for c in pages.columns if c != html_col]
    block = pa.struct([("text", pa.string()), ("kept", pa.bool_()), ("links", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = [], []
            for page in batch.column("page"):
                blocks = blocks_of(page.as_py() or "")
                label(blocks)
                texts.append("\n".join(b.text for b in blocks if b.kept))
                if with_blocks:
                    lists.append([{"text": b.text, "kept": b.kept, "links": b.links} for b in blocks])
            columns, names = [batch.column("row"), pa.array(texts, pa.string())], ["row", "text"]
            if with_blocks:
                columns.append(pa.array(lists, pa.list_(block)))
                names.append("blocks")
            yield pa.RecordBatch.from_arrays(columns, names)

    src = pages.select(F.struct(*others).alias("row"), F.col(html_col).cast("string").alias("page"))
    schema = f"row {src.schema['row'].dataType.simpleString()}, text string"
    return src.mapInArrow(run, schema + (", blocks array<struct<text:string,kept:boolean,links:int>>" if with_blocks else ""))


def op7_html_extraction(spark, sf_dir: str) -> DataFrame:
    rows = extract(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return rows.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))
