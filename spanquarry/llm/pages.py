"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. First pass: containers that are boilerplate by name (menus, footers, forms,
comments and so on) are left out; the other blocks are decided by length, link density and stop-word density. Short or
undecided blocks are ambiguous. Second pass: an ambiguous block takes the label of the nearest decided block.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from spanquarry.llm.tables import batch_of

#: Characters below which a block is short, and from which stop words alone decide it.
SHORT, LONG = 70, 200
#: Share of a block's characters inside links from which it is boilerplate.
LINKS = 0.33
#: Share of stop words from which a block is running text, and below which a block outside an article is not.
STOP_HIGH, STOP_LOW = 0.25, 0.12

# fixed values: frequent function words of English, German, French and Spanish
STOP_WORDS = frozenset(
    """a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their
    them they this to was we were which will with you
    als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit nach nicht
    noch oder sein sich sie sind und uns unter von vor war wie wir zu zum zur über
    au aux avec ce ces dans de du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour qu que qui sa
    se ses son sur un une vous
    al como con del el ella ellos era esta este fue ha hay la las lo los más me mi no nos o para pero por se sin sobre su
    sus te tiene todo un una y ya""".split()
)
# fixed values: HTML elements
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title template iframe xmp svg math select".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form h1 h2
    h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead
    tr ul""".split()
)
DROPPED = frozenset("nav footer header aside form head button dialog menu fieldset label object audio video canvas".split())
MAIN = frozenset(("article", "main"))
# fixed values: words in a class, id or role that name boilerplate
BOILERPLATE = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments complementary
    consent contentinfo cookie cookies copyright disclaimer discussion disqus footer form gdpr header hidden login masthead menu
    menubar modal nav navbar navigation navigations newsletter notice notices notification overlay pagination paging popup
    promo promoted promotion reactions related reply replies respond search share sharing shoutbox sidebar sidebars signup skip
    social sponsor sponsored subscribe subscription tags toolbar widget widgets""".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*)[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    links: int  # characters inside links
    main: int  # which article or main element it is in; 0: none

    def decided(self) -> bool | None:
        """True: text, False: boilerplate, None: ambiguous."""
        size = len(self.text)
        if self.links > LINKS * size:
            return False
        if size < SHORT:
            return None if not self.links or self.main else False
        if self.main:
            return True
        words = _WORD.findall(self.text.lower())
        stop = sum(w in STOP_WORDS for w in words) / max(1, len(words))
        if stop >= STOP_HIGH:
            return True if size >= LONG else None
        return None if stop >= STOP_LOW else False


def _boilerplate(name: str, attributes: str) -> bool:
    if name in DROPPED:
        return True
    if name in ("html", "body") or not attributes:
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if key in ("class", "id", "role") and any(p.lower() in BOILERPLATE for p in _NAME_PART.findall(html.unescape(value))):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """The page's blocks outside boilerplate containers, in order."""
    out: list[Block] = []
    opened: list[str] = []
    parts: list[str] = []
    links = mains = begin = 0
    skip = 0  # depth of the container that is being left out
    inside: list[tuple[int, int]] = []  # (depth, number) of open article and main elements

    def text(raw: str) -> None:
        nonlocal links
        if raw and not skip:
            raw = html.unescape(raw)
            parts.append(raw)
            if "a" in opened:
                links += len("".join(raw.split()))

    def flush() -> None:
        nonlocal links
        if parts:
            joined = " ".join("".join(parts).split())
            if joined:
                out.append(Block(joined, links, inside[-1][1] if inside else 0))
            parts.clear()
        links = 0

    while True:
        m = _TOKEN.search(page, begin)
        text(page[begin : m.start()] if m else page[begin:])
        if not m:
            break
        begin = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if name == "br":
            if not skip:
                parts.append(" ")
            continue
        if name in BLOCKS:
            flush()
        if m[1]:
            if name in opened:
                depth = len(opened) - opened[::-1].index(name)
                # a stray end tag inside a left-out container does not close what lies around an open article
                del opened[depth - 1 :]
                if skip >= depth:
                    skip = 0
                while inside and inside[-1][0] >= depth:
                    inside.pop()
            continue
        if name in VOID or m[3].endswith("/") and name not in BLOCKS:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, begin)
            begin = end.end() if end else len(page)
            continue
        if name in BLOCKS and "p" in opened[-3:] or name == "li" and opened[-1:] == ["li"]:
            # an open paragraph (with the inline elements in it) or list item ends where the next block begins
            at = len(opened) - 1 - opened[::-1].index("p" if name != "li" or "p" in opened[-3:] else "li")
            if all(x not in BLOCKS for x in opened[at + 1 :]):
                del opened[at:]
                if skip > at:
                    skip = 0
        opened.append(name)
        if skip:
            continue
        if _boilerplate(name, m[3]):
            flush()
            skip = len(opened)
        elif name in MAIN:
            mains += 1
            inside.append((len(opened), mains))
    flush()
    return out


def main_text(page: str) -> str:
    """Blocks kept by both passes, joined by newlines. Where a page has an article, what lies outside is boilerplate."""
    found = blocks(page)
    if any(b.main for b in found):
        found = [b for b in found if b.main]
    labels = [b.decided() for b in found]
    sure = [i for i, label in enumerate(labels) if label is not None]
    kept = []
    for i, (block, label) in enumerate(zip(found, labels)):
        if label is None:
            near = min(sure, key=lambda k: (abs(k - i), not labels[k]), default=None)
            label = bool(block.main) if near is None else labels[near]
        if label:
            kept.append(block.text)
    return "\n".join(kept)


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``html`` replaced by text (the main text, empty if none) and n_chars (its code points).

    Null html counts as empty. Every page gives one row, repeated or not; other columns are kept (a column
    named text or n_chars is replaced); an empty table gives no rows.
    """
    columns = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.schema if f.name in columns)
    made = pa.schema([("text", pa.string()), ("n_chars", pa.int64())])

    def extract(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                cut = batch.slice(at, 100)
                texts = [main_text(p.as_py() or "") for p in cut.column("html")]
                extra = batch_of(made, texts, [len(t) for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [*(cut.column(c) for c in columns), *extra.columns], names=[*columns, *made.names]
                )

    return pages.select(*columns, "html").mapInArrow(extract, kinds + "text string, n_chars bigint")
