"""Main text of HTML pages by two-pass block rules.

Pass one cuts a page into blocks and classifies each by stop-word density, length and link density; pass two gives
ambiguous short blocks the label of their nearest decided neighbours. What the markup itself declares is used before
that: scripts, styles, forms, navigation, page headers, footers, asides and elements whose class, id or role names a
menu, notice, advert, sidebar or reader comments hold no blocks; blocks inside an `article` or `main` element are text
unless they are links, as an article may hold tables, quotes or a language without a stop-word list.

Text: character references are decoded, white space inside a block becomes one space, blocks are joined in page order by
a line break. Nothing else is dropped or capped.

Defined results: null and empty pages, and pages without text, give an empty text and 0 characters; markup may be
unclosed, nested wrongly or cut off; a page without any decided block has no text unless an article holds its blocks.
Null ids and urls stay, repeated rows are repeated results, other columns are ignored, an empty table gives an empty one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Function words of the languages that blocks are judged by.
STOP_WORDS = frozenset("""
a about after all also an and are as at be been but by can for from had has have he her his i if in into is it its more no
not of on one or other our out she so some than that the their them then there they this to up was we were what when which
who will with would you your
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus pour que
qui sa se ses son sont sur un une vous
aber als am auch auf aus bei bin bis das dass dem den der die du ein eine einem einen einer er es für hat ich ihr im ist
mit nach nicht noch nur oder sein sich sie sind so über um und uns vom von vor war was wie wir zu zum zur
al como con del el ella era es esta este ha hay la las lo los más mi muy no nos para pero por se si sin su sus también un una
uno y ya
""".split())
# Elements without main text, elements that bound blocks, elements whose content is not markup.
DROPPED = frozenset("""nav footer aside form script style noscript template iframe svg math canvas object embed select button
textarea dialog menu head title audio video map datalist input""".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search
section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id and role values that name what is not main text, and that name what is.
OTHER = frozenset("""ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion popup modal overlay
cookie cookies consent gdpr notice alert newsletter subscribe subscription share sharing social related recommended
recommendations sidebar aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer comment comments
disqus reply replies respond widget toolbar login signup search masthead topbar header complementary contentinfo form
dialog skip tags""".split())
MAIN = frozenset("article content entry main post story body text page wrapper container site layout".split())
NEGATED = frozenset("has with no without not is".split())
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
                 r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORD = re.compile(r"[^\W\d_]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

SHORT, LONG = 70, 200
LINKS = 0.33
LOW, HIGH = 0.20, 0.32


@dataclass
class Block:
    text: str
    links: float
    inside: bool  # of an article or main element
    heading: bool
    label: str = ""


def named_other(attributes: str, inside: bool) -> bool:
    """Whether class, id, role or style declare an element to be something else than main text."""
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN.search(value):
            return True
        if name not in ("class", "id", "role"):
            continue
        for label in value.split():
            words = [w for w in re.split(r"[-_:]+", CAMEL.sub("-", label).lower()) if w]
            if not words or words[0] in NEGATED:
                continue
            hits = [w for w in (words[0], words[-1]) if w in OTHER]
            if inside and "header" in hits:
                continue  # an article's own header holds its title
            if hits and not (len(words) == 1 and words[0] in MAIN):
                return True
    return False


def blocks_of(page: str) -> list[Block]:
    found: list[Block] = []
    open_: list[tuple[str, bool, bool]] = []  # element, whether it is dropped, whether it is main
    pieces: list[tuple[str, bool]] = []
    link = heading = False
    dropped = inside = 0

    def close_block() -> None:
        nonlocal link
        if pieces:
            text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
            if text:
                linked = len(" ".join(html.unescape("".join(p for p, in_link in pieces if in_link)).split()))
                found.append(Block(text, linked / len(text), inside > 0, heading))
            pieces.clear()
        link = False

    at, end = 0, len(page)
    while at < end:
        m = TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at and not dropped:
            pieces.append((page[at:stop], link))
        if not m:
            break
        at = m.end()
        closing, tag, attributes = m[1] if m[2] else m[4], (m[2] or m[5] or "").lower(), m[3] if m[2] else m[6]
        if not tag:
            if m[0].startswith("<![CDATA[") and not dropped:
                pieces.append((html.escape(m[0][9:].removesuffix("]]>")), link))
            continue
        if tag in BLOCKS:
            close_block()
        elif tag == "br":
            pieces.append((" ", link))
        if closing:
            if tag == "a":
                link = False
            heading = heading and tag not in HEADINGS
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == tag:
                    for _, was_dropped, was_main in open_[i:]:
                        dropped -= was_dropped
                        inside -= was_main
                    del open_[i:]
                    break
            continue
        if tag == "a":
            link = True
        if tag in HEADINGS:
            heading = True
        if tag in RAW:
            closed = RAW[tag].search(page, at)
            at = closed.end() if closed else end
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        main = tag in ("article", "main") or "role=\"main\"" in attributes
        drop = tag in DROPPED or tag == "header" and not inside or tag not in ("html", "body", "article", "main") and named_other(attributes, inside > 0)
        if tag in BLOCKS and tag != "p" or drop:
            open_.append((tag, drop, main and not drop))
            dropped += drop
            inside += main and not drop
    close_block()
    return found


def classify(blocks: list[Block]) -> None:
    """Label blocks `good`, `bad`, or for now `short` (too little text to tell) and `near` (likely text)."""
    for b in blocks:
        words = WORD.findall(b.text.lower())
        density = sum(w in STOP_WORDS for w in words) / len(words) if words else 0
        if b.links > LINKS and not b.heading or b.text.startswith(("©", "(c)", "Copyright")) and len(b.text) < LONG and not b.inside:
            b.label = "bad"
        elif b.inside and (len(b.text) >= SHORT or density >= LOW):
            b.label = "good"
        elif len(b.text) < SHORT:
            b.label = "bad" if b.links > 0 and not b.inside else "short"
        elif density >= HIGH:
            b.label = "good" if len(b.text) >= LONG else "near"
        else:
            b.label = "near" if density >= LOW else "bad"
    decided = [b.label if b.label in ("good", "bad") else "" for b in blocks]
    before, after, last = [], [], ("", 0)
    for i, label in enumerate(decided):
        last = (label, i) if label else last
        before.append(last)
    last = ("", 0)
    for i in range(len(decided) - 1, -1, -1):
        last = (decided[i], i) if decided[i] else last
        after.append(last)
    after.reverse()
    for i, b in enumerate(blocks):
        if b.label in ("good", "bad"):
            continue
        (left, l_at), (right, r_at) = before[i], after[i]
        if b.inside and "good" not in (left, right):
            b.label = "good"  # an article of short blocks only
        elif not left or not right or left == right:
            b.label = left or right or "bad"
        elif b.inside or b.label == "near":
            b.label = "good"
        else:
            b.label = left if i - l_at < r_at - i else right if r_at - i < i - l_at else "good" if b.heading and right == "good" else "bad"


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    classify(blocks)
    return "\n".join(b.text for b in blocks if b.label == "good")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html_: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html_).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
