"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block-level tags. The first pass judges each
block by itself, by its container (menus, headers, footers, sidebars, notices,
adverts, forms, comments are out), its link density, its length and its density
of stop words: it is good, bad or undecided (short, or between the thresholds).
The second pass gives the undecided ones the label of their nearest decided
neighbours within the same part of the page.

A part is an `article` or `main` element, or what lies outside all of them. Which
parts hold the article is told by the good text that the first pass finds:

* as much or more within marked parts than outside (none at all included): what
  lies outside is out, and so is a part that has no good text and looks like a
  card (by its class, or more than half links). Within the others, which are
  kept whole, few stop words leave a block undecided, and a part's edges count
  as good;
* more outside: the marks tell nothing, and all parts are judged by the two
  passes alone, their edges counting as bad.

Class and id words count as whole names: `ad-7` or `cookie-notice` name what isn't
the article, `ad-hoc` or `share-price` don't.

Pages are independent, so the work is one pass over the rows, no shuffle.

Defined results
* null or empty html, or no good block: empty text, 0 characters;
* markup that breaks off, or isn't closed, ends at the end of the page;
* whole pages, however long; work is linear in the page's length;
* repeated rows give repeated rows; an empty table an empty table; other
  columns are not read.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

#: Frequent function words of four languages.
STOP_WORDS = frozenset((
    "a about after all also an and are as at be because been but by can could did do for from had has have he her his "
    "i if in into is it its more no not of on only or other our she so some than that the their them then there these "
    "they this to up was we were what when which who will with would you your "
    "au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ou "
    "par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "als am auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich "
    "ihr im in ist ja kein mit nach nicht noch nur oder sich sie sind so über um und uns unter von vor war was wenn "
    "werden wie wir wird zu zum zur "
    "al como con cuando de del desde donde el ella en entre era es esta este está fue ha hay la las lo los más me mi "
    "muy no nos o para pero por que se sin sobre son su sus también un una y ya").split())
#: Thresholds of the first pass (characters; shares).
SHORT, LONG, STOP_LOW, STOP_HIGH, LINKS = 70, 200, 0.15, 0.30, 0.5

BLOCK_TAGS = frozenset((
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table tbody td tfoot th thead tr ul").split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text that no tag ends but their own.
RAW_TAGS = frozenset("iframe noembed noframes script style textarea title xmp".split())
OUT_TAGS = frozenset((
    "aside audio button canvas datalist dialog fieldset footer form head label menu nav noscript object search "
    "select svg template video").split())
OUT_ROLES = frozenset((
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist "
    "toolbar").split())
#: Words of class and id that name what isn't the article.
OUT_NAMES = frozenset((
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment comments "
    "consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notices overlay pager pagination paywall popup promo promoted promotion recommended related "
    "replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser "
    "toolbar topbar widget widgets").split())
#: Words that a name may have beside one of those.
NEUTRAL_NAMES = frozenset((
    "area article bar big block blog body bottom box button buttons center column container content entry fixed footer "
    "form frame group head header holder icon icons inline inner item items js large left link links list main "
    "medium mobile module news outer page panel post posts primary rail reader region right row secondary section "
    "side site slot small space story sub sticky text thread top unit user view wrap wrapper").split())
CARD_NAMES = frozenset("card cards excerpt preview promo related summary teaser teasers tile tiles".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond teaser related".split())
HEADER_NAMES = frozenset("global head header main page site top".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    link_chars: int
    out: bool       # in a container that holds no article text
    part: int       # 0, or the innermost article or main element it lies in
    heading: bool


@dataclass
class Part:
    parent: int
    card: bool      # named so


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)}


def _is_out(tag: str, rest: str, in_part: bool) -> bool:
    """Whether an element of this tag and attributes holds no article text."""
    if tag in OUT_TAGS:
        return True
    if "=" not in rest and "hidden" not in rest:
        return False
    a = _attributes(rest)
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", "")):
        return True
    if a.get("role", "").lower() in OUT_ROLES and tag not in ("html", "body"):
        return True
    if tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return _named(a, COMMENT_NAMES, NEUTRAL_NAMES)
    return _named(a, OUT_NAMES, NEUTRAL_NAMES) or not in_part and _named(a, frozenset(("header",)), HEADER_NAMES)


def _named(attributes: dict[str, str], names: frozenset[str], beside: frozenset[str]) -> bool:
    """Whether a class or id consists of these names, and words that go beside
    them, with one of the names at least."""
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = {w.lower() for w in NAME_WORDS.findall(token) if not w.isdigit()}
        if words & names and words <= names | beside:
            return True
    return False


def blocks(page: str) -> tuple[list[Block], list[Part]]:
    """The page's blocks in order, empty ones left out, and its parts; the
    first is what lies outside all others."""
    found: list[Block] = []
    parts = [Part(0, False)]
    text: list[str] = []
    linked: list[str] = []
    # open elements: tag, elements that are out so far, part, in a link
    stack: list[tuple[str, bool, int, bool, bool]] = [("", False, 0, False, False)]
    opened: dict[str, int] = {}
    heading = False

    def close() -> None:
        nonlocal text, linked, heading
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                _, out, part, _, header = stack[-1]
                found.append(Block(joined, len(" ".join("".join(linked).split())),
                                   out or header and not heading, part, heading))
            text, linked = [], []

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        data = page[at:m.start() if m else n]
        if data:
            data = html.unescape(data)
            text.append(data)
            if stack[-1][3]:
                linked.append(data)
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        rest = m["rest"] or m["rest2"] or ""
        if m["end"] or m["end2"]:
            if tag in BLOCK_TAGS:
                close()
                heading = False
            if opened.get(tag):
                while True:
                    gone = stack.pop()[0]
                    opened[gone] -= 1
                    if gone == tag:
                        break
            continue
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in BLOCK_TAGS:
            close()
            heading = tag in HEADINGS
        elif tag == "br":
            text.append(" ")
        if tag in VOID_TAGS or rest.endswith("/") and tag not in BLOCK_TAGS:
            continue
        _, out, part, link, header = stack[-1]
        if tag in ("article", "main") and not out:
            parts.append(Part(part, "=" in rest and _named(_attributes(rest), CARD_NAMES, NEUTRAL_NAMES)))
            part = len(parts) - 1
        if tag == "header":  # a page's is out; an article's keeps its headings
            header, out = True, out or not part
        stack.append((tag, out or _is_out(tag, rest, bool(part)), part, link or tag == "a", header))
        opened[tag] = opened.get(tag, 0) + 1
    close()
    return found, parts


def first_pass(b: Block) -> bool | None:
    """Good, bad, or None where only the neighbours can tell."""
    if b.out or b.link_chars > LINKS * len(b.text):
        return False
    if len(b.text) < SHORT:
        return None
    words = WORDS.findall(b.text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if density >= STOP_HIGH:
        return True if len(b.text) > LONG else None
    return None if density >= STOP_LOW else False


def kept_parts(found: list[Block], parts: list[Part], labels: list[bool | None]) -> set[int]:
    """The marked parts that hold the article by what the first pass finds;
    none if the marks tell nothing."""
    good, chars, links = ([0] * len(parts) for _ in range(3))
    for b, label in zip(found, labels):
        if not b.out:
            good[b.part] += len(b.text) * bool(label)
            chars[b.part] += len(b.text)
            links[b.part] += b.link_chars
    if not sum(chars[1:]) or sum(good[1:]) < good[0]:
        return set()
    kept = {i for i in range(1, len(parts)) if good[i] or not (parts[i].card or links[i] > LINKS * chars[i])}
    return kept or set(range(1, len(parts)))     # cards only: they are what there is


def second_pass(found: list[Block], labels: list[bool | None], whole: set[int]) -> list[bool]:
    """Undecided blocks inherit from the nearest decided neighbours on either
    side that lie in the same part and aren't out by their container. In a part
    that is kept ``whole``, whose edges count as good, a block is bad only
    between two bad ones; elsewhere, with edges that count as bad, the nearer
    side decides and a tie is bad."""
    far = len(found) + 1
    before: list[tuple[int, bool]] = []
    latest: dict[int, tuple[int, bool]] = {}
    for i, b in enumerate(found):
        before.append(latest.get(b.part, (-far, b.part in whole)))
        if labels[i] is not None and not b.out:
            latest[b.part] = (i, bool(labels[i]))
    latest = {}
    out = [bool(x) for x in labels]
    for i in range(len(found) - 1, -1, -1):
        b = found[i]
        if labels[i] is None:
            (p, was), (q, comes) = before[i], latest.get(b.part, (i + 2 * far, b.part in whole))
            if b.part in whole:
                out[i] = was or comes
            else:
                out[i] = was and comes if i - p == q - i else was if i - p < q - i else comes
        elif not b.out:
            latest[b.part] = (i, bool(labels[i]))
    return out


def judged(page: str) -> list[tuple[Block, bool]]:
    """The blocks of a page, each good or not."""
    found, parts = blocks(page)
    labels = [first_pass(b) for b in found]
    whole = kept_parts(found, parts, labels)
    if whole:
        for i, b in enumerate(found):
            if b.part not in whole:
                labels[i] = False
            elif labels[i] is False and not b.out and b.link_chars <= LINKS * len(b.text):
                labels[i] = None                # few stop words alone don't cut an article
    return list(zip(found, second_pass(found, labels, whole)))


def main_text(page: str | None) -> str:
    """The good blocks of a page, joined by blank lines."""
    return "\n\n".join(b.text for b, good in judged(page or "") if good)


def main_text_column(page: Column) -> Column:
    def run(values: pa.Array) -> pa.Array:
        return pa.array([main_text(v.as_py()) for v in values], pa.string())

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "string").asNondeterministic()(page)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per page."""
    return (pages.select(pages[page_id].cast("long").alias("page_id"), pages[url].cast("string").alias("url"),
                         main_text_column(whole_text(pages, page)).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
