"""Main text of web pages by two passes of block rules.

Pass 1 cuts a page into blocks and classifies each: blocks inside furniture (menus, forms, adverts, ...) or full of links are
bad; long blocks rich in stop words are good; long blocks with few stop words are bad, unless they stand inside an article
element; the rest is undecided. Pass 2 gives each undecided block the label of its nearest decided neighbour in the same
container: the same if both sides agree, else that of the nearer side; inside an article element without any decided block
they are good, elsewhere bad.

A page whose text hardly holds a word of the lists is in another language; there length and link density decide alone.

Furniture is known by its element or hidden for certain, or only by a name in its class, id or role. An article or main
element begins afresh inside a named wrapper, unless its own name says furniture too or it stands in another article. What a class says a page has or lacks
(has-sidebar) names nothing. If names leave a page without a good block, it is read again without them.

Nothing shuffles: each page is handled where it is read, in time proportional to its length however broken it is: a character is
looked at for the end of a tag only once.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of the four languages.
STOP_WORDS = {
    "en": "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their there they this to was we were which will with you",
    "de": "als am an auch auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht oder sich sie sind so und von war wie zu zum",
    "fr": "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour qu que qui sa se ses son sont sur un une vous",
    "es": "al como con de del el ella en es esta este ha la las le lo los más me no o para pero por que se si sin sobre son su sus un una y ya",
}
_STOP = frozenset(w for words in STOP_WORDS.values() for w in words.split())

# Fixed values of the rules.
SHORT = 70
LONG = 200
STOP_LOW = 0.15
STOP_HIGH = 0.30
LINKS_HIGH = 0.33
#: Share of listed words under which a page is in no listed language.
KNOWN_LANGUAGE = 0.05

GOOD, BAD, UNDECIDED = "good", "bad", "undecided"

# Fixed values of HTML: elements whose content is no text, elements that begin a block, elements that are furniture.
RAW = "script style noscript template iframe object svg math canvas video audio map textarea select datalist head title".split()
BLOCK = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul"
).split()
FURNITURE = "nav aside footer form menu dialog button fieldset".split()
MAIN = "article main".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
_RAW, _BLOCK, _FURNITURE, _MAIN, _VOID = map(frozenset, (RAW, BLOCK, FURNITURE, MAIN, VOID))
# elements that end their open sibling of the same kind
_SIBLING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# Words in class, id or role that name furniture.
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|widget\w*|footer|foot|header|masthead|topbar|"
    r"cookies?|consent|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|related|recommended|comments?|commentlist|disqus|respond|replies|reply|"
    r"pagination|pager|toolbar|copyright|disclaimer|complementary|contentinfo|dialog|hidden)(?:$|[\s_-])"
)
# Tokens that say what a page has or lacks, or what stands beside its content, and name nothing.
_STATES = re.compile(r"(?:^|(?<=\s))(?:(?:has|no|with|without)[_-]\S*|content[_-](?:with[_-])?(?:sidebar|menu|nav)(?:[_-]\S*)?(?=\s|$))")
_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>\"'<]*")
_DELIMITER = re.compile("[\"'>]")
_IDEOGRAPHS = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none""", re.I)
_WORD = re.compile(r"[^\W\d_]+")


class _Block:
    __slots__ = ("text", "linked", "certain", "furniture", "main", "label")

    def __init__(self, text: str, linked: int, certain: bool, named: bool, main: int):
        self.text, self.linked, self.certain, self.furniture, self.main, self.label = text, linked, certain, certain or named, main, UNDECIDED


def tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(begin, end, closing, name, attributes) of the tags of a page; comments and declarations have an empty name.

    A tag ends at the first ``>`` outside quotes. A quote that is never closed is an ordinary character, and once a tag is not
    closed outside quotes up to the end of the page, quotes hide nothing any more. The caller may ``send`` where to go on.
    """
    at, size = 0, len(page)
    unclosed = {'"': False, "'": False}
    quoted = True
    while True:
        begin = page.find("<", at)
        if begin < 0 or begin + 1 >= size:
            return
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = size if end < 0 else end + 3
            yield begin, at, False, "", ""
            continue
        closing = page[begin + 1] == "/"
        declared = page[begin + 1] in "!?"
        name = None if declared else _TAG_NAME.match(page, begin + 1 + closing)
        if name is None and not declared:
            at = begin + 1
            continue
        inside = name.end() if name else begin + 2
        end, look = -1, inside
        while quoted and not declared:
            mark = _DELIMITER.search(page, look)
            if mark is None:
                quoted = False
            elif mark[0] == ">":
                end = mark.start()
                break
            else:
                close = -1 if unclosed[mark[0]] else page.find(mark[0], mark.end())
                unclosed[mark[0]] = close < 0
                look = mark.end() if close < 0 else close + 1
        if end < 0:
            end = page.find(">", inside)
        if end < 0:
            return
        at = end + 1
        sent = yield begin, at, closing, name[0].lower() if name else "", page[inside:end] if name else ""
        if sent is not None:
            at = sent
            yield begin, at, False, "", ""


class _Open:
    """An open element: its place, and the inline elements in it that are not kept, by name."""

    __slots__ = ("name", "place", "inline")

    def __init__(self, name: str, place: tuple[bool, bool, int, bool]):
        self.name, self.place, self.inline = name, place, {}


def page_blocks(page: str) -> list[_Block]:
    """Text blocks in page order, each with its linked characters and its place."""
    blocks: list[_Block] = []
    # place: inside certain furniture, inside furniture by name, number of the article or main element or 0, inside an article
    outside = (False, False, 0, False)
    root = _Open("", outside)
    open_elements: list[_Open] = []
    names: dict[str, int] = {}
    pieces: list[str] = []
    linked, link_depth, articles = 0, 0, 0
    certain, named, main, _ = outside

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append(_Block(text, linked, certain, named, main))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if link_depth:
                linked += len("".join(text.split()))

    def close(name: str) -> None:
        while True:
            last = open_elements.pop()
            names[last.name] -= 1
            if last.name == name:
                return

    at, found = 0, tags(page)
    for begin, end, closing, name, attributes in found:
        add(page[at:begin])
        at = end
        if not name:
            continue
        if name in _RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                # the head may lack its end tag
                stop = re.compile(rf"</{name}\b[^>]*>" + (r"|(?=<body\b)" if name == "head" else ""), re.I).search(page, at)
                at = stop.end() if stop else len(page)
                found.send(at)
            continue
        if name == "a":
            link_depth = 0 if closing else 1
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name not in _BLOCK and name not in _FURNITURE:
            top = open_elements[-1] if open_elements else root
            if closing:
                if top.inline.get(name):
                    top.inline[name] -= 1
                elif names.get(name):
                    flush()
                    close(name)
                    certain, named, main, _ = open_elements[-1].place if open_elements else outside
                continue
            if name in _VOID:
                continue
            if not (_furniture(attributes) or _HIDDEN.search(attributes)):
                if not attributes.endswith("/"):
                    top.inline[name] = top.inline.get(name, 0) + 1
                continue
        flush()
        if closing:
            if names.get(name):
                close(name)
        else:
            if open_elements and name in _SIBLING and open_elements[-1].name in _SIBLING[name]:
                close(open_elements[-1].name)
            if name not in _VOID:
                inside, inside_named, number, article = open_elements[-1].place if open_elements else outside
                own_name = name not in ("html", "body") and _furniture(attributes)
                if name in _MAIN:
                    # what stands by name inside an article stays furniture
                    inside_named = inside_named and (own_name or article)
                    article = article or name == "article"
                    if not number:
                        articles += 1
                        number = articles
                else:
                    inside_named = inside_named or own_name
                is_furniture = inside or name in _FURNITURE or bool(_HIDDEN.search(attributes)) or (name == "header" and not number)
                open_elements.append(_Open(name, (is_furniture, inside_named, number, article)))
                names[name] = names.get(name, 0) + 1
        certain, named, main, _ = open_elements[-1].place if open_elements else outside
    add(page[at:])
    flush()
    return blocks


def _furniture(attributes: str) -> bool:
    return any(_NAMES.search(_STATES.sub(" ", value.strip("\"'").lower())) for value in _NAMED.findall(attributes))


def _listed(text: str) -> tuple[int, int]:
    """Listed words and words of a text."""
    words = _WORD.findall(text.lower())
    return sum(w in _STOP for w in words), len(words)


def classify(blocks: list[_Block]) -> None:
    """First pass."""
    counts = [(0, 0) if b.furniture else _listed(b.text) for b in blocks]
    # an ideograph says about as much as three letters
    sizes = [len(b.text) + 2 * len(_IDEOGRAPHS.findall(b.text)) for b in blocks]
    text = sum(n for n, b in zip(sizes, blocks) if not b.furniture)
    known = text < LONG or sum(c for c, _ in counts) >= KNOWN_LANGUAGE * sum(n for _, n in counts)
    for block, (listed, n), size in zip(blocks, counts, sizes):
        if block.furniture:
            block.label = BAD
        elif block.linked > LINKS_HIGH * size:
            block.label = UNDECIDED if block.main and block.linked < size // 2 else BAD
        elif size < SHORT:
            block.label = UNDECIDED
        else:
            share = listed / n if n else 0.0
            if not known:
                block.label = GOOD if size >= LONG else UNDECIDED
            elif share >= STOP_HIGH or (share >= STOP_LOW and size >= LONG):
                block.label = GOOD
            elif share < STOP_LOW and not block.main:
                block.label = BAD
            else:
                block.label = UNDECIDED


def inherit(blocks: list[_Block]) -> None:
    """Second pass: nearest decided neighbours, counted in blocks of the same container; furniture does not count inside an
    article element."""
    containers: dict[int, list[_Block]] = {}
    for block in blocks:
        if not (block.main and block.furniture):
            containers.setdefault(block.main, []).append(block)
    for number, own in containers.items():
        before: list[tuple[int, str] | None] = []
        last: tuple[int, str] | None = None
        for i, block in enumerate(own):
            before.append(last)
            if block.label != UNDECIDED:
                last = (i, block.label)
        following: tuple[int, str] | None = None
        new = []
        for i in range(len(own) - 1, -1, -1):
            if own[i].label != UNDECIDED:
                following = (i, own[i].label)
                continue
            sides = [(abs(i - s[0]), s[1]) for s in (before[i], following) if s]
            if sides:
                nearest = min(d for d, _ in sides)
                label = GOOD if any(d == nearest and s == GOOD for d, s in sides) else BAD
            else:
                label = GOOD if number else BAD
            new.append((own[i], label))
        for block, label in new:
            block.label = label


def main_text(page: str) -> str:
    blocks = page_blocks(page)
    classify(blocks)
    inherit(blocks)
    if not any(b.label == GOOD for b in blocks) and any(b.furniture and not b.certain for b in blocks):
        for block in blocks:
            block.furniture, block.label = block.certain, UNDECIDED
        classify(blocks)
        inherit(blocks)
    return "\n\n".join(b.text for b in blocks if b.label == GOOD)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text and n_chars (code points) of every row.

    Null, empty and text-free pages give the empty text; a null id or url stays null; repeated rows are each extracted; other
    columns are not read; an empty table gives an empty result. Pages are read whole, however broken their markup.
    """

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype=object)

    out = pages.select(F.col(id_col), F.col(url_col), extract(F.coalesce(F.col(html_col).cast("string"), F.lit(""))).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
