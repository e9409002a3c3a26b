"""Main text of HTML pages by two-pass block rules.

The page is cut into blocks at block-level tags. First pass: a block gets a label from what surrounds it (a menu, an advert,
comments: bad; an article or main element: good; a name that may be either, as related or legal: bad as long as no block in it is
good by its numbers) or else from its own numbers: a high share of link text is bad, a long
block with many stop words is good, a long one without is bad; a short one is undecided. Where no list of stop words fits (another
script, or a page whose prose hardly has one), length and links alone decide. Second pass: undecided blocks inherit
from the nearest decided neighbours in page order, before and after; where these differ, the nearer one decides, and at
equal distance the block is good only if it is a heading or nearly has the stop words of a good block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINKS = 0.33
SHORT = 70
LONG = 200
STOP_LOW, STOP_HIGH = 0.10, 0.20
LISTED_WORDS, LISTED_SHARE = 40, 0.04

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset((
    "the of and to in a is that it for on was with as by be at are this from or an not have which but they you his her had were we been has will "
    "le la les de des du et en un une que qui dans pour par sur est pas au aux avec il elle ne se ce son plus ou "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "el los las del y que en un una por con no se su para es al lo como más o pero sus le ha me si sin sobre este ya"
).split())

#: Their content is text up to their end tag, or to the end of the page.
RAW_TAGS = frozenset("script style textarea title".split())
#: Dropped with what is in them, if they have an end tag.
DROPPED_TAGS = frozenset("noscript template select svg iframe object canvas button datalist audio video".split())
#: Of those the ones that hold none of their own kind: a second one shows that the first was left open.
FLAT_TAGS = frozenset("noscript select iframe button".split())
BLOCK_TAGS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul"
).split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LOOSE_TAGS = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())       # often left open
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BAD_TAGS = frozenset("nav aside footer form menu dialog fieldset".split())
#: Words in class, id and role that mark boilerplate beyond doubt.
BAD_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted cookie cookies consent gdpr "
    "popup modal overlay newsletter subscribe subscription signup login sidebar nav navbar navigation breadcrumb breadcrumbs pagination pager "
    "masthead footer tagcloud complementary contentinfo"
).split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus".split())
#: Words that parts of an article hold as well. A prior only: a long block with many stop words and few links overrides it.
WEAK_WORDS = frozenset((
    "promotion notice notices alert alerts rail widget widgets related recommended recommendations share sharing social follow menu copyright legal "
    "disclaimer form search toolbar skip dialog reply replies respond feedback discussion"
).split())
HEADER_WORDS = frozenset("header topbar".split())
#: Not kept in order with other elements.
INLINE_TAGS = frozenset("a b i em strong u s small big code font nobr tt strike".split())
_PREFIXES = frozenset("has with no is js without".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/<>]*+)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|<(/?)([a-zA-Z][^\s/<>]*+)([^>]*)(?:>|\Z)""",
    re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in (*RAW_TAGS, "svg")}
_TITLE = re.compile(r"<title(?=[\s/>])[^>]*>(.*?)(?:</title(?=[\s/>])[^>]*>?)?\Z", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_HIDES = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^a-zA-Z]+")
_WORD = re.compile(r"\w+")

GOOD, BAD, OPEN = 1, -1, 0


def _attributes(raw: str) -> dict[str, str]:
    """Values by name in lower case, of a repeated name the first; empty for a bare one."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return out


def _hidden(values: dict[str, str]) -> bool:
    style = dict(_HIDES.findall(re.sub(r"/\*.*?\*/", " ", values["style"].lower(), flags=re.S))) if "style" in values else {}
    return ("hidden" in values or values.get("aria-hidden", "").strip().lower() == "true"
            or style.get("display") == "none" or style.get("visibility") == "hidden")


def _names(text: str) -> list[str]:
    """Words of an id or heading, without numbers before and after them."""
    out = re.findall(r"[^\W_]+", text.lower())
    while out and out[-1].isdigit():
        out.pop()
    while out and out[0].isdigit():
        del out[0]
    return out


def _no_heading() -> tuple[str, bool]:
    return "", False


def _kind(tag: str, attributes: str, inside: bool, heading: Callable[[], tuple[str, bool]] = _no_heading) -> str:
    """What an element says about its content: ``article``, ``comment``, ``bad``, ``weak`` or nothing.

    ``heading``: text of the heading that the element begins with or (true) belongs to. An id made from it says nothing, but
    comments and menus may well have a heading with their name.
    """
    values = _attributes(attributes)
    words: set[str] = set()
    for key in ("class", "role", "id"):
        found: set[str] = set()
        for name in values.get(key, "").split():
            parts = [x.lower() for x in _CAMEL.split(name) if x]
            if parts and parts[0] not in _PREFIXES:
                found.update(parts)
        if key == "id" and found & (COMMENT_WORDS | BAD_WORDS | WEAK_WORDS):
            text, own = heading()
            name, title = _names(values[key]), _names(text)
            if title and (title[:len(name)] == name if own else title == name and not found & (COMMENT_WORDS | BAD_WORDS)):
                continue
        words |= found
    if words & COMMENT_WORDS:
        return "comment"
    if tag in BAD_TAGS or words & BAD_WORDS or _hidden(values):
        return "bad"
    if (tag == "header" or words & HEADER_WORDS) and not inside:
        return "bad"
    if words & WEAK_WORDS and tag != "main":
        return "weak"
    return "article" if tag in ("article", "main") or "main" in words and tag != "body" else ""


class _Blocks:
    """Collects blocks: text, characters in links, label by surroundings, heading or not."""

    def __init__(self) -> None:
        self.found: list[tuple[str, int, int, bool]] = []
        self.parts: list[str] = []
        self.linked = self.in_link = self.breaks = 0
        self.stack: list[tuple[str, str]] = []
        self.kinds: Counter[str] = Counter()                 # of the stack, so that depth costs nothing
        self.tags: Counter[str] = Counter()
        self.weak: list[int] = []
        self.heading = False
        self.last_weak = GOOD

    def label(self) -> int:
        """Above ``GOOD``: the number of the innermost element with a weak word."""
        if self.kinds["bad"] or self.kinds["comment"]:
            return BAD
        if self.weak:
            return self.weak[-1]
        return GOOD if self.kinds["article"] else OPEN

    def push(self, tag: str, kind: str) -> None:
        self.stack.append((tag, kind))
        self.tags[tag] += 1
        self.kinds[kind] += 1
        if kind == "weak":
            self.last_weak += 1
            self.weak.append(self.last_weak)

    def pop(self) -> str:
        tag, kind = self.stack.pop()
        self.tags[tag] -= 1
        self.kinds[kind] -= 1
        if kind == "weak":
            self.weak.pop()
        return tag

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.in_link:
                self.linked += len(raw.strip())
            if self.breaks and not raw.isspace():
                self.breaks = 0

    def end(self) -> None:
        if self.parts:
            words = html.unescape("".join(self.parts)).split()
            if words:
                text = " ".join(words)
                self.found.append((text, self.linked, self.label(), self.heading))
        self.parts, self.linked, self.breaks, self.heading = [], 0, 0, False

    def open(self, tag: str, attributes: str, heading: Callable[[], tuple[str, bool]]) -> None:
        if tag == "br":
            self.breaks += 1
            if self.breaks > 1:
                self.end()
            self.parts.append(" ")
        elif tag == "a":
            self.in_link = 1
        elif tag in BLOCK_TAGS:
            self.end()
            self.heading = tag in HEADINGS
            if tag in VOID_TAGS or tag in ("html", "body"):
                return
            kind = _kind(tag, attributes, bool(self.kinds["article"] or self.tags["article"]), heading)
            if kind == "article" and not self.kinds["comment"]:
                self.in_link = 0
                if self.kinds["bad"] or self.kinds["weak"]:      # an article in a menu or advert: that one was left open
                    self.stack = [x for x in self.stack if x[1] not in ("bad", "weak")]
                    self.tags, self.kinds = (Counter(x[i] for x in self.stack) for i in (0, 1))
                    self.weak = []
            if kind or tag not in LOOSE_TAGS:
                self.push(tag, kind)
        elif attributes and tag not in VOID_TAGS:
            kind = _kind(tag, attributes, True, heading)
            if kind in ("bad", "comment", "weak"):
                self.end()
                self.push(tag, "weak" if kind == "weak" else "bad")

    def close(self, tag: str) -> None:
        if tag == "a":
            self.in_link = 0
            return
        if tag in BLOCK_TAGS:
            self.end()
            if tag not in LOOSE_TAGS:
                self.in_link = 0
        if self.tags[tag]:
            if tag not in BLOCK_TAGS:
                self.end()
            while self.pop() != tag:
                pass


def _tokens(page: str) -> list[tuple[int, int, str, bool, str]]:
    """Start, end, tag (empty: dropped text), end tag or not, attributes. Raw text belongs to its tag's token."""
    out: list[tuple[int, int, str, bool, str]] = []
    at, drawings, endless = 0, 0, False
    while m := _TOKEN.search(page, at):
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag == "svg":
            drawings = max(0, drawings - 1) if closing else drawings + (not attributes.endswith("/"))
        elif tag in RAW_TAGS and not closing and not (drawings and attributes.endswith("/")):
            edge = _RAW_END["svg"].search(page, at) if drawings and not endless else None
            endless = endless or bool(drawings) and not edge
            end = _RAW_END[tag].search(page, at, edge.start() if edge else len(page))
            stop = end.end() if end else at if edge else len(page)      # in a drawing only up to its end
            out.append((m.start(), stop, "", False, ""))
            at = stop
            continue
        out.append((m.start(), at, tag, closing, attributes))
    return out


def _ends(tokens: list[tuple[int, int, str, bool, str]]) -> dict[int, int]:
    """For elements of ``DROPPED_TAGS`` the index of their end tag; none for those that were left open."""
    out: dict[int, int] = {}
    if not any(x[2] in DROPPED_TAGS for x in tokens):
        return out
    stack: list[tuple[str, int]] = []
    held: Counter[str] = Counter()
    flat: dict[str, int] = {}
    left: set[int] = set()
    for i, (_, _, tag, closing, attributes) in enumerate(tokens):
        if not tag or tag in VOID_TAGS or tag in LOOSE_TAGS or tag in INLINE_TAGS:
            continue
        if closing:
            if held[tag]:
                while True:
                    name, at = stack.pop()
                    if at in left:
                        continue
                    held[name] -= 1
                    if name == tag:
                        break
                if tag in DROPPED_TAGS:
                    out[at] = i
        elif not (attributes.endswith("/") and (tag == "svg" or held["svg"])):
            if tag in FLAT_TAGS and held[tag]:
                left.add(flat[tag])
                held[tag] -= 1
            flat[tag] = i
            stack.append((tag, i))
            held[tag] += 1
    return out


class _Headings:
    """Text of the heading that an element begins with or belongs to; looked for when an id asks for it."""

    def __init__(self, page: str, tokens: list[tuple[int, int, str, bool, str]]) -> None:
        self.page, self.tokens, self.first, self.texts = page, tokens, [], {}

    def begins(self, i: int) -> int:
        """The heading before whose end no other text stands, or -1."""
        if not self.first:
            self.first = [-1] * (len(self.tokens) + 1)
            for k in range(len(self.tokens) - 1, -1, -1):
                _, end, tag, closing, _ = self.tokens[k]
                if tag in HEADINGS:
                    self.first[k] = -1 if closing else k
                elif k + 1 < len(self.tokens) and not self.page[end:self.tokens[k + 1][0]].strip():
                    self.first[k] = self.first[k + 1]
        return self.first[i]

    def text(self, at: int) -> str:
        if at < 0:
            return ""
        if at not in self.texts:
            parts, k = [], at
            while k + 1 < len(self.tokens) and not (k > at and self.tokens[k][2] in HEADINGS):
                parts.append(self.page[self.tokens[k][1]:self.tokens[k + 1][0]])
                k += 1
            self.texts[at] = html.unescape("".join(parts))
        return self.texts[at]


def blocks(page: str) -> list[tuple[str, int, int, bool]]:
    out, at, dropped, title = _Blocks(), 0, -1, -1
    tokens = _tokens(page)
    ends = _ends(tokens)
    headings = _Headings(page, tokens)
    for i, (start, end, tag, closing, attributes) in enumerate(tokens):
        if i <= dropped:
            at = end
            continue
        out.text(page[at:start])
        at = end
        if tag in BLOCK_TAGS:
            title = i if tag in HEADINGS and not closing else -1
        if not tag or tag in DROPPED_TAGS:
            dropped = ends.get(i, dropped)
            out.text(" ")
        elif closing:
            out.close(tag)
        else:
            before = len(out.stack)
            own = title >= 0
            out.open(tag, attributes, lambda at=title if own else i, own=own: (headings.text(at if own else headings.begins(at)), own))
            if attributes.endswith("/") and len(out.stack) > before and tag not in BLOCK_TAGS:
                out.pop()
    out.text(page[at:])
    out.end()
    return out.found


def _latin(words: list[str]) -> bool:
    """Are at least half of the words in the script that the stop words are written in?"""
    return 2 * sum("a" <= w[0] <= "z" or "\u00c0" <= w[0] <= "\u024f" for w in words) >= len(words)


def _listed(found: list[tuple[str, int, int, bool]]) -> bool:
    """Is the page's undecided prose in a language with stop words? False only if it has enough words and hardly one of them."""
    words = [w for text, linked, around, _ in found if around not in (BAD, GOOD) and len(text) >= SHORT and linked <= LINKS * len(text)
             for w in _WORD.findall(text.lower())]
    return len(words) < LISTED_WORDS or sum(w in STOP_WORDS for w in words) >= LISTED_SHARE * len(words)


def labels(found: list[tuple[str, int, int, bool]]) -> list[int]:
    """Final label of each block."""
    first, nearly, listed = [], [], _listed(found)
    for text, linked, around, _ in found:
        words = _WORD.findall(text.lower()) if around not in (BAD, GOOD) else ()
        stop = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
        links = linked / len(text)
        nearly.append(stop >= STOP_HIGH)
        if around == BAD:
            first.append(BAD)
        elif around == GOOD:
            first.append(GOOD)
        elif links > LINKS:
            first.append(BAD)
        elif len(text) < SHORT:
            first.append(BAD if linked else OPEN)
        elif not listed or not _latin(words):
            first.append(GOOD if len(text) > LONG else OPEN)      # no list for this language: length and links decide
        elif stop >= STOP_HIGH:
            first.append(GOOD if len(text) > LONG else OPEN)
        else:
            first.append(OPEN if stop >= STOP_LOW else BAD)
    prose = {b[2] for b, x in zip(found, first, strict=True) if x == GOOD}
    first = [BAD if b[2] > GOOD and b[2] not in prose else x for b, x in zip(found, first, strict=True)]
    before, after, last = [], [], None
    for i, x in enumerate(first):
        last = i if x else last
        before.append(last)
    last = None
    for i in range(len(first) - 1, -1, -1):
        last = i if first[i] else last
        after.append(last)
    after.reverse()
    out = []
    for i, x in enumerate(first):
        if x == OPEN:
            p, n = before[i], after[i]
            ends = {first[k] for k in (p, n) if k is not None}
            if len(ends) == 1:
                x = ends.pop()
            elif len(ends) == 2 and i - p != n - i:
                x = first[p] if i - p < n - i else first[n]
            else:
                x = GOOD if nearly[i] or found[i][3] and (n is None or first[n] == GOOD) else BAD
        out.append(x)
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(b[0] for b, label in zip(found, labels(found), strict=True) if label == GOOD)


def whole_text(page: str | None) -> str:
    """Title and text of all elements that show text, boilerplate included."""
    page = page or ""
    tokens = _tokens(page)
    ends = _ends(tokens)
    parts, at, dropped = [], 0, -1
    for i, (start, end, tag, _, _) in enumerate(tokens):
        if i > dropped:
            parts.append(page[at:start])
            if not tag:
                title = _TITLE.match(page, start, end)
                parts.append(f" {title[1]} " if title else " ")
            elif tag in BLOCK_TAGS or tag in DROPPED_TAGS or tag == "br":
                parts.append(" ")
            dropped = ends.get(i, dropped)
        at = end
    parts.append(page[at:])
    return html.unescape("".join(parts))


def whole_texts(pages: DataFrame, *, page: str = "html", name: str = "text") -> DataFrame:
    """Only ``name``: the whole text of each page."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                texts = [whole_text(x.as_py()).encode("utf-8", "replace").decode() for x in batch.column(0).slice(at, 500)]
                yield pa.RecordBatch.from_arrays([pa.array(texts, type=pa.string())], names=[name])

    return pages.select(F.col(page).cast("string")).mapInArrow(run, T.StructType([T.StructField(name, T.StringType())]))


def with_main_text(pages: DataFrame, *, page: str = "html", name: str = "text") -> DataFrame:
    """All columns and ``name``, the main text; empty for a null, empty or text-free page. An older ``name`` is replaced."""
    pages = pages.drop(name)
    schema = T.StructType([*pages.schema.fields, T.StructField(name, T.StringType())])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(page))
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(x.as_py()).encode("utf-8", "replace").decode() for x in column.slice(at, 500)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, type=pa.string())], names=[*batch.schema.names, name])

    return pages.withColumn(page, F.col(page).cast("string")).mapInArrow(run, schema)
