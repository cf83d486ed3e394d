"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text (block-level elements end a block). The blocks of one root-to-leaf tag path (tags with their
classes) are aggregated: text per block, punctuation per block, and how both vary. The ratios are fused to one value per path,
lowered for paths full of links, smoothed over the neighbouring blocks of the page, and compared with a threshold derived from the page's
own values. The paths above it are content. Elements that are never article text (scripts, menus, footers and the like, by
tag) are taken out first, and so are forms and elements that a whole class, id or role names as something else, unless they
hold most of the page: then the ratio decides. The content is completed with the other blocks of its container (headings
and short paragraphs belong to an article whatever their ratio is).

Pages are independent, so the work is one pass without a shuffle.
"""

from __future__ import annotations

import html as entities
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm.tables import annotate


@dataclass(frozen=True)
class Extraction:
    """``share`` of the page's greatest fused value makes a path content; ``smooth`` is the weight of each direct neighbour;
    blocks of which links make up more than ``links`` are never content by their ratio; ``declared`` is the factor for
    blocks inside elements that are declared as content."""

    share: float = 0.3
    smooth: float = 0.25
    links: float = 0.5
    declared: float = 5.0


# Element names by role, and words in class, id or role that mark what is no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas noembed noframes title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset("head nav footer aside button select option textarea dialog menu datalist audio video".split())
FORMS = frozenset(["form", "fieldset"])
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
    "tbody": frozenset(["tr", "td", "th", "thead", "tbody"]), "body": frozenset(["head"]),
}
CLOSABLE = frozenset(["p", *(tag for tags in CLOSED_BY.values() for tag in tags)])
SCOPES = frozenset("ul ol dl table div section article main body html".split())
_NAMED = (
    r"(?:ads?|adverts?|advertisements?|advertising|banners?|sponsor(?:ed|s)?|promos?|promotions?|cookies?|consent|gdpr|"
    r"notices?|alerts?|newsletters?|subscri(?:be|ption)s?|signup|sign-up|paywall|sidebars?|side-bar|widgets?|menus?|nav|navbar|"
    r"navigation|breadcrumbs?|crumbs?|footers?|foot|masthead|site-header|page-header|topbar|toolbar|comments?|"
    r"commentlist|replies|respond|disqus|social|shar(?:e|ing)|related|recommended|recommendations?|popups?|modals?|overlay|"
    r"login|search|pagination|pager|tags?|tagcloud|skip-link|hidden|complementary|contentinfo|dialog)"
)
# Words that may stand beside those in one name: a "comment-list" is named by it, a "with-sidebar" or "nav-fixed" is not.
_BESIDE = (
    r"(?:lists?|items?|box(?:es)?|blocks?|bars?|areas?|sections?|containers?|wrap(?:per)?|inner|outer|panels?|units?|slots?|links?|"
    r"buttons?|icons?|titles?|posts?|articles?|stories|news|media|forms?|top|bottom|left|right|primary|secondary|main|site|page|"
    r"global|user|author|text|content|header|\d+)"
)
BOILERPLATE = re.compile(rf"(?:{_BESIDE}[_-]+)*{_NAMED}(?:[_-]+(?:{_NAMED}|{_BESIDE}))*", re.IGNORECASE)
CONTENT = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that hold whole articles; the page itself is the outermost one.
CONTAINERS = frozenset(["", "div", "section", "article", "main", "td"])
CONTENT_WORDS = re.compile(r"(?:^|[\s_-])(?:article(?:-?body|-?content|-?text)?|post-?(?:body|content|text)|entry-?content|story-?body|main)(?:$|[\s_-])", re.IGNORECASE)  # noqa: E501

START = re.compile(r"<(?:/?[a-zA-Z]|[!?])")
_OTHER = r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)"
_TAG = r"<(/?)([a-zA-Z][^\s/>]*+)"
PIECE = re.compile(rf"{_OTHER}|{_TAG}((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|$)", re.DOTALL)
# From a quote on that never closes, the next > ends a tag.
BROKEN = re.compile(rf"{_OTHER}|{_TAG}([^>]*)(?:>|$)", re.DOTALL)
MARKS = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
PUNCTUATION = re.compile(r"[.,;:!?…。，！？、؛،]")


@dataclass(slots=True)
class Element:
    """An open element. ``path`` numbers its tag path, ``box`` is its innermost container, ``outer`` the one around it, and
    ``doubt`` its innermost doubtful element (itself included, each). ``near`` has the depths of open elements that a start
    tag may close. ``block`` is the element whose text it holds: itself, or what is around an inline element."""

    tag: str
    path: int = 0
    number: int = 0
    dropped: bool = False
    content: int = 0
    level: int = 0
    box: int = 0
    outer: int = 0
    doubt: int = 0
    link: bool = False
    heading: bool = False
    near: dict[str, int] = field(default_factory=dict)
    block: Element | None = None


@dataclass(slots=True)
class Block:
    """Text of one block: its tag path, the number of its content element, the container around it, and its own element
    if that is a container (else -1). A part is (text, is it inside a link, the innermost doubtful element around it)."""

    path: int
    tag: str
    heading: bool
    content: int
    around: int
    holder: int
    parts: list[tuple[str, bool, int]] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@dataclass(frozen=True)
class Page:
    """Blocks of a page, and the number of the container around each container (0 is the page)."""

    blocks: list[Block]
    outer: dict[int, int]


def _summed(sizes: dict[int, int], parents: dict[int, int]) -> dict[int, int]:
    """Sizes with those of everything inside; a number is above those of the elements around it."""
    total = dict(sizes)
    for number in sorted(parents, reverse=True):
        if number in total:
            around = parents[number]
            total[around] = total.get(around, 0) + total[number]
    return total


def _main_elements(found: list[Block], doubts: dict[int, int]) -> set[int]:
    """The doubtful elements that hold most of the page: of the text of declared content, or of all text if none is declared.

    Where the page has a first-level heading, they hold it too, or nearly all of the text: long comments are no article.
    Those inside another that does not are left out.
    """
    declared = any(b.content and raw.strip() for b in found for raw, _, _ in b.parts)
    size, headed = {}, {}
    for block in found:
        for raw, _, doubt in block.parts:
            weight = len(raw.strip()) if block.content or not declared else 0
            size[doubt] = size.get(doubt, 0) + weight
            headed[doubt] = headed.get(doubt, 0) + block.heading
    size, headed = _summed(size, doubts), _summed(headed, doubts)
    total, heads = size.get(0, 0), headed.get(0, 0)
    main = {0}
    for number, around in sorted(doubts.items()):
        x = size.get(number, 0)
        if around in main and 2 * x > total and (headed[number] or not heads or 10 * x > 9 * total):
            main.add(number)
    return main


def read_page(page: str) -> Page:
    """The blocks of a page in order, without those inside elements that are never article text.

    The work grows with the page, however deep its elements are nested.
    """
    out: list[Block] = []
    root = Element("")
    root.block = root
    stack = [root]
    opened: dict[str, int] = {}
    paths: dict[tuple[int, str], int] = {}
    boxes: dict[int, int] = {}
    doubts: dict[int, int] = {}
    number, at, size = 0, 0, len(page)
    fresh = True
    piece = PIECE

    def add(raw: str) -> None:
        nonlocal fresh
        top = stack[-1]
        if top.dropped or not raw:
            return
        if fresh:
            if not raw.strip():
                return
            owner = top.block
            holder = owner.number if owner.tag in CONTAINERS else -1
            out.append(Block(owner.path, owner.tag, owner.heading, owner.content, owner.outer, holder))
            fresh = False
        out[-1].parts.append((raw, top.link, top.doubt))

    def close_to(depth: int) -> None:
        nonlocal fresh
        while len(stack) > depth:
            tag = stack.pop().tag
            opened[tag] -= 1
            fresh |= tag not in INLINE

    while at < size:
        start = START.search(page, at)
        end = start.start() if start else size
        add(page[at:end])
        if not start:
            break
        found = piece.match(page, end)
        if not found:
            piece = BROKEN
            found = piece.match(page, end)
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            if opened.get(tag):
                close_to(next(d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag))
            elif tag == "p":
                fresh = True
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in CLOSES_P or tag in CLOSED_BY:
            near = stack[-1].near
            closed = [near[t] for t in CLOSED_BY.get(tag, ("p",)) if t in near]
            if closed:
                close_to(min(closed) if tag in ("tr", "tbody", "body") else max(closed))
        if tag not in INLINE:
            fresh = True
        if tag in VOID:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(page, at)
            after = page.find(">", stop.start()) if stop else -1
            at = after + 1 if after >= 0 else size
            continue
        if found[3].rstrip().endswith("/") and tag not in INLINE and tag not in CLOSES_P:
            continue
        number += 1
        marks = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in MARKS.finditer(found[3])} if found[3] else {}
        words = " ".join(marks.values())
        named = tag in FORMS or any(BOILERPLATE.fullmatch(word) for word in words.split())
        top = stack[-1]
        # Inside a declared article everything belongs to it; inside other declared content an article is told apart.
        content, level = top.content, top.level
        if tag in CONTENT or marks.get("role", "").lower() == "main" or (words and CONTENT_WORDS.search(words)):
            own = 2 if tag == "article" else 1
            content, level = (number, own) if own > level else (content, level)
        dropped = top.dropped or (
            tag in NEVER
            or (tag == "header" and not top.content)
            or (bool(found[3]) and bool(HIDDEN.search(found[3])))
        )
        new = Element(
            tag, top.path, number, dropped, content, level, top.box, top.box, top.doubt, top.link or tag == "a",
            top.heading or tag == "h1", top.near, top.block,
        )
        if tag not in INLINE:
            label = f"{tag}.{'.'.join(sorted(marks.get('class', '').split()))}".rstrip(".")
            new.path, new.block = paths.setdefault((top.path, label), len(paths) + 1), new
        if tag in CONTAINERS:
            new.box = number
            boxes[number] = top.box
        if named and tag not in ("html", "body", "article", "main") and content != number:
            new.doubt = number
            doubts[number] = top.doubt
        if tag in SCOPES:
            new.near = {}
        elif tag in CLOSABLE:
            new.near = {**top.near, tag: len(stack)}
        opened[tag] = opened.get(tag, 0) + 1
        stack.append(new)
    decided = _main_elements(out, doubts)
    for block in out:
        parts = [(raw, link) for raw, link, doubt in block.parts if doubt in decided]
        block.text = " ".join(entities.unescape("".join(raw for raw, _ in parts)).split())
        block.linked = sum(len(raw) for raw, link in parts if link)
    return Page([b for b in out if b.text], boxes)


def _fused(found: list[Block], settings: Extraction) -> list[float]:
    """The fused tag-path ratio of every block: how long and punctuated the texts of its path are, and how much they vary."""
    lengths: dict[int, list[int]] = {}
    marks: dict[int, list[int]] = {}
    linked: dict[int, int] = {}
    for block in found:
        lengths.setdefault(block.path, []).append(len(block.text))
        marks.setdefault(block.path, []).append(len(PUNCTUATION.findall(block.text)))
        linked[block.path] = linked.get(block.path, 0) + min(block.linked, len(block.text))

    def spread(values: list[int]) -> float:
        mean = sum(values) / len(values)
        return math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))

    value = {}
    for path, sizes in lengths.items():
        total, count = sum(sizes), len(sizes)
        text, points = total / count, sum(marks[path]) / count
        varied = (1 + math.log2(1 + spread(sizes)) / 8) * (1 + math.log2(1 + spread(marks[path])) / 8) * (1 + math.log2(count) / 4)
        share = linked[path] / total
        value[path] = 0.0 if share > settings.links else text * (1 + points) * varied * (1 - share)
    raw = [value[b.path] * (settings.declared if b.content else 1.0) for b in found]
    side = settings.smooth
    return [
        (v + side * (raw[i - 1] if i else v) + side * (raw[i + 1] if i + 1 < len(raw) else v)) / (1 + 2 * side)
        for i, v in enumerate(raw)
    ]


def _beside(page: Page, picked: list[int]) -> set[int]:
    """The blocks of the innermost container that holds nine tenths of the picked text.

    Text that stands in a container directly, beside other blocks, belongs to it; an element that holds only text is a
    paragraph, whatever its tag. If the container is the page itself, containers inside it that hold nothing picked are no
    part of the article.
    """
    found = page.blocks
    inside = _summed({b.around: 1 for b in found}, page.outer)
    own = [b.holder if b.holder in inside else b.around for b in found]
    size: dict[int, int] = {}
    for i in picked:
        size[own[i]] = size.get(own[i], 0) + len(found[i].text)
    size = _summed(size, page.outer)
    container = max((n for n, x in size.items() if 10 * x >= 9 * size[0]), default=0)
    kept = {container}
    for number, around in sorted(page.outer.items()):
        if around in kept and (container or number in size):
            kept.add(number)
    return {i for i, n in enumerate(own) if n in kept}


def main_text(page: str, settings: Extraction = Extraction()) -> str:  # noqa: B008
    """The article's blocks in page order, joined by line ends; empty if there is none."""
    read = read_page(page)
    found = read.blocks
    if not found:
        return ""
    fused = _fused(found, settings)
    top = max(fused)
    if top <= 0:
        return ""
    mean = {}
    for block, value in zip(found, fused, strict=True):
        mean.setdefault(block.path, []).append(value)
    chosen = {path for path, values in mean.items() if sum(values) / len(values) >= settings.share * top}
    picked = [i for i, b in enumerate(found) if b.path in chosen]
    declared = {found[i].content for i in picked} - {0}
    if declared:  # the whole of the declared elements that hold content
        return "\n".join(b.text for b in found if b.content in declared)
    # Headings, lists and short paragraphs between content blocks, or a heading just before them, belong to the article.
    first, last = picked[0], picked[-1]
    while first and found[first - 1].tag in HEADINGS:
        first -= 1
    beside = _beside(read, picked)
    keep = set(picked) | {
        i for i, b in enumerate(found) if (first <= i <= last or i in beside) and b.linked <= settings.links * len(b.text)
    }
    return "\n".join(found[i].text for i in sorted(keep))


def extracted(pages: DataFrame, settings: Extraction = Extraction(), keep: list[str] | None = None) -> DataFrame:  # noqa: B008
    """``pages`` as column ``row`` and the main text of every whole html as ``found.text``.

    NULL and empty pages and pages without content give the empty text. Pages are read as they come: unclosed elements,
    stray end tags and pages that break off are no errors. Rows are independent; extra columns stay in ``row``.
    """

    def read(column: pa.Array) -> list[pa.Array]:
        return [pa.array([main_text(page.as_py() or "", settings) for page in column], pa.large_string())]

    return annotate(pages, read, "text string", "html", keep)


def texts(pages: DataFrame, settings: Extraction = Extraction()) -> DataFrame:  # noqa: B008
    """(page_id, url, text, n_chars) of every row of ``pages``; see ``extracted``."""
    found = extracted(pages.select("page_id", "url", "html"), settings, ["page_id", "url"])
    return found.select("row.page_id", "row.url", "found.text", F.length("found.text").cast("long").alias("n_chars"))
