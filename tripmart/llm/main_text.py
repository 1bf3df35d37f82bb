"""Main text of web pages by tree scoring.

A page becomes a tree.  Every run of text between block boundaries is a
paragraph; it passes points for its length and its commas to its container,
half of them to the container above, a quarter to the next and so on.  A
container's points are discounted by its link density, the share of its text
that lies in links.  The best container and those siblings of it that read like
text are kept: siblings with a fair share of its points, and headings,
paragraphs, lists, tables, quotes and figures that aren't made of links.  If
the best container lies in an ``article`` (else a ``main``), that is kept
whole instead, so that no section of an article is lost.

Menus, page headers and footers, asides, forms, scripts, styles and hidden
parts go by tag, role or attribute; adverts, notices, sidebars, share bars and
reader comments by the words of their class and id.  Everything else that the
kept containers hold is returned, whole.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.common import text_slices

# Tags of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp svg math title textarea select".split())
#: Of these, the ones whose content reaches to the page's end if nothing closes them.
TO_THE_END = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody "
    "td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body caption head html legend tbody td tfoot th thead tr".split())
SIBLING_ENDS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
                "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)),
                "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",))}
JUNK_TAGS = frozenset("head nav aside footer form button dialog menu search label fieldset object audio video canvas".split())
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
TEXT_SIBLINGS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure".split())
#: Class and id words of parts that are never main text.
JUNK_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted banner cookie cookies consent "
    "gdpr newsletter subscribe subscription signup login popup modal overlay comment comments commentlist disqus replies reply "
    "respond sidebar sidebars breadcrumb breadcrumbs nav navbar navigation menu menus share sharing social related recommended "
    "pagination pager toolbar masthead widget widgets outbrain taboola skip copyright".split())
#: Words of such parts that also name parts of articles.
WEAK_WORDS = frozenset("header footer notice notices notification alert side top bottom meta legal disclaimer".split())
ARTICLE_WORDS = frozenset("article post entry story content body main text page".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|</(?![a-zA-Z])[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w=-])", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_COMMAS = re.compile("[,،、，]")
_CASES = re.compile(r"\s(?:class|id|role|hidden|aria-hidden|style)\b", re.I)
#: Share of the best container's points from which a sibling container is kept.
SIBLING_SHARE = 0.2
#: Link density from which a part counts as a list of links.
MOST_LINKS = 0.5


class _Node:
    __slots__ = ("tag", "parent", "within", "parts", "junk", "points", "flow", "chars", "linked", "score", "block")

    def __init__(self, tag: str, parent: "_Node | None", junk: bool, block: bool):
        self.tag, self.parent, self.junk, self.block = tag, parent, junk, block
        #: The nearest block around it.
        self.within = parent if parent is None or parent.block else parent.within
        self.parts: list = []
        self.points = self.flow = self.score = 0.0
        self.chars = self.linked = 0


def _is_junk(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is no part of the main text, by its tag and attributes."""
    if tag in JUNK_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or not _CASES.search(attributes) or tag in ("html", "body", "main"):
        return False
    values = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), a or b or c)
    if values.get("role", "").lower() in JUNK_ROLES or values.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in values.get("style", "").replace(" ", "").lower() or _HIDDEN.search(_ATTRIBUTE.sub("", attributes)):
        return True
    words = {w.lower() for w in _WORD.findall(values.get("class", "") + " " + values.get("id", ""))}
    if words & JUNK_WORDS:
        return True
    return bool(words & WEAK_WORDS) and not in_article and not words & ARTICLE_WORDS


def _tree(page: str) -> _Node:
    """The page's elements and texts; a tag without an end is closed by its parents."""
    root = _Node("html", None, False, True)
    stack, places, blocks = [root], {"html": [0]}, [0]
    in_article = 0
    unclosed: set[str] = set()

    def pop_to(depth: int) -> None:
        nonlocal in_article
        while len(stack) > depth:
            node = stack.pop()
            places[node.tag].pop()
            if node.block:
                blocks.pop()
            in_article -= node.tag in ("article", "main")

    def top(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        if start < 0:
            stack[-1].parts.append(page[at:])
            break
        found = _TOKEN.match(page, start)
        if found is None:
            # Not a whole tag: a lone "<" is text, an unfinished tag ends at the next ">" or the end.
            found = _LOOSE.match(page, start)
            if found is None:
                stack[-1].parts.append(page[at:start + 1])
                at = start + 1
                continue
        if start > at:
            stack[-1].parts.append(page[at:start])
        at = found.end()
        tag = found.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if found.group(1):
            place = top((tag,))
            # An inline end tag does not reach beyond its block.
            if place > 0 and (tag in BLOCKS or place > blocks[-1]):
                pop_to(place)
            continue
        if tag in RAW:
            close = None if tag in unclosed else re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if close:
                at = close.end()
            elif tag in TO_THE_END:
                break
            else:
                unclosed.add(tag)
            continue
        if tag not in VOID and places.get("head"):
            pop_to(places["head"][-1])
        if tag in ("html", "body"):
            continue
        if tag == "br":
            stack[-1].parts.append(BREAK)
            continue
        block = tag in BLOCKS
        if tag in CLOSES_P and places.get("p") and places["p"][-1] > top(("td", "th", "caption", "button")):
            pop_to(places["p"][-1])
        if tag in SIBLING_ENDS:
            ends, within = SIBLING_ENDS[tag]
            place = top(ends)
            if place > top(within):
                pop_to(place)
        if tag in VOID:
            if block:
                stack[-1].parts.append(_Node(tag, stack[-1], False, True))
            continue
        if tag == "a" and places.get("a") and places["a"][-1] > blocks[-1]:
            pop_to(places["a"][-1])
        parent = stack[-1]
        node = _Node(tag, parent, parent.junk or _is_junk(tag, found.group(3), in_article > 0), block)
        parent.parts.append(node)
        if block:
            blocks.append(len(stack))
        places.setdefault(tag, []).append(len(stack))
        stack.append(node)
        in_article += tag in ("article", "main")
    return root


#: A line break: white space, or a paragraph's end if another follows.
BREAK = object()


def _paragraphs(root: _Node) -> list[tuple[_Node, str, int]]:
    """(container, text, its characters in links but for blanks) of every run
    of text between block boundaries in page order, without junk."""
    found: list[tuple[_Node, str, int]] = []
    pieces: list[str] = []
    linked, broken = 0, False
    owner = root

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split()) if pieces else ""
        if text:
            found.append((owner, text, linked))
        pieces.clear()
        linked = 0

    # (node, next part, links around it): a loop, as pages may nest deeper than Python's stack.
    walk = [(root, iter(root.parts), 0)]
    while walk:
        node, parts, links = walk[-1]
        part = next(parts, None)
        if part is None:
            walk.pop()
            if node.block:
                flush()
                broken = False
                owner = node.within or root
        elif part is BREAK:
            if broken:
                flush()
            else:
                pieces.append(" ")
            broken = True
        elif isinstance(part, str):
            text = _html.unescape(part)
            if not text.isspace():
                broken = False
            pieces.append(text)
            if links:
                linked += len("".join(text.split()))
        elif not part.junk:
            if part.block:
                flush()
                owner, broken = part, False
            walk.append((part, iter(part.parts), links + (part.tag == "a")))
        elif part.block:
            flush()
    flush()
    return found


#: Elements that are a paragraph by themselves; others hold bare text.
PARAGRAPHS = frozenset("p pre li dd dt blockquote td th figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _score(root: _Node, found: list[tuple[_Node, str, int]]) -> list[_Node]:
    """Fill in points and link counts; the containers, children before parents."""
    for node, text, linked in found:
        chars = len(text) - text.count(" ")
        node.chars += chars
        node.linked += linked
        # A text in links recommends nothing.
        worth = (len(_COMMAS.findall(text)) + len(text) / 100 + (len(text) >= 25)) * (1 - linked / chars)
        if node.tag not in HEADINGS:
            (node.within if node.tag in PARAGRAPHS else node).points += worth
    order, walk = [], [root]
    while walk:
        node = walk.pop()
        order.append(node)
        walk.extend(p for p in node.parts if isinstance(p, _Node) and not p.junk)
    order.reverse()
    for node in order:
        node.flow += node.points
        parent = node.parent
        if parent is not None:
            parent.chars += node.chars
            parent.linked += node.linked
            # Inline elements pass on all of it, blocks half.
            parent.flow += node.flow / 2 if node.block else node.flow
        if node.block and node.chars:
            node.score = node.flow * (1 - node.linked / node.chars)
    return order


def main_text(page: str | None) -> str:
    """The blocks of the main text joined by line ends (no text: empty)."""
    if not page:
        return ""
    root = _tree(page)
    found = _paragraphs(root)
    order = _score(root, found)
    best = None
    for node in reversed(order):
        if node.score > 0 and (best is None or node.score > best.score):
            best = node
    if best is None:
        return ""
    for boundary in ("article", "main"):
        node = best
        while node is not None and node.tag != boundary:
            node = node.parent
        if node is not None:
            best = node
            break
    kept = {id(best)}
    for other in best.parent.parts if best.parent is not None else ():
        if isinstance(other, _Node) and not other.junk and other.chars and other.linked < MOST_LINKS * other.chars \
                and (other.tag in TEXT_SIBLINGS or other.score >= SIBLING_SHARE * best.score):
            kept.add(id(other))
    inside: dict[int, bool] = {}

    def is_kept(node: _Node) -> bool:
        path = []
        while node is not None and id(node) not in inside and id(node) not in kept:
            path.append(id(node))
            node = node.parent
        verdict = node is not None and (id(node) in kept or inside[id(node)])
        inside.update((i, verdict) for i in path)
        return verdict

    return "\n".join(text for node, text, _ in found if is_kept(node))


RESULT = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in text_slices([batch], "html"):
            texts = [main_text(h) for h in rows.column("html").to_pylist()]
            yield pa.record_batch([rows.column("id"), rows.column("url"), pa.array(texts, pa.string())], schema=RESULT)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every page.

    One row per input row, repeated rows included; NULL ids and urls stay
    NULL, a NULL or empty page gives an empty text, other columns are left
    out.  Of equally good containers the first in the page wins.  White space
    is what Unicode calls so, no-break spaces included; a ``br`` is white
    space, two in a row end a paragraph.  Rows are independent: no shuffle, and a
    task holds some megabytes of pages (a longer page alone) at a time.
    """
    rows = pages.selectExpr(f"cast(`{id_col}` as bigint) as id", f"`{url_col}` as url", f"`{html_col}` as html")
    return rows.mapInArrow(_extract, "id long, url string, text string")
