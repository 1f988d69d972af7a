"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recordloom.llm.words import map_batches

_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table
tbody td tfoot th thead title tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp svg math object canvas".split())
#: Elements that are never part of an article's text.
_OUTSIDE = frozenset("aside button datalist dialog footer form head header input label menu nav optgroup option search select".split())
#: Elements that can hold an article, its paragraphs and headings.
_HOLDS = frozenset("article body center div details fieldset html li main section table tbody td tr".split())
_TITLE, _HEADINGS = "h1", frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select", "datalist")),
}
_ENDS_P = _BLOCK - frozenset("body caption dd dt head html legend li optgroup option select summary tbody td tfoot th thead title tr".split())
#: Words in a class, id or role that name a part of the page other than the article.
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|alert|banner|breadcrumbs?|comments?|complementary|consent|contentinfo|cookies?|copyright|dialog|disclaimer|discussion|"
    r"disqus|footer|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|overlay|pagination|pager|popup|promo|promoted|recommend(?:ed|ations)?|"
    r"related|replies|reply|respond|search|share|sharing|sidebar|signup|social|sponsor(?:ed)?|subscribe|subscription|toolbar|topbar|tracking|widget)(?:$|[\s_-])", re.I
)
_TAG = re.compile(r"<(?:!--.*?(?:-->|$)|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|$))", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Block:
    """Text between two block boundaries, with its tag path and the elements it lies in."""

    __slots__ = ("parts", "path", "above", "named", "link", "text")

    def __init__(self, path: str, above: tuple[int, ...], named: tuple[int, ...]):
        self.parts, self.path, self.above, self.named, self.link, self.text = [], path, above, named, 0, ""

    def holders(self) -> zip[tuple[int, str]]:
        return zip(self.above, (tag for tag in self.path.split("/") if tag in _HOLDS))


def _outside(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether the element is outside the article by its kind, and whether by a word in its class or id only."""
    if tag in _OUTSIDE:
        return True, False
    if not attributes or tag in ("html", "body"):
        return False, False
    named = False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value, name = a or b or c, name.lower()
        if name in ("class", "id", "role"):
            if _NAMES.search(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value)):
                if name == "role":
                    return True, False
                named = True
        elif name == "style":
            if _HIDDEN.search(value):
                return True, False
        elif name == "hidden" or value.lower() == "true":
            return True, False
    return False, named


def blocks(page: str) -> list[Block]:
    """Text blocks in page order that lie in no element outside the article by its kind; a lenient reader of HTML.

    Elements outside by a word in their class or id only are noted in ``named``.
    """
    stack: list[tuple[str, int, bool, tuple[int, ...]]] = []
    out: list[Block] = []
    current: Block | None = None
    node = 0
    links = 0
    at = 0
    end = len(page)

    def add(text: str) -> None:
        nonlocal current
        if stack and stack[-1][2]:
            return
        if current is None:
            if not text.strip():
                return
            current = Block("/".join(s[0] for s in stack), tuple(s[1] for s in stack if s[0] in _HOLDS), stack[-1][3] if stack else ())
            out.append(current)
        current.parts.append(text)
        if links:
            current.link += len(text)

    def pop(n: int) -> None:
        nonlocal links, current
        for tag, *_ in stack[n:]:
            links -= tag == "a"
            if tag in _BLOCK:
                current = None
        del stack[n:]

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        m = _TAG.match(page, lt)
        if m is None:
            add("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop(i)
                    break
            continue
        if tag == "br" or tag == "wbr":
            if tag == "br" and current is not None:
                current.parts.append(" ")
            continue
        if tag in _ENDS_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    pop(i)
                    break
                if stack[i][0] in ("table", "td", "th", "button"):
                    break
        if tag in _CLOSES:
            closed, bounds = _CLOSES[tag]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closed.split():
                    pop(i)
                    break
                if stack[i][0] in bounds:
                    break
        if tag in _BLOCK:
            current = None
        if tag in _VOID:
            continue
        if m[3].endswith("/") and tag in _RAW:
            continue
        if tag in _RAW:
            close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        node += 1
        outside, named = _outside(tag, m[3])
        inherited = stack[-1][3] if stack else ()
        stack.append((tag, node, bool(stack and stack[-1][2]) or outside, (*inherited, node) if named else inherited))
        links += tag == "a"
    done = []
    for b in out:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
        if b.text:
            done.append(b)
    return done


def path_scores(found: list[Block]) -> dict[str, float]:
    """Each tag path's ratio: characters per node, raised by punctuation and lowered by links,
    smoothed over the paths that come just before and after it and look alike."""
    total: dict[str, list[float]] = {}
    for b in found:
        t = total.setdefault(b.path, [0, 0, 0, 0])
        t[0] += len(b.text)
        t[1] += 1
        t[2] += len(_PUNCTUATION.findall(b.text))
        t[3] += min(b.link, len(b.text))
    paths = list(total)
    text = np.array([total[p][0] / total[p][1] for p in paths])
    marks = np.array([1 + total[p][2] / total[p][1] for p in paths])
    prose = np.array([1 - total[p][3] / total[p][0] for p in paths])
    volume = np.array([total[p][0] for p in paths])
    fused = text * marks * prose * np.log1p(volume)
    smooth = np.zeros(len(paths))
    for i, p in enumerate(paths):
        weight = 0.0
        for j in range(max(0, i - 2), min(len(paths), i + 3)):
            a, b = p.split("/"), paths[j].split("/")
            same = sum(x == y for x, y in zip(a, b)) / max(len(a), len(b))
            w = np.exp(-((i - j) ** 2) / 2) * same**2
            smooth[i] += w * fused[j]
            weight += w
        smooth[i] /= weight
    return dict(zip(paths, smooth))


def _admitted(found: list[Block]) -> list[Block]:
    """The blocks in no element outside the article by its name.

    A name is overruled where its element holds most of the page's prose, no main heading or
    ``main`` lies outside it, and it has one or no other path reaches a tenth of its best ratio.
    """
    prose = lambda some: sum(max(0, len(b.text) - b.link) for b in some)
    heads = lambda some: any(not {"h1", "main"}.isdisjoint(b.path.split("/")) for b in some)
    refused = {n for b in found for n in b.named}
    if not refused:
        return found
    held: dict[int, list[Block]] = {n: [] for n in refused}
    for b in found:
        for n in b.named:
            held[n].append(b)
    whole = prose(found)
    for n, inside in held.items():
        if 2 * prose(inside) <= whole:
            continue
        rest = [b for b in found if n not in b.named]
        if heads(rest):
            continue
        if heads(inside) or not rest or max(path_scores(rest).values()) < 0.1 * max(path_scores(inside).values()):
            refused.discard(n)
    return [b for b in found if refused.isdisjoint(b.named)]


def main_text(page: str) -> str:
    """The article of a page: its blocks joined by line feeds.

    Paths with a ratio of at least a tenth of the best are content, and no block of theirs is
    left out. The article's element is the smallest that holds four fifths of the content's
    characters, or the ``article`` or ``main`` around that, widened until it holds every block
    whose path is one of its content paths. Its other blocks, headings too, are text as well
    unless their path is mostly links. Main headings are kept from elsewhere if it has none.
    """
    found = _admitted(blocks(page))
    if not found:
        return ""
    scores = path_scores(found)
    best = max(scores.values())
    content = {p for p, score in scores.items() if score >= 0.1 * best}
    picked = [b for b in found if b.path in content]
    whole = sum(len(b.text) for b in picked)
    held: dict[int, int] = {}
    for b in picked:
        for node in b.above:
            held[node] = held.get(node, 0) + len(b.text)
    # later numbers lie deeper among the elements that hold enough
    root = max((n for n, size in held.items() if size >= 0.8 * whole), default=None)
    if root is not None:
        tags = {n: tag for b in picked if root in b.above for n, tag in b.holders() if n <= root}
        for kind in ("article", "main"):
            own = [n for n, tag in tags.items() if tag == kind]
            if own:
                root = max(own)
                break
        shared = {b.path for b in picked if root in b.above}
        alike = [set(b.above) for b in picked if b.path in shared]
        root = max((n for n in set.intersection(*alike) if n <= root), default=None)
    inside = lambda b: root is None or root in b.above
    length, linked = {}, {}
    for b in found:
        length[b.path] = length.get(b.path, 0) + len(b.text)
        linked[b.path] = linked.get(b.path, 0) + min(b.link, len(b.text))
    headed = any(inside(b) and _TITLE in b.path.split("/") for b in found)

    def kept(b: Block) -> bool:
        tags = b.path.split("/")
        if b.path in content:
            return True
        if not inside(b):
            return not headed and _TITLE in tags
        return linked[b.path] <= 0.6 * length[b.path] or not _HEADINGS.isdisjoint(tags)

    return "\n".join(b.text for b in found if kept(b))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; null html counts as empty and gives an empty text.

    Null and repeated ids are rows of their own; other columns are ignored.
    """

    def one(batch: pa.RecordBatch) -> dict[str, object]:
        return {"text": [main_text(x) if x else "" for x in batch.column("html").to_pylist()]}

    found = map_batches(pages.select("page_id", "url", "html"), one, "text string", keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))
