"""Main text of web pages by tag-path ratios.

Text length and punctuation are summed per path of block elements from the root to the text. A path's score is its
text per node, raised by punctuation and lowered by links; scores are smoothed over neighbouring paths in page order, and fused
with the container that holds most of the page's score. Inside it, paths of running text stay and nested containers
need a score above a threshold that follows the page's own spread.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and the words by which pages mark what is not the article.
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"])
RAW = frozenset(["script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"])
BLOCK = frozenset(
    ["html", "body", "article", "main", "section", "div", "header", "footer", "nav", "aside", "form", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure", "figcaption", "address", "fieldset", "details", "summary", "dialog", "menu", "center", "hgroup", "search"]
)
CONTAINER = frozenset(["html", "body", "article", "main", "section", "div", "header", "footer", "nav", "aside", "form", "table", "tbody", "tr", "td", "ul", "ol", "dl", "fieldset", "details", "center", "figure"])
NEVER = frozenset(["head", "script", "style", "noscript", "template", "textarea", "title", "iframe", "nav", "header", "footer", "aside", "form", "button", "select", "option", "optgroup", "datalist", "input", "svg", "canvas", "embed", "audio", "video", "dialog", "menu", "search"])
ROLES = frozenset(["navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar", "tablist", "status"])
MARKS = frozenset(
    ["nav", "navbar", "navigation", "menu", "submenu", "sidebar", "aside", "footer", "header", "masthead", "topbar", "toolbar", "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "promo", "promotion", "promoted", "sponsor", "sponsored", "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "register", "share", "sharing", "social", "comment", "comments", "commentlist", "disqus", "respond", "discussion", "replies", "reply", "thread", "opinions", "feedback", "breadcrumb", "breadcrumbs", "related", "recommended", "recommendations", "pagination", "pager", "widget", "search", "skip", "copyright", "hidden"]
)
#: Words before which a class word says nothing of the element itself, and words that only name a part of what a class word names.
DENIALS = frozenset(["no", "not", "non", "without", "has", "have", "with", "hide", "show", "is", "are", "free"])
PARTS = frozenset(
    ["container", "wrapper", "wrap", "box", "inner", "outer", "list", "lists", "item", "items", "block", "blocks", "area", "areas", "bar", "section", "top", "bottom", "left", "right", "primary", "secondary", "links", "link", "buttons", "button", "slot", "unit", "panel", "group", "holder", "region", "module", "row", "col", "column", "columns", "post", "posts", "article", "articles", "stories", "story", "icons", "icon", "social", "media", "text", "title", "body", "header", "heading", "message", "warning", "info", "success", "error", "image", "img", "trail", "nav", "menu", "widget", "form", "tab", "tabs", "toggle", "strip", "cta", "main", "content", "sticky", "fixed", "desktop", "mobile", "small", "large", "global", "site", "page"]
)
#: Headings of lists of sources, which are part of an article though all of them may be links.
SOURCES = frozenset(
    ["references", "sources", "notes", "footnotes", "bibliography", "citations", "further reading", "works cited", "literature", "quellen", "literatur", "einzelnachweise", "références", "notes et références", "bibliographie", "referencias", "fuentes", "notas", "bibliografía"]
)
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
STOP_AT = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
#: Elements nested deeper share the path of the last one.
DEEPEST = 200
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")

NAME = re.compile(r"</?[a-zA-Z][^\s/>]*")
STOPS = re.compile(r"[>\"']")
#: Quoted values of one tag that are passed over, and tags with an odd quote after which quotes count no more on a page.
MOST_QUOTED, MOST_ODD = 200, 50
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Element:
    tag: str
    path: str
    container: str
    shut: bool = False
    named: bool = False  # unwanted by a class word alone
    holds: bool = False  # has the page's main element in it
    inside: list["Element"] = field(default_factory=list)  # the elements around and this one that keep text out


@dataclass
class Run:
    """Text of one block, between two block borders."""

    path: str
    container: str
    outside: list[Element]
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)} if source.strip(" /\n\t") else {}


def _unwanted(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is kept out by what it is."""
    if tag in NEVER:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or HIDES.search(attributes.get("style", "")):
        return True
    return attributes.get("role", "").lower() in ROLES


def _marked(name: str) -> bool:
    """Whether one class or id names what is not the article: its last word does, words for parts aside, or its first one with such words after it."""
    said = [w.lower() for w in WORDS.findall(name) if len(w) > 1 and not w.isdigit()]
    if not said or said[0] in DENIALS or said[-1] in DENIALS:
        return False
    while said[-1] in PARTS and said[-1] not in MARKS and len(said) > 1:
        said.pop()
    return said[-1] in MARKS or said[0] in MARKS and all(w in PARTS or w in MARKS for w in said[1:])


def _named(tag: str, attributes: dict[str, str]) -> bool:
    """Whether a class or the id of an element names what is not the article."""
    return tag not in ("html", "body", "main") and any(_marked(n) for n in (*attributes.get("class", "").split(), *attributes.get("id", "").split()))


class Scanner:
    """The tags of a page one after another. It only goes forward: what it has passed, but for a few odd quotes, isn't read again."""

    def __init__(self, html: str):
        self.html, self.last, self.odd = html, html.rfind(">"), 0

    def _end(self, at: int) -> int:
        """Where a tag ends whose name ends at `at`: at the next > outside quotes, or at the next > where quotes don't close."""
        k, n = at, 0
        while self.odd < MOST_ODD and n < MOST_QUOTED and (m := STOPS.search(self.html, k)):
            if m[0] == ">":
                return m.start()
            k, n = self.html.find(m[0], m.end()) + 1, n + 1
            if not k:
                break
        self.odd += self.odd < MOST_ODD
        return self.html.find(">", at)

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start and end of the next tag or declaration from `at` on, its name (with / if it closes; ! for a comment), what stands in it, and what is text of it."""
        html = self.html
        while (at := html.find("<", at)) >= 0:
            for mark, close in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                if html.startswith(mark, at):
                    end = html.find(close, at + len(mark))
                    return at, len(html) if end < 0 else end + 3, "!", "", html[at + 9 : len(html) if end < 0 else end] if close == "]]>" else ""
            if at > self.last:  # no tag ends any more
                at += 1
                continue
            if html[at + 1 : at + 2] in ("!", "?"):
                return at, html.index(">", at) + 1, "!", "", ""
            if m := NAME.match(html, at):
                end = self._end(m.end())
                return at, end + 1, m[0][1:].lower(), html[m.end() : end], ""
            at += 1
        return None


def runs(html: str) -> list[Run]:
    """The page's text by blocks, in order, with what stands around each. Every step costs the same, however deep a page is nested or how broken it is."""
    root = Element("", "", "")
    stack, found, at, end = [root], [], 0, len(html)
    opened: dict[str, list[int]] = {}  # stack positions by tag
    blocks = [0]  # stack positions of blocks
    unclosed: set[str] = set()
    links = 0
    scanner = Scanner(html)

    def start_run() -> None:
        top = stack[blocks[-1]]
        found.append(Run(top.path, top.container, stack[-1].inside))

    def text(raw: str) -> None:
        if not raw:
            return
        last = found[-1]
        if last.outside is not stack[-1].inside:  # an inline element that keeps its text out
            if not raw.strip():
                return
            start_run()
            last = found[-1]
        last.parts.append(raw)
        if links:
            last.linked += len(raw.strip())

    start_run()

    def close(k: int) -> None:
        """Closes all elements from stack position k on."""
        nonlocal links
        border = False
        for e in stack[k:]:
            e.shut = True
            links -= e.tag == "a"
            opened[e.tag].pop()
            if e.tag in BLOCK:
                blocks.pop()
                border = True
        del stack[k:]
        if border:
            start_run()

    def deepest(tags) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    while at < end:
        m = scanner.next(at)
        if not m:
            text(html[at:])
            break
        text(html[at : m[0]])
        at, tag, rest = m[1:4]
        if tag == "!":
            text(m[4])
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if tag == "br":
                text("\n")
            elif (k := deepest([tag])) and (tag in BLOCK or k >= deepest(("table", "td", "th"))):
                close(k)
            continue
        attributes = _attributes(rest)
        if tag == "br":
            text("\n")
            continue
        if tag in BLOCK:
            if stack[blocks[-1]].tag == "p":  # a block ends an open paragraph
                close(blocks[-1])
            if tag in CLOSED_BY:
                stop = deepest(STOP_AT[tag])
                above = [places[i] for t in CLOSED_BY[tag] if (places := opened.get(t)) and (i := bisect.bisect_right(places, stop)) < len(places)]
                if above:
                    close(min(above))
        elif tag == "option":
            if stack[-1].tag == "option":
                close(len(stack) - 1)
        if tag in VOID or rest.endswith("/") and tag not in BLOCK and tag not in RAW and tag != "a":
            if tag == "hr":
                start_run()
            continue
        around = stack[-1]
        e = Element(tag, around.path, around.container)
        if tag in BLOCK:
            named = attributes.get("class", "").split()
            if around.path.count("/") < DEEPEST:
                e.path = f"{around.path}/{tag}{'.' + named[0] if named else ''}"
            if tag in CONTAINER:
                e.container = e.path
        unwanted = _unwanted(tag, attributes)
        e.named = not unwanted and _named(tag, attributes)
        e.inside = [*around.inside, e] if (unwanted or e.named) and len(around.inside) < DEEPEST else around.inside
        if tag == "main":
            for outer in around.inside:
                outer.holds = True
        opened.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            blocks.append(len(stack))
        stack.append(e)
        links += tag == "a"
        if tag in BLOCK:
            start_run()
        if tag in RAW and tag not in unclosed:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            if stop:
                at = stop.start()
            elif tag in ("script", "style"):
                at = end
            else:
                unclosed.add(tag)
    for run in found:
        run.text = " ".join(unescape("".join(run.parts)).split())
        # What was opened and never closed again can't be told from the rest of the page.
        run.outside = [e for e in run.outside if e.shut or e.tag in RAW]
    return found


def _chosen(page: list[Run]) -> list[Run]:
    """The runs outside elements that are kept out.

    A class word doesn't keep out an element that has the page's main element in it, nor, where class words would leave next to nothing,
    those around the element that has most of the rest.
    """
    for r in page:
        r.outside = [e for e in r.outside if not (e.named and e.holds)]
    wanted = [r for r in page if not r.outside]

    def plain(some: list[Run]) -> int:
        return sum(max(0, len(r.text) - r.linked) for r in some)

    free = [r for r in page if all(e.named for e in r.outside)]
    if plain(wanted) * 20 >= plain(free):
        return wanted
    weight: dict[int, int] = {}
    for r in free:
        for e in r.outside:
            weight[id(e)] = weight.get(id(e), 0) + max(0, len(r.text) - r.linked)
    return [r for r in free if all(2 * weight[id(e)] >= plain(free) for e in r.outside)]


def main_text(html: str | None) -> str:
    """The blocks of the article, joined by two line ends."""
    page = [r for r in runs(html or "") if r.text]
    wanted = _chosen(page)
    if not wanted:
        return ""
    order: dict[str, int] = {}
    for r in wanted:
        order.setdefault(r.path, len(order))
    n = len(order)
    chars, nodes, marks, linked = (np.zeros(n) for _ in range(4))
    for r in wanted:
        k = order[r.path]
        chars[k] += len(r.text)
        nodes[k] += 1
        marks[k] += len(PUNCTUATION.findall(r.text))
        linked[k] += min(r.linked, len(r.text))
    ratio = chars / nodes * (1 + np.log1p(marks / nodes)) * (1 - linked / chars)
    kernel = np.array([0.05, 0.9, 0.05])
    smooth = np.convolve(np.pad(ratio, 1, mode="edge"), kernel, "valid")
    mass = {}
    for path, k in order.items():
        mass[path] = smooth[k] * nodes[k]
    total = sum(mass.values())
    # The deepest container that holds nearly all of the page's score.
    inside: dict[str, float] = {}
    for r_path, container in {(r.path, r.container) for r in wanted}:
        parts = container.split("/")
        for i in range(1, len(parts) + 1):
            key = "/".join(parts[:i])
            inside[key] = inside.get(key, 0.0) + mass[r_path]
    center = max((c for c, m in inside.items() if m >= 0.6 * total), key=lambda c: (c.count("/"), inside[c]), default="")
    threshold = max(0.0, min(np.median(smooth), smooth.mean() - smooth.std() / 2))
    kept = np.zeros(len(wanted), bool)
    for i, r in enumerate(wanted):
        k = order[r.path]
        within = r.container == center or r.container.startswith(center + "/") or not center
        links = linked[k] / chars[k]
        lists = re.fullmatch(r"(/(ul|ol|dl|table|tbody|tr|td|figure|details)(\.[^/]*)?)*", r.container[len(center) :]) if within else None
        if within and (lists is not None or smooth[k] >= threshold) and links < 0.6 or not within and links < 0.3 and smooth[k] >= max(threshold, smooth.max() / 2):
            kept[i] = True
    # The article around the center, and what stands between its kept blocks: headings and short paragraphs stay with their text.
    parts = center.split("/")
    named = [i for i, part in enumerate(parts) if part.split(".")[0] in ("article", "main")]
    scope = "/".join(parts[: named[-1] + 1]) if named else center
    inner = np.array([r.container == scope or r.container.startswith(scope + "/") or not scope for r in wanted])
    low = np.array([linked[order[r.path]] < 0.6 * chars[order[r.path]] for r in wanted])
    kept |= low & np.array([r.container == scope for r in wanted])
    at = np.flatnonzero(kept & inner)
    if len(at):
        kept[at[0] : at[-1] + 1] |= (low & inner)[at[0] : at[-1] + 1]
    listed = False
    for i, r in enumerate(wanted):  # a list of sources stays with its article
        if re.search(r"/h[1-6](\.[^/]*)?$", r.path):
            listed = r.text.strip(" :.").lower() in SOURCES
            kept[i] |= listed and inner[i]
        elif listed and inner[i]:
            kept[i] = True
    return "\n\n".join(r.text for r, k in zip(wanted, kept, strict=True) if k)


def extract_main_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """pages without the html column, with the main text in `out`, empty where there is none; null and empty html give "".

    Headers and footers go, those inside an article with their headings too, as does a list whose text is mostly links. Formulas, labels and the
    like stay in their paragraph. Elements nested over DEEPEST deep share a path, and what keeps text out is told apart up to that depth. Time is in
    proportion to a page's length, however broken it is.
    Other columns pass as they are, but for one named like `out`, which is replaced. Rows are judged one by one: repeated
    rows give equal texts, an empty table an empty one, and nothing is shuffled.
    """
    kept = [c for c in pages.columns if c.lower() not in (html_col.lower(), out.lower())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(kept))), pa.array(texts, pa.string())], [*(f"c{k}" for k in range(len(kept))), "t"])

    read = pages.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)], F.col(html_col).cast("string").alias("h"))
    ddl = "".join(f"c{k} {f.dataType.simpleString()}, " for k, f in enumerate(read.schema.fields[:-1]))
    done = read.mapInArrow(run, f"{ddl}t string")
    return done.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)], F.col("t").alias(out))
