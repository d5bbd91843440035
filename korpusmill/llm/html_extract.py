"""Main text of web pages by line-block distribution.

Markup is stripped in one pass that gives a line for each block of a page,
without menus, footers, forms and the like. A line weighs as much as its text
is long, more in the main part, most in an article, and nothing if it is mostly
links or a rights notice. Weights are summed over windows of three lines. A run
of lines between dives of the sums to nothing is main text if they surge in it;
one in another place than the heaviest run must not weigh little beside that.

Names of classes and ids that speak of adverts, comments and so on silence
their element. A name that says other things, too, does not if the element
holds much text outside links, nor does any name if the element is an article
with most of the page's text, or if nothing else on the page surges.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

#: Lines of a window and the summed weight that is a surge; what a character weighs outside, in the main part and in an
#: article; the share of the heaviest run's weight that others need.
WINDOW, SURGE, RAISE, RIVAL = 3, 80, (1, 2, 4), 0.25
#: Characters outside links from which on a doubtful class name alone silences nothing.
MUCH_TEXT = 200

_RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_NOISE_TAGS = set(
    "nav footer aside form noscript template button select option dialog menu menuitem svg canvas object audio video "
    "datalist optgroup head".split()
)
_NOISE_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist status".split()
)
#: Words of class names and ids. Those of the second set count outside an article only. A name that says nothing else
#: but the third set's words and numbers is certain, any other doubtful.
_NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot promo promos promotion sponsor "
    "sponsored sponsors nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs sidebar sidebars sidenav footer "
    "cookie cookies consent gdpr notice notices notification notifications popup modal overlay newsletter subscribe "
    "subscription signup login share sharing sharebar social comment comments commentlist disqus replies respond related "
    "recommended recommendations widget widgets pagination pager search searchbox searchform paywall skiplink".split()
)
_PAGE_NOISE_WORDS = set("header masthead topbar toolbar banner alert alerts copyright legal disclaimer tags toc".split())
_GENERIC_WORDS = set(
    "area article bar block body bottom box btn button buttons card col column container content div el element form frame "
    "group head heading holder icon icons id inline inner item items js layer left link links list main module outer page "
    "panel part post posts region right row section sidebar site slot small stories story teaser text title top unit view "
    "wrap wrapper zone".split()
)
#: A class name with one of these says something about the page's layout, not about the element.
_LAYOUT_WORDS = set("has with no without layout enabled disabled".split())
#: A new block of the kind ends an open one.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_OPEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|!--|[!?])")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop)(?=[\s=/]|$)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RIGHTS = re.compile(r"\s*(?:©|\(c\)\s|copyright\b)", re.I)


def _noisy_name(value: str, in_article: bool) -> int:
    """2 if a name is certainly one of boilerplate, 1 if it may be, else 0."""
    worst = 0
    for name in value.split():
        words = {w.lower() for w in _PARTS.findall(name) if not w.isdigit()}
        noisy = words & _NOISE_WORDS or (set() if in_article else words & _PAGE_NOISE_WORDS)
        if noisy and not words & _LAYOUT_WORDS:
            worst = max(worst, 2 if words <= _NOISE_WORDS | _PAGE_NOISE_WORDS | _GENERIC_WORDS else 1)
    return worst


@dataclass
class _Named:
    """An element with a noisy name: how certain, whether it is an article or main part, the one around it (-1: none), characters outside and inside links."""

    certain: bool
    body: bool
    outer: int
    plain: int = 0
    linked: int = 0

    def silent(self, total: int) -> bool:
        if self.certain:
            return not (self.body and 2 * self.plain > total)
        return self.plain < MUCH_TEXT or self.linked > self.plain


class _Lines:
    """Lines of one page: text, characters of links in it, place (0 elsewhere, 1 main part, 2 article), the noisily named element around it."""

    def __init__(self):
        self.lines: list[tuple[str, int, int, int]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.stack: list[tuple[str, bool, int, bool, bool]] = []  # name, noise, place, link, noisy name
        self.open: Counter[str] = Counter()
        self.noise, self.place, self.link = 0, 0, 0
        self.named: list[_Named] = []
        self.around = -1

    def text(self, raw: str) -> None:
        if raw and not self.noise:
            text = html_lib.unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if self.link:
                self.linked += len(text.strip())

    def end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((text, self.linked, self.place, self.around))
                if self.around >= 0:
                    self.named[self.around].plain += max(0, len(text) - self.linked)
                    self.named[self.around].linked += self.linked
            self.parts, self.linked = [], 0

    def loud(self) -> list[tuple[str, int, int]]:
        """All lines but those of silent elements."""
        total = sum(max(0, len(t) - linked) for t, linked, _, _ in self.lines)
        silent = [False]  # by number + 1
        for e in self.named:
            silent.append(silent[e.outer + 1] or e.silent(total))
        return [line[:3] for line in self.lines if not silent[line[3] + 1]]

    def pop(self) -> None:
        name, noise, place, link, named = self.stack.pop()
        if name not in _INLINE:
            self.end_line()
        self.open[name] -= 1
        self.noise -= noise
        self.link -= link
        self.place = place
        if named:
            inner = self.named[self.around]
            self.around = inner.outer
            if inner.outer >= 0:  # what it holds is the outer one's, too
                outer = self.named[inner.outer]
                outer.plain, outer.linked = outer.plain + inner.plain, outer.linked + inner.linked

    def start(self, name: str, attrs: str) -> None:
        if name == "br":
            self.text(" ")
            return
        if name not in _INLINE:
            self.end_line()
            if self.open["p"] and any(x[0] == "p" for x in self.stack[-8:]):
                self.close("p")
            if name in _SIBLINGS and self.stack and self.stack[-1][0] in _SIBLINGS[name]:
                self.pop()
            if name == "body" and self.open["head"]:
                self.close("head")
        if name in _VOID:
            return
        article = name == "article" or self.place == 2
        noise, place, doubt = name in _NOISE_TAGS or name == "header" and not article, self.place, 0
        if attrs:
            for m in _ATTR.finditer(attrs):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                    noise |= name not in ("html", "body")
                elif key == "role":
                    roles = set(value.lower().split())
                    noise |= bool(roles & _NOISE_ROLES)
                    place = max(place, 2 if "article" in roles else 1 if "main" in roles else 0)
                elif key == "itemprop":
                    place = 2 if value.lower() == "articlebody" else place
                elif name not in ("html", "body", "main"):
                    doubt = max(doubt, _noisy_name(value, article))
        place = 2 if name == "article" else max(place, 1) if name == "main" else place
        if name in _INLINE:  # part of a line
            noise, doubt = noise or doubt == 2, 0
        if doubt:
            self.named.append(_Named(doubt == 2, place > self.place or name == "article", self.around))
            self.around = len(self.named) - 1
        self.stack.append((name, noise, self.place, name == "a", doubt > 0))
        self.open[name] += 1
        self.noise += noise
        self.link += name == "a"
        self.place = place

    def close(self, name: str) -> None:
        if name not in _INLINE:
            self.end_line()
        if self.open[name] > 0:
            while self.stack[-1][0] != name:
                self.pop()
            self.pop()


def page_lines(page: str) -> _Lines:
    """The page's lines in order. One pass: no part of the page is searched again and again."""
    out, at = _Lines(), 0
    last = {q: page.rfind(q) for q in "\"'"}
    while m := _OPEN.search(page, at):
        out.text(page[at : m.start()])
        if m[2] is None:  # a comment or declaration; one without end takes the rest
            mark = "-->" if m[0] == "<!--" else ">"
            end = page.find(mark, m.end())
            if end < 0:
                at = len(page)
                break
            at = end + len(mark)
            continue
        stop = m.end()
        while (s := _STOP.search(page, stop)) and s[0] != ">":
            close = page.find(s[0], s.end()) if last[s[0]] >= s.end() else -1
            stop = close + 1 if close >= 0 else s.end()
        end = s.start() if s else page.find(">", m.end())
        if end < 0:
            at = len(page)
            break
        name, at = m[2].lower(), end + 1
        if m[1]:
            out.close(name)
        elif name in _RAW:
            if name not in _INLINE:
                out.end_line()
            ended = re.compile(rf"</{name}(?=[\s/>]|$)", re.I).search(page, at)
            at = ended.start() if ended else len(page)
        else:
            out.start(name, page[m.end() : end])
    out.text(page[at:])
    while out.stack:
        out.pop()
    out.end_line()
    return out


def _runs(lines: list[tuple[str, int, int]], window: int, surge: int) -> list[tuple[int, int, int]]:
    """Weight, begin and end of all runs between dives of the summed weights in which these surge; a run lies in one place."""
    weights = [0 if linked > 0.6 * len(text) or _RIGHTS.match(text) else len(text) * RAISE[place] for text, linked, place in lines]
    runs, begin = [], 0
    while begin < len(lines):
        end = begin
        while end < len(lines) and lines[end][2] == lines[begin][2]:
            end += 1
        own, sums, total = weights[begin:end], [0] * (end - begin), 0
        for i in range(len(own) - 1, -1, -1):
            total += own[i] - (own[i + window] if i + window < len(own) else 0)
            sums[i] = total
        first, start, dived = None, None, False
        for i in range(len(own) + 1):
            dive = i == len(own) or sums[i] == 0
            if dive:
                if start is not None:
                    runs.append((sum(own[start:i]), begin + start, begin + i))
                first, start, dived = None, None, True
                continue
            if first is None and (own[i] or lines[begin][2] and not dived):
                first = i  # since the last dive: headline and byline are too short for a surge
            if start is None and sums[i] >= surge and first is not None:
                start = first
        begin = end
    return runs


def main_lines(lines: list[tuple[str, int, int]], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines of all surging runs but those of other places that weigh little beside the heaviest.

    Lines of links and rights notices weigh nothing: a window of them is a
    dive. Fewer of them stay inside a marked run and go from others. A text too
    short for any surge counts whole, in the innermost place there is.
    """
    runs = _runs(lines, window, surge)
    plain = [not (linked > 0.6 * len(text) or _RIGHTS.match(text)) for text, linked, _ in lines]
    if not runs:
        top = max((place for _, _, place in lines), default=0)
        return [t for (t, _, place), p in zip(lines, plain) if place == top and (place or p)]
    most, at, _ = max(runs, key=lambda r: r[0])
    kept = [r for r in runs if lines[r[1]][2] == lines[at][2] or r[0] >= RIVAL * most]
    return [lines[i][0] for _, a, b in kept for i in range(a, b) if lines[i][2] or plain[i]]


def main_text(page: str | None) -> str:
    read = page_lines(page or "")
    loud = read.loud()
    if len(loud) < len(read.lines) and not _runs(loud, WINDOW, SURGE):  # a name silenced what the page is about
        every = [line[:3] for line in read.lines]
        if _runs(every, WINDOW, SURGE):
            loud = every
    return "\n\n".join(main_lines(loud))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column(2)]
        yield pa.record_batch({
            "page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array(map(len, texts), pa.int64()),
        })


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (page_id, url, html).

    Blocks are joined by an empty line, white space in a block becomes one
    space, character references are decoded. Wherever the page marks its main
    part, windows, surges and dives choose among the lines of all places; marks
    raise weights. A null or empty page, or one
    without main text, gives an empty text. Pages are read whole and each for
    itself, so repeated rows give repeated results; other columns are ignored.
    """
    return pages.select("page_id", "url", "html").mapInArrow(_extract, _schema(pages))


def _schema(pages: DataFrame) -> str:
    kinds = dict(pages.dtypes)
    return f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
