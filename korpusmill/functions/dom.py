"""Nesting-aware cleanup for pages whose markup a regular expression cannot handle.

Runs as an Arrow UDF and only sees pages that need it.
"""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F

from korpusmill.profiles import SiteProfile

# Elements without content.
_VOID = frozenset(
    "area base br col embed hr img input keygen link meta param source track wbr".split()
)


_UNENDED = re.compile(r"<[A-Za-z/!?].*", re.DOTALL)


class _Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs=()):
        self.tag, self.attrs, self.children = tag, attrs, []


class _Closing(str):
    """An end tag waiting to be written."""


class _TreeBuilder(HTMLParser):
    """An end tag closes everything opened since its start tag, or is ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(_Node(tag, attrs))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def _text_length(node: _Node) -> int:
    words, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            words.extend(item.split())
        else:
            todo.extend(item.children)
    return sum(map(len, words)) + max(len(words) - 1, 0)


def _serialize(root: _Node) -> str:
    out, todo = [], list(reversed(root.children))
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item if isinstance(item, _Closing) else escape(item, quote=False))
            continue
        attrs = "".join(f' {k}="{escape(v or "")}"' for k, v in item.attrs)
        out.append(f"<{item.tag}{attrs}>")
        if item.tag not in _VOID:
            todo.append(_Closing(f"</{item.tag}>"))
            todo.extend(reversed(item.children))
    return "".join(out)


def clean_markup(html: str, drop_tags: frozenset, noise: re.Pattern, max_chars: int) -> str:
    """Drop unwanted elements and short elements whose class or id looks like noise."""
    # A tag that nothing ends takes the rest of the page; the parser would search that rest again from each start.
    ended = html.rfind(">") + 1
    builder = _TreeBuilder()
    builder.feed(html[:ended] + _UNENDED.sub("", html[ended:], count=1))
    builder.close()
    # First the unwanted tags everywhere: noise is measured on what is left.
    todo = [builder.root]
    while todo:
        node = todo.pop()
        node.children = [c for c in node.children if isinstance(c, str) or c.tag not in drop_tags]
        todo.extend(c for c in node.children if not isinstance(c, str))
    # Then noise, outer elements before the ones inside them.
    todo = [builder.root]
    while todo:
        node = todo.pop()
        node.children = [
            c for c in node.children if isinstance(c, str) or not _is_noise(c, noise, max_chars)
        ]
        todo.extend(c for c in node.children if not isinstance(c, str))
    return _serialize(builder.root)


def _is_noise(node: _Node, noise: re.Pattern, max_chars: int) -> bool:
    marks = (v for k, v in node.attrs if k in ("class", "id") and v)
    return any(noise.search(v) for v in marks) and _text_length(node) < max_chars


def clean_markup_udf(profile: SiteProfile):
    """Arrow UDF html -> cleaned html; null stays null."""
    drop = frozenset(profile.drop_tags)
    noise = re.compile("|".join(profile.noise_words), re.IGNORECASE)
    limit = profile.noise_max_chars

    @F.pandas_udf("string")
    def clean(html: pd.Series) -> pd.Series:
        return html.map(lambda h: clean_markup(h, drop, noise, limit), na_action="ignore")

    return clean
