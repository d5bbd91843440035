"""HTML extraction as Column expressions.

Regular pages are handled by the JVM's regular expressions alone. Patterns of
tags and elements are linear: quantified groups are possessive, and where an
end is missing the first match takes the rest of the page, so the rest is not
searched again from every later start.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.functions.text import longer_text, normalize_space, strip_space
from korpusmill.functions.url import canonical_url, join_url, let, looks_like_file
from korpusmill.profiles import SiteProfile

_IN_TAG = r"""(?:[^"'>]++|"[^"]*+"|'[^']*+'|["'])*+"""
ANY_TAG = rf"<[A-Za-z/!?]{_IN_TAG}(?:>|\z)"
COMMENT = r"(?s)<!--(?:.*?-->|.*+)"
SCRIPT = r"(?is)<(script|style)\b(?:[^>]*+>(?:.*?</\1\s*+>|.*+)|[^>]*+\z)"
_BLOCK_TAGS = (
    "p|div|li|ul|ol|h[1-6]|table|thead|tbody|tr|td|th|section|article|main|blockquote|pre|dl|dt|dd|"
    "form|fieldset|figure|figcaption|body|html|br|hr|details|summary|header|footer|nav|aside|address"
)
BLOCK_EDGE = rf"(?i)</?(?:{_BLOCK_TAGS})\b{_IN_TAG}(?:>|\z)"
# Markup that hides text until someone clicks.
INTERACTIVE_ATTR = (
    r"(?i)<[a-z][^<>]*\s(?:aria-expanded\s*=\s*[\"']?false\b|data-(?:bs-)?toggle\s*=\s*[\"']?collapse\b)"
)
INTERACTIVE_CLASS = (
    r"(?i:<[a-z][^<>]*\sclass\s*=\s*)(?:[\"'](?:[^\"'>]*\s)?|)"
    r"(?:accordion|faq|tabs|tab|collapse|spoiler|toggle)(?=[\s\"'>])"
)

# Windows code points that pages use by mistake for typographic characters; five of them mean nothing there.
_CP1252 = {i: bytes([i]).decode("cp1252") for i in range(0x80, 0xA0) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
_COMMON = ("amp;", "nbsp;", "quot;", "lt;", "gt;", "laquo;", "raquo;", "mdash;", "ndash;", "copy;")


def _entity_names() -> list[str]:
    return [*_COMMON, *(n for n in html5 if n not in _COMMON)]


def _decode_reference(piece: Column, names: Column) -> Column:
    """``piece`` is what follows an ampersand.

    Of a name that is not known the longest known start counts, as browsers do;
    names that need no semicolon have two to six letters.
    """
    pattern = r"^(?:#[0-9]++;?|#[xX][0-9A-Fa-f]++;?|[A-Za-z][A-Za-z0-9]{0,31};?)"

    def numeric(ref: Column) -> Column:
        hexed = F.regexp_extract(ref, "^#[xX]0*+([0-9A-Fa-f]*)", 1)
        plain = F.regexp_extract(ref, "^#0*+([0-9]*)", 1)
        # Anything longer is beyond the last character.
        digits = F.when(ref.rlike("^#[xX]"), F.when(F.length(hexed) <= 8, F.conv(F.concat(F.lit("0"), hexed), 16, 10)))
        digits = F.when(ref.rlike("^#[xX]"), digits).when(F.length(plain) <= 9, F.concat(F.lit("0"), plain))
        return let(F.coalesce(digits.try_cast("bigint"), F.lit(1 << 40)), character)

    def character(code: Column) -> Column:
        valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
        plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        plain = F.translate(plain, "".join(map(chr, _CP1252)), "".join(_CP1252.values()))
        unused = code.between(1, 8) | code.between(0xE, 0x1F) | code.isin(0xB, 0x7F) | code.between(0xFDD0, 0xFDEF)
        unused |= code.bitwiseAND(0xFFFE) == 0xFFFE
        return F.when(valid & unused, "").when(valid, plain).otherwise(chr(0xFFFD))

    def replace(ref: Column) -> Column:
        def rest(name: Column) -> Column:
            return F.substring(piece, F.length(name) + 1, F.length(piece))

        # One look at the names for all starts: each one written out would carry all names into the plan and every task.
        starts = F.array(ref, *[F.when(F.length(ref) > n, F.left(ref, F.lit(n))) for n in range(6, 1, -1)])
        named = F.aggregate(
            starts,
            F.lit(None).cast("string"),
            lambda done, name: F.coalesce(done, F.concat(F.try_element_at(names, name), rest(name))),
        )
        return F.when(ref.startswith("#"), F.concat(numeric(ref), rest(ref))).otherwise(
            F.coalesce(named, F.concat(F.lit("&"), piece))
        )

    return let(F.regexp_extract(piece, pattern, 0), replace)


def unescape(c: Column) -> Column:
    """Character references to characters; texts without an ampersand pass untouched."""
    order = _entity_names()
    names = F.map_from_arrays(
        F.split(F.lit(" ".join(order)), " "), F.split(F.lit("\x00".join(html5[n] for n in order)), "\x00")
    )
    pieces = F.split(c, "&")
    tail = F.slice(pieces, F.lit(2), F.size(pieces))
    decoded = F.concat(
        F.element_at(pieces, 1), F.array_join(F.transform(tail, lambda p: _decode_reference(p, names)), "")
    )
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def drop_hidden(html: Column) -> Column:
    """Without comments, scripts and styles."""
    return F.regexp_replace(F.regexp_replace(html, COMMENT, " "), SCRIPT, " ")


def markup_text(html: Column) -> Column:
    """All text, pieces joined by one space."""
    return normalize_space(unescape(F.regexp_replace(html, ANY_TAG, " ")))


def element(tag: str) -> str:
    """The content is group 1; it is unset where the first start tag without end takes the rest of the page."""
    return rf"(?is)<{tag}\b(?:[^>]*+>(?:(.*?)</{tag}\s*+>|.*+)|[^>]*+\z)"


def extract_title(visible: Column) -> Column:
    """First h1 if it has text, else the title element."""
    h1 = F.nullif(markup_text(F.regexp_extract(visible, element("h1"), 1)), F.lit(""))
    title = F.regexp_extract(visible, element("title"), 1)
    return F.coalesce(h1, F.when(title != "", normalize_space(unescape(title))))


def extract_breadcrumbs(visible: Column) -> Column:
    """Link texts of the breadcrumb nav, else item texts of the breadcrumb list."""
    nav_open = r"(?is)<nav\b[^<>]*?\saria-label\s*=\s*(?:\"[^\">]*breadcrumb|'[^'>]*breadcrumb|[^\s\"'>]*breadcrumb)[^>]*+>"
    list_open = r"(?is)<ul\b[^<>]*?\sclass\s*=\s*(?:\"[^\">]*breadcrumb|'[^'>]*breadcrumb|[^\s\"'>]*breadcrumb)[^>]*+>"
    nav = F.regexp_extract(visible, nav_open + r"(?:(.*?)</nav\s*+>|.*+)", 1)
    items = F.regexp_extract(visible, list_open + r"(?:(.*?)</ul\s*+>|.*+)", 1)
    # The lookahead consumes nothing, so a span inside a link is seen as well.
    in_nav = F.regexp_extract_all(nav, F.lit(r"(?is)(?=<(a|span)\b[^>]*+>(.*?)</\1\s*+>)"), F.lit(2))
    in_list = F.regexp_extract_all(items, F.lit(element("li")), F.lit(1))
    chosen = F.when(visible.rlike(nav_open), in_nav).otherwise(in_list)
    return F.array_distinct(F.filter(F.transform(chosen, markup_text), lambda t: t != ""))


def extract_links(visible: Column, base: Column, strip_default_ports: bool = True) -> Column:
    """Distinct canonical link targets of a page, files excluded."""
    tags = F.regexp_extract_all(visible, F.lit(rf"(?i)<a\s{_IN_TAG}(?:>|\z)"), F.lit(0))
    raw = F.transform(
        tags,
        lambda t: F.regexp_extract(t, r"""(?is)["'\s]href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1),
    )
    hrefs = F.array_distinct(
        F.filter(
            F.transform(raw, lambda v: strip_space(unescape(F.regexp_replace(v, r"^[\"']|[\"']\z", "")))),
            lambda v: v != "",
        )
    )
    joined = F.transform(hrefs, lambda h: join_url(base, h))
    targets = F.transform(joined, lambda u: canonical_url(u, strip_default_ports))
    return F.array_distinct(F.filter(targets, lambda u: ~looks_like_file(u)))


def drop_elements(html: Column, tags: tuple[str, ...]) -> Column:
    """Without the elements named; right for markup that ``needs_tree`` passes. One without end stays, with all after it."""
    out = F.regexp_replace(html, COMMENT, " ")
    for tag in tags:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b[^>]*+>.*?</{tag}\s*+>|(<{tag}\b.*+)", " $1")
    return out


def needs_tree(html: Column, dropped: Column, profile: SiteProfile) -> Column:
    """Noise marked by class or id, or an unwanted element nested, unclosed or unopened."""
    words = "|".join(profile.noise_words)
    mark = rf"(?iu)<[a-z][^<>]*?\s(?:class|id)\s*+=\s*+(?:\"[^\">]*?(?:{words})|'[^'>]*?(?:{words})|[^\s\"'>]*?(?:{words}))"
    leftover = rf"(?i)</?(?:{'|'.join(profile.drop_tags)})\b"
    return dropped.rlike(leftover) | html.rlike(mark)


def page_looks_interactive(html: Column, profile: SiteProfile) -> Column:
    """Collapsed parts, accordion-like classes, or a "read more" word in any text."""
    words = "(?iu)" + "|".join(profile.interactive_words)
    texts = F.regexp_replace(html, rf"<[A-Za-z/]{_IN_TAG}>", " ")
    return html.rlike(INTERACTIVE_ATTR) | html.rlike(INTERACTIVE_CLASS) | texts.rlike(words)


def _plain(html: Column) -> Column:
    return normalize_space(F.regexp_replace(html, ANY_TAG, " "))


def _dense_text(blocks: Column, min_chars: int, max_link_share: float) -> Column:
    """Blocks with enough text of their own, joined by a space."""

    def keep(b: Column) -> Column:
        size = F.length(b["text"])
        return (size >= min_chars) & (b["linked"] <= size * F.lit(max_link_share))

    return F.array_join(F.transform(F.filter(blocks, keep), lambda b: b["text"]), " ")


def with_main_text(df: DataFrame, cleaned: str, out: str) -> DataFrame:
    """Add the text of the blocks that are not mostly links.

    A strict and a generous pass; the longer result wins. If neither finds
    anything, all text of the page. One projection per step, so that no step is
    computed twice.
    """
    linked = lambda h: F.array_join(F.regexp_extract_all(h, F.lit(element("a")), F.lit(1)), " ")
    blocks = F.transform(
        F.split(F.regexp_replace(F.col(cleaned), element("head"), " "), BLOCK_EDGE),
        lambda h: F.struct(_plain(h).alias("text"), F.length(_plain(linked(h))).alias("linked")),
    )
    return (
        df.withColumn("_blocks", blocks)
        .withColumn("_strict", _dense_text(F.col("_blocks"), 25, 0.33))
        .withColumn("_generous", _dense_text(F.col("_blocks"), 1, 0.66))
        .withColumn("_best", normalize_space(unescape(longer_text(F.col("_strict"), F.col("_generous")))))
        .withColumn(out, F.when(F.col("_best") != "", F.col("_best")).otherwise(markup_text(F.col(cleaned))))
        .drop("_blocks", "_strict", "_generous", "_best")
    )
