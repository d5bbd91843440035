"""Which document lines open a section, and the key they carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from korpusmill.functions.text import DIGIT, WS, strip_space
from korpusmill.functions.url import let

# Header patterns of legal documents.
LEGAL_HEADER = (
    r"(?iu)^(?:"
    rf"(?:статья|ст\.|раздел|пункт|п\.){WS}*{DIGIT}"
    rf"|глава{WS}*(?:[IVXLCDM]|{DIGIT})"
    rf"|приложение{WS}*(?:[A-ZА-Я]|{DIGIT})"
    r")"
)
AFTER_NUMBER = rf"^{WS}*[.)]?{WS}*[^\n]{{2,220}}{WS}*\z"
AFTER_TITLE_NUMBER = rf"^{WS}*[.)]?{WS}*[^\n]+?{WS}*\z"
DEFINITION = rf"(?iu){WS}[–—-]{WS}+[a-zа-яёҥүө0-9]"
TITLE_LIKE = rf"^[A-ZА-ЯЁҢҮӨ][\p{{L}}\p{{N}}_\-,–—:()«»\"'’{WS}]+\z"
LETTER = "[A-Za-zА-Яа-яЁёҢңҮүӨө]"
UPPER = "[A-ZА-ЯЁҢҮӨ]"


def _leading_number(t: Column, rest: str) -> Column:
    """The longest dotted number, of any depth, at the start of a stripped text, that ``rest`` may follow.

    Giving up to three characters back is enough: they are text for ``rest``,
    and the number still ends in a digit.
    """

    def longest(t: Column) -> Column:
        run = F.regexp_extract(t, rf"^{DIGIT}[{DIGIT}.]*+", 0)
        return F.struct(t.alias("t"), F.regexp_replace(F.substring_index(run, "..", 1), r"\.$", "").alias("n"))

    def shortened(s: Column, by: int) -> Column:
        number = F.substring(s["n"], F.lit(1), F.length(s["n"]) - by)
        fits = number.rlike(rf"{DIGIT}\z") & F.substring(s["t"], F.length(number) + 1, F.length(s["t"])).rlike(rest)
        return F.when(fits, number)

    # Few lines begin with a digit, which is cheaper to see.
    number = let(let(t, longest), lambda s: F.coalesce(*(shortened(s, i) for i in range(4))))
    return F.when(t.rlike(rf"^{DIGIT}"), number)


def stripped(c: Column) -> Column:
    """A text for the ``_of`` functions below. Spark's trim of given characters looks at every one, so ends are looked at first."""
    t = F.coalesce(c, F.lit(""))
    plain = ~F.substring(t, 1, 1).rlike(WS) & ~F.substring(t, -1, 1).rlike(WS)
    return F.when(plain, t).otherwise(strip_space(t))


def section_key(c: Column) -> Column:
    """Leading dotted number of a header line; null without one."""
    return _leading_number(stripped(c), AFTER_NUMBER)


def toc_section_key(c: Column) -> Column:
    """As ``section_key``, but any one character may follow the number."""
    return _leading_number(stripped(c), AFTER_TITLE_NUMBER)


def is_definition(c: Column) -> Column:
    """Glossary lines (term, spaced dash, explanation)."""
    return _definition_of(strip_space(F.coalesce(c, F.lit(""))))


def _definition_of(t: Column) -> Column:
    # Most lines have no dash, which is cheaper to see.
    return (t.contains("-") | t.contains("–") | t.contains("—")) & t.rlike(DEFINITION)


def header_quality(c: Column) -> Column:
    """0 to 1; capitals raise it, sentence ends and very short lines lower it."""
    return _quality_of(strip_space(F.coalesce(c, F.lit(""))))


def _quality_of(t: Column) -> Column:
    letters = F.regexp_count(t, F.lit(LETTER))
    capitals = F.try_divide(F.regexp_count(t, F.lit(UPPER)), letters)
    return (
        F.when(t == "", 0.0)
        .when(t.endswith(".") | t.endswith(";"), 0.2)
        .when(F.size(F.split(t, WS + "+")) <= 2, 0.35)
        .when(letters == 0, 0.5)
        .otherwise(0.5 + F.least(F.lit(0.5), capitals))
        .cast("double")
    )


def header_flags(t: Column, bold: Column) -> tuple[Column, Column]:
    """(header whatever its size, header if its font is large enough) from a ``stripped`` line.

    Both depend on one line only, so they can be computed before the document's
    font threshold is known.
    """
    size = F.length(t)
    legal = t.rlike(LEGAL_HEADER)
    definition = _definition_of(t)
    numbered = _leading_number(t, AFTER_NUMBER).isNotNull() & ~definition & (size >= 5)
    titled = bold & (size <= 160) & t.rlike(TITLE_LIKE) & (_quality_of(t) >= 0.80)
    always = (t != "") & (legal | numbered | (~definition & titled))
    by_size = (t != "") & ~definition & (size <= 240)
    return F.coalesce(always, F.lit(False)), F.coalesce(by_size, F.lit(False))
