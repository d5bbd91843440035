"""Language labels and the folders they route to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from korpusmill.functions.text import WS

# Letters only Kyrgyz uses among the three languages.
KYRGYZ = "[ҢңҮүӨө]"
CYRILLIC = "[А-Яа-яЁё]"
LATIN = r"\p{IsLatin}"
_LATIN_RUN = r"[A-Za-z[\p{IsLatin}&&[^\x00-\x7f]]]"  # the same letters, ASCII ones by a bitmap
FOLDERS = {"ru": "russian", "ky": "kyrgyz", "en": "english"}


def script_language(t: Column) -> Column:
    """en or ru by the commoner script; a text without letters counts as Russian."""
    # Runs of letters are cut out at once, which is cheaper than a match a letter.
    cyrillic = F.length(t) - F.length(F.regexp_replace(t, f"{CYRILLIC}++", ""))
    latin = F.length(t) - F.length(F.regexp_replace(t, f"{_LATIN_RUN}++", ""))
    # Letters are only counted in texts that mix the scripts.
    return (
        F.when(~t.rlike(CYRILLIC), F.when(t.rlike(r"\p{L}"), "en").otherwise("ru"))
        .when(~t.rlike(LATIN), "ru")
        .when(cyrillic >= latin, "ru")
        .otherwise("en")
    )


def detect_language(c: Column) -> Column:
    """ru, ky or en from the scripts in use; a Kyrgyz letter decides at once, a blank text is Russian."""
    t = F.coalesce(c, F.lit(""))
    return F.when(~t.rlike(rf"[^{WS}]"), "ru").when(t.rlike(KYRGYZ), "ky").otherwise(script_language(t))


def lang_to_folder(c: Column) -> Column:
    code = F.lower(F.coalesce(c, F.lit("")))
    out = F.lit("other")
    for lang, folder in FOLDERS.items():
        out = F.when(code == lang, folder).otherwise(out)
    return out
