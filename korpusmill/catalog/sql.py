"""SQL fragments the check queries share. They are written for DuckDB's RE2."""

from __future__ import annotations

WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
D = r"\p{Nd}"
NUM = rf"{D}+(?:\.{D}+)*"


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, by: str = " ", flags: str = "g") -> str:
    return f"regexp_replace({x}, {quote(pattern)}, {quote(by)}, {quote(flags)})"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {quote(pattern)})"


def group(x: str, pattern: str, n: int) -> str:
    return f"regexp_extract({x}, {quote(pattern)}, {n})"


def norm_space(x: str) -> str:
    return f"trim({sub(f'coalesce({x}, {quote(str())})', WS + '+')})"


def norm_lines(x: str) -> str:
    """Line by line, unlike the engine's two-pass version."""
    lines = rf"regexp_split_to_array({x}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"
    return (
        f"array_to_string(list_filter(list_transform({lines}, lambda l: {norm_space('l')}), "
        f"lambda l: l <> ''), chr(10))"
    )


def sanitize(x: str, limit: int = 160, fallback: str | None = "untitled") -> str:
    name = f"trim({sub(norm_space(x), r'[\\/*?:' + chr(34) + '<>|]+', '_')}, ' .')"
    if fallback:
        name = f"coalesce(nullif({name}, ''), {quote(fallback)})"
    return f"left({name}, {limit})"


def language(x: str) -> str:
    cyr = f"len(regexp_extract_all({x}, '[А-Яа-яЁё]'))"
    lat = rf"len(regexp_extract_all({x}, '\p{{Latin}}'))"
    return (
        f"CASE WHEN {norm_space(x)} = '' THEN 'ru' WHEN {has(x, '[ҢңҮүӨө]')} THEN 'ky' "
        f"WHEN {cyr} > 0 AND {cyr} >= {lat} THEN 'ru' WHEN {has(x, chr(92) + 'p{L}')} THEN 'en' ELSE 'ru' END"
    )


def folder(x: str) -> str:
    return (
        f"CASE lower({x}) WHEN 'ru' THEN 'russian' WHEN 'ky' THEN 'kyrgyz' WHEN 'en' THEN 'english' ELSE 'other' END"
    )


def canonical(x: str, ports: bool = True) -> str:
    """For URLs with scheme and host, which all URLs of the given pages are."""
    head = rf"lower({group(x, r'^([A-Za-z]+://[^/?#]*)', 1)})"
    if ports:
        head = sub(sub(head, r"^(http://.*):80$", r"\1"), r"^(https://.*):443$", r"\1")
    path = group(x, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1)
    path = sub(sub(sub(path, r";[^/]*$", ""), "/{2,}", "/"), r"(.)/$", r"\1")
    return f"({head} || coalesce(nullif({path}, ''), '/'))"


def host(x: str) -> str:
    return group(x, r"^[a-z]+://([^/?#]*)", 1)


def path(x: str) -> str:
    return group(x, r"^[a-z]+://[^/?#]*(/.*)$", 1)


ENTITIES = {"&quot;": '"', "&middot;": "·", "&copy;": "©", "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def unescape(x: str) -> str:
    """The references the given pages use; the ampersand comes last."""
    for ref, char in ENTITIES.items():
        x = f"replace({x}, {quote(ref)}, {quote(char)})"
    return x


TAG = r"""<[A-Za-z/!?](?:[^"'>]|"[^"]*"|'[^']*'|["'])*>"""


def drop(x: str, *tags: str) -> str:
    x = sub(x, r"(?s)<!--.*?-->")
    for tag in tags:
        x = sub(x, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>")
    return x


def markup_text(x: str) -> str:
    return norm_space(unescape(sub(x, TAG)))
