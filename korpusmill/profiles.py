"""Per-language site profiles: the only things that differ between crawls."""

from __future__ import annotations

from dataclasses import dataclass

# Keyword lists and limits that decide which markup is noise.
_NOISE_COMMON = (
    "cookie", "consent", "banner", "popup", "modal", "overlay", "subscribe",
    "newsletter", "social", "share", "pagination", "pager", "search", "lang",
    "language", "chat", "callback", "widget",
)
_NOISE_FOOTER = (
    "menu", "navbar", "sidebar", "footer", "copyright", "legal", "policy",
    "agreement", "terms", "privacy", "offerta", "оферт", "политик", "соглаш",
)
_ALWAYS_DROPPED = ("script", "style", "noscript", "svg")
_LAYOUT_TAGS = ("header", "footer", "nav", "aside")


@dataclass(frozen=True)
class SiteProfile:
    name: str
    strip_default_ports: bool
    scope_langs: tuple[str, ...]
    drop_tags: tuple[str, ...]
    noise_words: tuple[str, ...]
    noise_max_chars: int
    min_http_chars: int
    interactive_words: tuple[str, ...]
    home_words: tuple[str, ...]
    trims_footer: bool
    duplicate_keep: str
    cap_counts_fetched: bool
    scope_alias: str = "chastnym-klientam"
    min_links: int = 8


EN = SiteProfile(
    name="en",
    strip_default_ports=False,
    scope_langs=("ru", "kg", "en"),
    drop_tags=_ALWAYS_DROPPED,
    noise_words=_NOISE_COMMON,
    noise_max_chars=2000,
    min_http_chars=200,
    interactive_words=("more", "read", "details", "expand", "show", "load", "подробнее", "далее"),
    home_words=("home",),
    trims_footer=False,
    duplicate_keep="last",
    cap_counts_fetched=True,
)

RU = SiteProfile(
    name="ru",
    strip_default_ports=True,
    scope_langs=("ru", "en"),
    drop_tags=_ALWAYS_DROPPED + _LAYOUT_TAGS,
    noise_words=_NOISE_COMMON + _NOISE_FOOTER,
    noise_max_chars=2500,
    min_http_chars=120,
    interactive_words=("подробнее", "далее", "раскрыть", "показать", "more", "read"),
    home_words=("главная", "home"),
    trims_footer=True,
    duplicate_keep="first",
    cap_counts_fetched=False,
)

KG = SiteProfile(
    name="kg",
    strip_default_ports=True,
    scope_langs=("ru", "kg", "en"),
    drop_tags=RU.drop_tags,
    noise_words=RU.noise_words,
    noise_max_chars=2500,
    min_http_chars=120,
    interactive_words=RU.interactive_words + ("көбүрөөк", "толугураак", "ачуу"),
    home_words=("башкы", "главная", "home"),
    trims_footer=True,
    duplicate_keep="first",
    cap_counts_fetched=False,
)

PROFILES = {p.name: p for p in (EN, RU, KG)}
