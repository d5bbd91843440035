"""URL normalization, resolution and crawl scope as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from korpusmill.profiles import SiteProfile

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
_PARTS = rf"^(?:({_SCHEME}):)?(?://([^/?#]*))?([^?#]*)"

# Schemes whose URLs carry a host, and file suffixes.
HOST_SCHEMES = ("", "ftp", "file", "http", "https", "sftp", "ws", "wss")
PARAM_SCHEMES = ("", "ftp", "http", "https", "sftp", "tel", "sip", "sips", "mms", "rtsp")
FILE_SUFFIXES = (
    "pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx",
    "zip", "rar", "7z", "png", "jpg", "jpeg", "webp",
)
FILE_PATTERN = rf"(?i)\.(?:{'|'.join(FILE_SUFFIXES)})\z"


def _clean(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"^[\x00-\x20]+|[\t\r\n]+", "")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _parts(url: Column) -> Column:
    return F.struct(
        F.lower(F.regexp_extract(url, _PARTS, 1)).alias("scheme"),
        F.regexp_extract(url, _PARTS, 2).alias("host"),
        F.regexp_extract(url, _PARTS, 3).alias("path"),
    )


def _build(scheme: Column, host: Column, path: Column) -> Column:
    hosted = (host != "") | (scheme.isin(*HOST_SCHEMES) & path.startswith("/"))
    return F.concat(scheme, F.when(hosted, F.lit("://")).otherwise(F.lit(":")), host, path)


def canonical_url(url: Column, strip_default_ports: bool = True) -> Column:
    """Lower-case scheme and host, single slashes, no trailing slash, no query or fragment."""

    def rebuild(p: Column) -> Column:
        scheme = F.when(p["scheme"] == "", "https").otherwise(p["scheme"])
        host = F.lower(p["host"])
        if strip_default_ports:
            host = (
                F.when(scheme == "http", F.regexp_replace(host, r":80\z", ""))
                .when(scheme == "https", F.regexp_replace(host, r":443\z", ""))
                .otherwise(host)
            )
        params = F.when(scheme.isin(*PARAM_SCHEMES), r";[^/]*\z").otherwise(r"(?!)")
        path = F.regexp_replace(F.regexp_replace(p["path"], params, F.lit("")), "/{2,}", "/")
        path = F.regexp_replace(path, r"(?<=.)/\z", "")
        return _build(scheme, host, F.coalesce(F.nullif(path, F.lit("")), F.lit("/")))

    return let(_parts(_clean(url)), rebuild)


def url_host(canonical: Column) -> Column:
    return F.regexp_extract(canonical, _PARTS, 2)


def url_path(canonical: Column) -> Column:
    return F.regexp_extract(canonical, _PARTS, 3)


def _resolve_dots(path: Column) -> Column:
    """Fold away ``.`` and ``..`` segments."""
    parts = F.split(path, "/", -1)
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, seg: F.when(seg == ".", done)
        .when(seg == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, seg)),
    )
    ends_in_dots = F.element_at(parts, -1).isin(".", "..")
    return F.concat(F.array_join(folded, "/"), F.when(ends_in_dots, "/").otherwise(""))


def join_url(base: Column, href: Column) -> Column:
    """Resolve a link against the page it stands on."""
    link = _clean(href)
    target = F.struct(
        link.alias("link"), _parts(link).alias("p"), F.regexp_extract(link, r"[?#](?s:.*)\z", 0).alias("suffix")
    )
    joined = let(split_base(base), lambda b: let(target, lambda t: _join(b, t)))
    return F.when(link == "", base).otherwise(joined)


def split_base(base: Column) -> Column:
    """What ``join_url`` needs to know of a page's URL: its parts, folder and query."""
    clean = _clean(base)
    path = F.regexp_extract(clean, _PARTS, 3)
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, r"[^/]*\z", ""))
    return F.struct(
        _parts(clean).alias("p"), folder.alias("folder"), F.regexp_extract(clean, r"^[^?#]*(\?[^#]*)", 1).alias("query")
    )


def _join(base: Column, target: Column) -> Column:
    b, t, link, suffix = base["p"], target["p"], target["link"], target["suffix"]
    merged = F.when(t["path"].startswith("/"), t["path"]).otherwise(
        F.regexp_replace(F.concat(base["folder"], t["path"]), "/{2,}", "/")
    )

    def finish(path: Column) -> Column:
        resolved = F.when(path.rlike(r"(?:^|/)\.{1,2}(?:/|\z)"), _resolve_dots(path)).otherwise(path)
        slash = F.when((b["host"] != "") & ~resolved.startswith("/"), "/").otherwise("")
        return F.concat(_build(b["scheme"], b["host"], F.concat(slash, resolved)), suffix)

    same_page = F.concat(b["path"], F.when(suffix.startswith("?"), "").otherwise(base["query"]))
    return (
        F.when((t["scheme"] != "") & ((t["scheme"] != b["scheme"]) | ~t["scheme"].isin(*HOST_SCHEMES)), link)
        .when(t["host"] != "", F.concat(_build(b["scheme"], t["host"], t["path"]), suffix))
        .when(t["path"] == "", F.concat(_build(b["scheme"], b["host"], same_page), suffix))
        .otherwise(let(merged, finish))
    )


def looks_like_file(url: Column) -> Column:
    return url.rlike(FILE_PATTERN)


def same_domain(a: Column, b: Column, strip_default_ports: bool = True) -> Column:
    return url_host(canonical_url(a, strip_default_ports)) == url_host(canonical_url(b, strip_default_ports))


def scope_path(path: Column, profile: SiteProfile, strict_parity: bool = False) -> Column:
    """Path with the parallel per-language prefix folded away.

    The prefix is also folded when nothing follows it, so that a root given as
    ``/kg/<alias>`` covers its own children. ``strict_parity`` folds it only
    before a slash.
    """
    p = F.regexp_replace(F.coalesce(path, F.lit("")), "/{2,}", "/")
    p = F.regexp_replace(p, r"/\z", "")
    follows = "(?=/)" if strict_parity else r"(?=/|\z)"
    for lang in profile.scope_langs:
        p = F.regexp_replace(p, rf"(?i)^/{lang}/{profile.scope_alias}{follows}", f"/{lang}")
    return F.when(p == "", "/").otherwise(p)


def within_scope(scoped_path: Column, scoped_root: Column) -> Column:
    """Both arguments already went through ``scope_path``."""
    return (
        (scoped_root == "/")
        | (scoped_path == scoped_root)
        | F.startswith(scoped_path, F.concat(scoped_root, F.lit("/")))
    )


def subcategory_path(breadcrumbs: Column, page_path: Column, root_path: Column) -> Column:
    """Breadcrumbs if there are any, else the path segments below the root."""
    below = F.replace(page_path, F.regexp_replace(root_path, r"/+\z", ""), F.lit(""))
    return F.when(F.size(breadcrumbs) > 0, breadcrumbs).otherwise(
        F.filter(F.split(below, "/"), lambda s: s != "")
    )


def category_name(root_url: Column, breadcrumbs: Column, title: Column, profile: SiteProfile) -> Column:
    """Last breadcrumb that is not the home page, else title, else last path segment."""
    named = F.filter(
        F.coalesce(breadcrumbs, F.array().cast("array<string>")),
        lambda c: (c != "") & ~F.lower(c).isin(*profile.home_words),
    )
    segment = F.regexp_extract(url_path(root_url), r"([^/]*)/*\z", 1)
    return F.coalesce(
        F.try_element_at(named, F.lit(-1)),
        F.nullif(title, F.lit("")),
        F.nullif(segment, F.lit("")),
        F.lit("category"),
    )
