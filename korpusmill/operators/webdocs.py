"""From fetched pages to web documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.functions import html as H
from korpusmill.functions.dom import clean_markup_udf
from korpusmill.functions.text import normalize_space, sanitize_filename, short_about, trim_footer_noise
from korpusmill.functions.url import canonical_url, category_name, subcategory_path, url_path
from korpusmill.profiles import SiteProfile


def _optional(df: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default) if name in df.columns else default


def with_clean_markup(pages: DataFrame, profile: SiteProfile, out: str = "cleaned") -> DataFrame:
    """Drop unwanted elements; only irregular pages are sent to the Python tree builder."""
    dropped = pages.withColumn("_dropped", H.drop_elements(F.col("html"), profile.drop_tags))
    routed = dropped.withColumn(
        "_tree", F.when(H.needs_tree(F.col("html"), F.col("_dropped"), profile), F.col("html"))
    )
    return routed.withColumn(
        out, F.coalesce(clean_markup_udf(profile)(F.col("_tree")), F.col("_dropped"))
    ).drop("_dropped", "_tree")


def page_links(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    """Canonical URL of every page with its distinct links.

    Links of the rendered page (``js_html``) count only where the plain page
    has fewer than ``profile.min_links``.
    """
    ports = profile.strip_default_ports
    base = _optional(pages, "final_url", F.col("url"))
    links = H.extract_links(H.drop_hidden(F.coalesce("html", F.lit(""))), base, ports)
    found = pages.withColumn("_links", links)
    if "js_html" in pages.columns:
        rendered = H.extract_links(H.drop_hidden(F.coalesce("js_html", F.lit(""))), F.col("url"), ports)
        found = found.withColumn(
            "_links",
            F.when(F.size("_links") < profile.min_links, F.array_union("_links", rendered)).otherwise(
                F.col("_links")
            ),
        )
    return found.select(canonical_url(F.col("url"), ports).alias("url"), F.col("_links").alias("links"))


def page_records(pages: DataFrame, profile: SiteProfile, ordinal: str = "page_id") -> DataFrame:
    """url, title, breadcrumbs, content_text, about of every page that was fetched."""
    fetched = pages.where(F.col("html").isNotNull()).withColumn(
        "_base", _optional(pages, "final_url", F.col("url"))
    )
    texts = H.with_main_text(with_clean_markup(fetched, profile), "cleaned", "_text")
    if "js_text" in pages.columns:
        js = normalize_space(F.col("js_text"))
        wanted = (F.length("_text") < profile.min_http_chars) | H.page_looks_interactive(F.col("html"), profile)
        texts = texts.withColumn(
            "_text", F.when(wanted & (F.length(js) > F.length("_text")), js).otherwise(F.col("_text"))
        )
    if profile.trims_footer:
        texts = texts.withColumn("_text", trim_footer_noise(F.col("_text")))
    visible = texts.withColumn("_visible", H.drop_hidden(F.col("html")))
    return visible.select(
        F.col(ordinal).alias("ordinal"),
        canonical_url(F.col("_base"), profile.strip_default_ports).alias("url"),
        H.extract_title(F.col("_visible")).alias("title"),
        H.extract_breadcrumbs(F.col("_visible")).alias("breadcrumbs"),
        F.col("_text").alias("content_text"),
        short_about(F.col("_text")).alias("about"),
    )


def dedupe_by_url(records: DataFrame, keep: str, keys: tuple[str, ...] = ("url",)) -> DataFrame:
    """One record per key: the first, or the last at the position of the first.

    A grouped aggregate, so copies collapse before the shuffle however many
    there are.
    """
    value = F.struct(*[c for c in records.columns if c not in keys and c != "ordinal"])
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    best = records.groupBy(*keys).agg(
        F.min("ordinal").alias("ordinal"), pick(value, F.col("ordinal")).alias("_value")
    )
    return best.select(*keys, "ordinal", "_value.*")


def prepend_root(records: DataFrame, root: DataFrame) -> DataFrame:
    """Add the root's own record unless its URL is already there; its null ordinal sorts first."""
    missing = root.join(records.select("url"), "url", "left_anti")
    return records.unionByName(missing.withColumn("ordinal", F.lit(None).cast(records.schema["ordinal"].dataType)))


def web_documents(
    records: DataFrame, root_url: Column, category: Column, lang: Column, profile: SiteProfile
) -> DataFrame:
    """The eight output fields; two of them belong to the English layout only."""
    root = canonical_url(root_url, profile.strip_default_ports)
    path = subcategory_path(F.col("breadcrumbs"), url_path(F.col("url")), url_path(root))
    full = records.select(
        "ordinal",
        F.col("url").alias("source_url"),
        root.alias("root_category_url"),
        lang.alias("lang"),
        category.alias("category"),
        path.alias("subcategory_path"),
        "title",
        "about",
        "content_text",
    )
    return full if profile.name == "en" else full.drop("root_category_url", "lang")


def category_of(records: DataFrame, root_url: str, profile: SiteProfile) -> DataFrame:
    """One row: the category a crawl is filed under, and its file name.

    The aggregate gives a row even if the root could not be fetched.
    """
    root = canonical_url(F.lit(root_url), profile.strip_default_ports)
    seen = records.where(F.col("url") == root).agg(
        F.min_by("breadcrumbs", "ordinal").alias("breadcrumbs"), F.min_by("title", "ordinal").alias("title")
    )
    named = seen.select(
        category_name(root, F.col("breadcrumbs"), F.col("title"), profile).alias("category")
    )
    return named.withColumn("file_name", sanitize_filename(F.col("category"), 140, None))
