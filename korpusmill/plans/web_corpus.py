"""A crawl from its root to web documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korpusmill.functions.url import canonical_url, scope_path, url_host, url_path
from korpusmill.operators import webdocs
from korpusmill.operators.crawl import admitted, discover
from korpusmill.profiles import SiteProfile
from korpusmill.session import shared_folder, store


def collect_site(
    pages: DataFrame, root_url: str, profile: SiteProfile, lang: str | None = None, strict_parity: bool = False,
    max_pages: int | None = None,
) -> DataFrame:
    """Documents of everything in the root's scope, from fetched pages.

    The crawl reads the pages' links alone. Its URLs pick the pages by key;
    only these are read again, for their texts. Documents keep crawl order in
    ``ordinal`` (level, then URL). The crawl ends by itself; ``max_pages``
    ends it earlier.
    """
    spark = pages.sparkSession
    ports = profile.strip_default_ports
    seeds = spark.range(1).select(F.lit(root_url).alias("root_url"))
    # A crawl never leaves its root's host and scope: pages elsewhere are set aside before their links are read.
    root = spark.range(1, numPartitions=1).select(canonical_url(F.lit(root_url), ports).alias("url")).first()["url"]
    asked = canonical_url(F.col("url"), ports)
    scope, root_scope = (scope_path(url_path(u), profile, strict_parity) for u in (asked, F.lit(root)))
    pages = pages.where(admitted(url_host(asked), url_host(F.lit(root)), scope, root_scope))
    found = discover(pages, seeds, profile, max_pages, strict_parity)
    # Keys first: page_id and canonical URL of the pages found, then their rows.
    asked = asked.alias("_asked")
    keys = pages.select(F.col("page_id").alias("_id"), asked).join(found.select(F.col("url").alias("_asked"), "level"), "_asked")
    keys = store(keys.distinct(), shared_folder(spark, "site-keys"))
    keyed = pages.withColumn("_asked", asked)
    wanted = keyed.join(keys, (F.col("page_id") == F.col("_id")) & (keyed["_asked"] == keys["_asked"])).drop("_id", keys["_asked"])
    wanted = wanted.withColumn("_ordinal", F.struct("level", "_asked", "page_id"))
    records = webdocs.page_records(wanted, profile, "_ordinal")
    unique = webdocs.dedupe_by_url(records, profile.duplicate_keep)
    category = webdocs.category_of(unique, root_url, profile).select("category").scalar()
    return webdocs.web_documents(unique, F.lit(root_url), category, F.lit(lang or profile.name), profile)
