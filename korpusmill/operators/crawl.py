"""Scoped breadth-first closure over page links, for many roots at once.

Links are a table bucketed by URL, visited URLs one bucketed by root and URL
that grows by a partition a level. So a level shuffles its frontier alone: the
frontier meets the links in their buckets, what it finds meets the visited in
theirs. All lie in the shared working folder: lineage does not grow and a lost
executor costs one task, not the crawl.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from korpusmill.functions.url import canonical_url, looks_like_file, scope_path, url_host, url_path, within_scope
from korpusmill.operators.webdocs import page_links
from korpusmill.profiles import SiteProfile
from korpusmill.session import shared_folder, store

VISITED = "root_url string, url string, level int"


def crawl_roots(seeds: DataFrame, profile: SiteProfile, strict_parity: bool = False) -> DataFrame:
    """Canonical roots with their host and scope from a ``root_url`` column."""
    root = canonical_url(F.col("root_url"), profile.strip_default_ports)
    return (
        seeds.select(root.alias("root_url"))
        .distinct()
        .withColumn("root_host", url_host(F.col("root_url")))
        .withColumn("root_scope", scope_path(url_path(F.col("root_url")), profile, strict_parity))
    )


def link_table(pages: DataFrame, profile: SiteProfile, strict_parity: bool = False) -> DataFrame:
    """(url, link, link_scope): links within one host that are not files.

    Links to other hosts can never be admitted, whatever the root.
    """
    # The outer form spares Spark a second look at the links only to skip empty ones.
    linked = page_links(pages, profile).withColumn("link", F.explode_outer("links"))
    local = (url_host(F.col("link")) == url_host(F.col("url"))) & ~looks_like_file(F.col("link"))
    return linked.where(local).select(
        "url", "link", scope_path(url_path(F.col("link")), profile, strict_parity).alias("link_scope")
    )


def admitted(host: Column, root_host: Column, path_scope: Column, root_scope: Column) -> Column:
    """Same host and inside the root's subtree."""
    return (host == root_host) & within_scope(path_scope, root_scope)


def discover(
    pages: DataFrame,
    seeds: DataFrame,
    profile: SiteProfile,
    max_pages: int | None = None,
    strict_parity: bool = False,
    links: DataFrame | None = None,
) -> DataFrame:
    """(root_url, url, level) of everything reachable from each root in its scope.

    ``links`` may give the ``link_table`` of the pages.

    ``max_pages`` limits each root, lower levels first, then by URL. Profiles
    that count fetched pages return only URLs that have a page, and only those
    use up the limit; a URL without a page never leads further.
    """
    spark = pages.sparkSession
    home, name = shared_folder(spark, "crawl"), f"crawl_{uuid.uuid4().hex}"
    roots = crawl_roots(seeds, profile, strict_parity).where(~looks_like_file(F.col("root_url")))
    fresh = roots.select("root_url", F.col("root_url").alias("url"), "root_scope")
    fetched = None
    if profile.cap_counts_fetched:
        has_page = pages.where(F.col("html").isNotNull())
        fetched = has_page.select(canonical_url(F.col("url"), profile.strip_default_ports).alias("url")).distinct()
        fetched = store(fetched, f"{home}/fetched")
    number = 0
    try:
        links = link_table(pages, profile, strict_parity) if links is None else links
        links = bucketed(links, f"{name}_links", f"{home}/links", "url")
        while True:
            visited = spark.table(f"{name}_visited") if number else None
            if fetched is not None:
                fresh = fresh.join(fetched, "url", "left_semi")
            if max_pages is not None:
                fresh = _within_limit(fresh, visited, max_pages)
            rows = Observation()
            level = fresh.select("root_url", "url", "root_scope", F.lit(number).alias("level")).observe(rows, F.count("*").alias("n"))
            bucketed(level, f"{name}_visited", f"{home}/visited", "root_url", "url", partition="level")
            if not rows.get["n"]:
                break
            visited = spark.table(f"{name}_visited")
            fresh = next_level(visited.where(F.col("level") == number), links, visited)
            number += 1
    finally:
        for table in ("links", "visited"):
            spark.sql(f"DROP TABLE IF EXISTS {name}_{table}")  # the files stay
    if not number:
        return spark.createDataFrame([], VISITED)
    return spark.read.schema("root_url string, url string, root_scope string, level int").parquet(f"{home}/visited").drop("root_scope")


def bucketed(df: DataFrame, name: str, path: str, *keys: str, partition: str | None = None) -> DataFrame:
    """Adds rows to a table of as many buckets as shuffles have partitions; joins on its keys need no exchange of it."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").mode("append").option("path", path).bucketBy(buckets, *keys)
    (writer.partitionBy(partition) if partition else writer).saveAsTable(name)
    return spark.table(name)


def next_level(level: DataFrame, links: DataFrame, visited: DataFrame) -> DataFrame:
    """Links of the level's URLs inside their root's scope that no level holds."""
    reached = level.select("root_url", "root_scope", "url").join(links, "url")
    inside = reached.where(within_scope(F.col("link_scope"), F.col("root_scope")))
    found = inside.groupBy("root_url", F.col("link").alias("url")).agg(F.min("root_scope").alias("root_scope"))
    return found.join(visited.select("root_url", "url"), ["root_url", "url"], "left_anti")


def _within_limit(fresh: DataFrame, visited: DataFrame | None, max_pages: int) -> DataFrame:
    """The first rows per root that fit its remaining budget.

    The constant bound lets Spark cut each task's rows before the shuffle.
    """
    ranked = fresh.withColumn("_rank", F.row_number().over(Window.partitionBy("root_url").orderBy("url")))
    ranked = ranked.where(F.col("_rank") <= max_pages)
    if visited is None:
        return ranked.drop("_rank")
    used = visited.groupBy("root_url").agg(F.count("*").alias("_used"))
    return ranked.join(used, "root_url").where(F.col("_rank") + F.col("_used") <= max_pages).drop("_rank", "_used")


def crawl_accounts(pages: DataFrame, seeds: DataFrame, profile: SiteProfile, strict_parity: bool = False) -> DataFrame:
    """What a crawl of each root did: ``root_url, visited, discovered, enqueued, failed, saved``.

    Pages are visited by level, then by URL. ``discovered`` URLs are those that
    links led to. ``enqueued`` counts a URL once for every visited page that
    links to it before it is visited itself, so repeats count. ``failed`` are
    visited URLs without a fetched page, which lead no further; ``saved`` are
    the others. So visited = failed + saved, and enqueued >= discovered.
    """
    links = store(link_table(pages, profile, strict_parity), shared_folder(pages.sparkSession, "crawl-links"))
    every = replace(profile, cap_counts_fetched=False)
    seen = discover(pages, seeds, every, None, strict_parity, links)
    place = F.struct("level", "url")
    to = seen.select("root_url", F.col("url").alias("link"), place.alias("to"))
    edges = seen.select("root_url", "url", place.alias("at")).join(links.select("url", "link").distinct(), "url").join(to, ["root_url", "link"])
    enqueued = edges.where(F.col("to") > F.col("at")).groupBy("root_url").agg(F.count("*").alias("enqueued"))
    fetched = pages.where(F.col("html").isNotNull()).select(canonical_url(F.col("url"), profile.strip_default_ports).alias("url"), F.lit(1).alias("_page")).distinct()
    counts = seen.join(fetched, "url", "left").groupBy("root_url").agg(
        F.count("*").alias("visited"),
        F.count_if(F.col("level") > 0).alias("discovered"),
        F.count_if(F.col("_page").isNull()).alias("failed"),
        F.count("_page").alias("saved"),
    )
    repeats = F.coalesce("enqueued", F.lit(0)).cast("bigint").alias("enqueued")
    return counts.join(enqueued, "root_url", "left").select("root_url", "visited", "discovered", repeats, "failed", "saved")


def crawl_counts(discovered: DataFrame, records: DataFrame) -> DataFrame:
    """Per root: URLs discovered and pages saved."""
    saved = records.select(F.col("url"), F.lit(1).alias("_saved")).distinct()
    return discovered.join(saved, "url", "left").groupBy("root_url").agg(
        F.count("*").alias("discovered"), F.count("_saved").alias("saved")
    )
