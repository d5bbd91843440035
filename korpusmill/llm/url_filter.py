"""URL filter: host and path rules, and a list of canonical URLs behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.llm.common import ascii_lower

#: A block is eight words of 32 bits; a URL sets one bit in each, by an odd multiplier for each word.
MULTIPLIERS = tuple(pow(0x9E3779B1, i + 2, 1 << 31) | 1 for i in range(8))
BITS_PER_URL = 16


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without trailing slashes, query without tracking; no scheme or fragment."""
    host = F.regexp_replace(url_host(url), r"^www\.|:(?:80|443)$", "")
    path = F.regexp_replace(url_path(url), "/+$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.concat(F.lit("&"), query), "&(utm_[a-z]+|ref)=[^&]*", "")
    return F.concat(host, path, F.when(query.isin("", "&"), "").otherwise(F.concat(F.lit("?"), F.substr(query, F.lit(2)))))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, else null. A rule is a host and a path; it fits the host and all subdomains."""
    fits = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        here = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        fits = F.when(here, rule).otherwise(fits)
    return fits


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(key, 32), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    low = key.bitwiseAND(0x7FFFFFFF)
    return [F.call_function("shiftleft", F.lit(1), F.pmod(F.shiftrightunsigned(low * m, 26), F.lit(32)).cast("int")) for m in MULTIPLIERS]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter as a table, one row a block in use: ``block, w0 .. w7``. ``listed`` has the column ``canonical``."""
    keys = listed.where("canonical IS NOT NULL").select(F.xxhash64("canonical").alias("k"))
    bits = keys.select(_block(F.col("k"), blocks).alias("block"), *(m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("k")))))
    return bits.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]], bits_per_url: int = BITS_PER_URL) -> DataFrame:
    """``page_id, host, path, rule, verdict, possible`` for every row of ``pages`` (page_id, url).

    ``rules`` is a hand-written list of (host/path, allow or block): the longest
    that fits decides. All other URLs are blocked if their canonical form is in
    ``listed`` (canonical), else allowed. The filter is a table of blocks whose
    number follows the length of the list. Spark broadcasts it only while it is
    below its own size threshold. Possible hits alone (``possible``) go on to
    an exact join; other rows are not shuffled for it.

    Null or empty URLs, and URLs without ``://``, have an empty host and path
    and fit no rule. Repeated rows are judged one by one. Null or repeated list
    entries do no harm, and an empty list blocks nothing. Other columns are
    ignored.
    """
    url = F.col("url")
    judged = pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"), canonical(url).alias("_canonical"))
    judged = judged.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("_key", F.xxhash64("_canonical"))

    blocks = 1 << max(0, (listed.count() * bits_per_url // 256)).bit_length()
    probed = judged.join(bloom_blocks(listed, blocks), _block(F.col("_key"), blocks) == F.col("block"), "left")
    hit = reduce(and_, (F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col("_key")))))
    probed = probed.withColumn("possible", F.coalesce(F.col("rule").isNull() & hit, F.lit(False)))
    probed = probed.select("page_id", "host", "path", "rule", "_canonical", "possible")

    exact = listed.where("canonical IS NOT NULL").select(F.col("canonical").alias("_canonical")).distinct().withColumn("_listed", F.lit(True))
    possible = probed.where("possible").join(exact, "_canonical", "left")
    rest = probed.where("NOT possible").withColumn("_listed", F.lit(None).cast("boolean"))
    verdict = F.lit(None).cast("string")
    for rule, says in rules:
        verdict = F.when(F.col("rule") == rule, says).otherwise(verdict)
    method = F.when(F.col("_listed"), "block").otherwise("allow")
    return possible.unionByName(rest).select("page_id", "host", "path", "rule", F.coalesce(verdict, method).alias("verdict"), "possible")
