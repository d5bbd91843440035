"""Licence scan with DataFrame functions only: phrase places, ordered signature rules, interval containment."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from korpusmill.llm import license_rules

#: Fixed values of the contract: phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal_words(text: Column) -> Column:
    """The text's words in lower case with a space before, between and after them."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")), NO_WORD, " ")


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _places(words: Column, phrase: str) -> Column:
    """Number, first and last start of a phrase, overlaps included; null without one."""
    parts = F.split(words, f" (?={phrase} )", -1)
    last = _spaces(words) - _spaces(F.element_at(parts, -1)) - 1
    found = F.struct((F.size(parts) - 1).cast("bigint").alias("n"), _spaces(parts[0]).cast("bigint").alias("first"), last.cast("bigint").alias("last"))
    return F.when(F.contains(words, F.lit(f" {phrase} ")), found)


def _base(words: Column) -> dict[str, Column]:
    found = [_places(words, p) for p, _ in PHRASES]
    labels = F.array_compact(F.array(*(F.when(f.isNotNull(), label) for f, (_, label) in zip(found, PHRASES))))
    return {
        "n_words": (_spaces(words) - 1).cast("bigint"),
        "n_base": reduce(lambda a, b: a + b, (F.coalesce(f["n"], F.lit(0).cast("bigint")) for f in found)),
        "first_word": F.least(*(f["first"] for f in found)),
        "last_word": F.greatest(*(f["last"] for f in found)),
        "_base": labels,
    }


def rule_table(spark: SparkSession, rules: list[tuple[int, str, int, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "rule int, label string, priority int, keyword string, pattern string")


def detections(texts: DataFrame, rules: list[tuple[int, str, int, str, str]]) -> DataFrame:
    """``key, start, end, priority, rule, label`` of all matches in ``texts`` (key, words: normal words), before suppression."""
    keywords = sorted({r[3] for r in rules})
    held = F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(F.col("words"), F.concat(F.lit(" "), k, F.lit(" "))))
    tried = texts.withColumn("keyword", F.explode(held)).join(rule_table(texts.sparkSession, rules), "keyword")
    hits = tried.where(F.rlike("words", F.col("pattern")))
    gaps = F.transform(F.split("words", F.col("pattern"), -1), lambda p: F.length(p))
    spans = F.transform(F.regexp_extract_all("words", F.col("pattern"), F.lit(0)), lambda m: F.length(m))
    one = hits.select("key", "rule", "label", "priority", F.posexplode(F.arrays_zip(gaps.alias("gap"), spans.alias("span"))).alias("i", "at"))
    before = Window.partitionBy("key", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("at.gap") + F.coalesce(F.sum(F.col("at.gap") + F.col("at.span")).over(before), F.lit(0))
    placed = one.withColumn("start", start).where("at.span IS NOT NULL")
    return placed.select("key", "start", (F.col("start") + F.col("at.span")).alias("end"), "priority", "rule", "label")


def surviving(found: DataFrame) -> DataFrame:
    """Detections that no other of the same or a better priority contains; of equal intervals the best, first rule stays."""
    before = Window.partitionBy("key").orderBy("start", F.desc("end"), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    reaches = [F.max(F.when(F.col("priority") <= p, F.col("end"))).over(before) for p in sorted(license_rules.WEIGHTS)]
    cases = reduce(lambda c, pr: c.when(F.col("priority") == pr[0], pr[1]), zip(sorted(license_rules.WEIGHTS), reaches), F.when(F.lit(False), F.lit(0).cast("bigint")))
    return found.withColumn("_reach", cases).where("_reach IS NULL OR _reach < end").drop("_reach")


def scan_licenses(docs: DataFrame, rules: list[tuple[int, str, int, str, str]] | None = None) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row of ``docs`` (doc_id, text).

    The base columns count the places of three fixed phrases. ``labels`` adds
    those of the signature rules: a rule runs only on texts with its keyword;
    of overlapping matches those contained in one of the same or a better
    priority are dropped. ``score`` is the weight of the best surviving match
    or phrase, 0 without any.

    Texts are scanned whole, equal ones once. A null or empty text has no words
    and no labels (empty strings). Repeated rows give repeated results; other
    columns are ignored.
    """
    rules = license_rules.rules() if rules is None else rules
    keywords = sorted({r[3] for r in rules})
    gate = f" (?:{'|'.join(map(re.escape, keywords))}) " if keywords else "(?!)"
    words = docs.select("doc_id", normal_words(F.col("text")).alias("words")).withColumn("key", F.md5(F.col("words").cast("binary")))
    base = words.select("doc_id", "key", *(c.alias(name) for name, c in _base(F.col("words")).items()))

    gated = words.where(F.rlike("words", F.lit(gate))).groupBy("key").agg(F.first("words").alias("words"))
    weight = reduce(lambda c, pw: c.when(F.col("priority") == pw[0], pw[1]), license_rules.WEIGHTS.items(), F.when(F.lit(False), F.lit(0.0)))
    found = surviving(detections(gated, rules)).groupBy("key").agg(F.collect_set("label").alias("_labels"), F.max(weight).alias("_score"))

    out = base.join(found, "key", "left")
    join = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    score = F.greatest(F.coalesce("_score", F.lit(0.0)), F.when(F.col("n_base") > 0, license_rules.WEIGHTS[2]).otherwise(0.0))
    labels = F.concat("_base", F.coalesce("_labels", F.array().cast("array<string>")))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", join(F.col("_base")).alias("base_labels"), join(labels).alias("labels"), score.alias("score"))
