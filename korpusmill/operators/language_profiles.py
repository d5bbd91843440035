"""A statistical language detector: character trigram profiles, learned and scored by Spark.

A text is lower-cased, everything but letters becomes one blank, and each three
neighbouring characters fall into one of BUCKETS by their code points. A
profile has, for each language, a whole-number log weight a bucket; a text's
score is the sum over its trigrams, folded inside the JVM. Profiles have one
size whatever they are learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korpusmill.functions.language import KYRGYZ, script_language
from korpusmill.functions.text import WS
from korpusmill.session import shared_folder, store

BUCKETS = 1 << 13
#: Texts a language is learned from at most (those of the smallest digests), and parts of a log unit in a weight.
ROWS_A_LANGUAGE, SCALE = 2000, 1000


@dataclass
class LanguageProfiles:
    """Weights by language and bucket; languages in alphabetical order."""

    weights: dict[str, list[int]]


def letters_of(c: Column) -> Column:
    """Lower-case letters, all else one blank; blanks at both ends."""
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\P{L}+", " ")), F.lit(" "))


def _bucket(first: Column, second: Column, third: Column) -> Column:
    return F.pmod(first * 961 + second * 31 + third, F.lit(BUCKETS))


def _fold(c: Column, start: list[Column], step, fields: list[str]) -> Column:
    """Over all trigrams of ``c``: ``step(sums, bucket)`` gives the new sums. The state also has the last two code points."""
    state = F.struct(*(s.alias(f) for s, f in zip(start, fields)), F.lit(-1).alias("p"), F.lit(-1).alias("q"))

    def take(acc, char):
        code = F.ascii(char)
        sums = step([acc[f] for f in fields], _bucket(acc["p"], acc["q"], code))
        kept = (F.when(acc["p"] >= 0, s).otherwise(acc[f]).alias(f) for s, f in zip(sums, fields))
        return F.struct(*kept, acc["q"].alias("p"), code.alias("q"))

    return F.aggregate(F.split(letters_of(c), ""), state, take)


def _first_by_digest(known: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """(lang, text) of a language's ``rows`` smallest digests (null first): those below the last of them, and its own.

    Digests are ranked without texts. Only texts that share the last digest,
    mostly one a language, are ranked themselves, by text.
    """
    digest = F.coalesce("digest", F.lit(""))
    ranked = known.select("lang", digest.alias("digest")).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("digest")))
    taken = ranked.where(F.col("rank") <= rows).groupBy("lang", "digest").agg(F.count("*").alias("n"))
    last = taken.groupBy("lang").agg(F.max(F.struct("digest", "n")).alias("last"))  # a row a language
    near = known.withColumn("digest", digest).join(F.broadcast(last), "lang").where("digest <= last.digest")
    near = store(near, shared_folder(known.sparkSession, "profile-texts"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("text"))
    tied = near.where("digest = last.digest").withColumn("place", place).where("place <= last.n")
    return near.where("digest < last.digest").select("lang", "text"), tied.select("lang", "text")


def learn_profiles(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", rows: int = ROWS_A_LANGUAGE) -> LanguageProfiles:
    """Profiles of all languages that ``docs`` names.

    Each is learned from the whole texts of ``rows`` rows at most, those whose
    keys have the smallest MD5 digests. Rows without language or letters teach
    nothing. Weights are log((count + 1) / (all + BUCKETS)).
    """
    known = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.md5(F.col(key).cast("string")).alias("digest"))
    sure, tied = _first_by_digest(known, rows)
    chosen = sure.unionByName(tied)
    chars = F.split(letters_of(F.col("text")), "")
    coded = chosen.select("lang", F.transform(chars, F.ascii).alias("codes"))
    grams = coded.select("lang", F.explode(F.arrays_zip(F.col("codes").alias("a"), F.slice("codes", 2, F.size("codes")).alias("b"), F.slice("codes", 3, F.size("codes")).alias("c"))).alias("g"))
    counted = grams.where("g.c is not null").groupBy("lang", _bucket(F.col("g.a"), F.col("g.b"), F.col("g.c")).alias("bucket")).agg(F.count("*").alias("n"))
    counts: dict[str, dict[int, int]] = {}
    total = F.sum("n").over(Window.partitionBy("lang"))
    weight = lambda n: F.round(F.log((n + F.lit(1.0)) / (total + BUCKETS)) * SCALE).cast("int")
    blank: dict[str, int] = {}
    for r in counted.select("lang", "bucket", weight(F.col("n")).alias("w"), weight(F.lit(0)).alias("none")).collect():  # BUCKETS rows a language at most
        counts.setdefault(r["lang"], {})[r["bucket"]] = r["w"]
        blank[r["lang"]] = r["none"]
    return LanguageProfiles({lang: [counts[lang].get(b, blank[lang]) for b in range(BUCKETS)] for lang in sorted(counts)})


def language_scores(c: Column, profiles: LanguageProfiles) -> Column:
    """A struct with one sum (bigint) a language, in alphabetical order: ``s0``, ``s1`` and so on."""
    tables = [F.split(F.lit(",".join(map(str, w))), ",").cast("array<int>") for w in profiles.weights.values()]  # folded to constants
    fields = [f"s{i}" for i in range(len(tables))]
    folded = _fold(c, [F.lit(0).cast("bigint")] * len(tables), lambda sums, b: [s + F.get(t, b) for s, t in zip(sums, tables)], fields)
    return F.struct(*(folded[f].alias(f) for f in fields))


def best_language(scores: Column, profiles: LanguageProfiles) -> Column:
    """The language of the largest sum, the alphabetically first of equal ones; null if all sums are 0 (no letters)."""
    names = list(profiles.weights)
    top = F.greatest(*(scores[f"s{i}"] for i in range(len(names)))) if len(names) > 1 else scores["s0"]
    out = F.lit(None).cast("string")
    for i in reversed(range(len(names))):
        out = F.when(scores[f"s{i}"] == top, names[i]).otherwise(out)
    return F.when(top < 0, out)


def detect_statistically(c: Column, profiles: LanguageProfiles) -> Column:
    """The learned language whose profile fits best; null for texts without letters, or if none was learned."""
    if not profiles.weights:
        return F.lit(None).cast("string")
    return best_language(language_scores(c, profiles), profiles)


def label_language(c: Column, profiles: LanguageProfiles) -> Column:
    """ru, ky or en: blank texts are ru, a Kyrgyz letter makes ky; then the detected language if it is one of these, else the scripts decide."""
    t = F.coalesce(c, F.lit(""))
    found = F.substring(detect_statistically(t, profiles), 1, 2)
    return (
        F.when(~t.rlike(rf"[^{WS}]"), "ru")
        .when(t.rlike(KYRGYZ), "ky")
        .otherwise(F.coalesce(F.when(found.isin("ru", "en", "ky"), found), script_language(t)))
    )
