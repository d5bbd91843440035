import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from korpusmill.operators import language_profiles as lp
from korpusmill.operators.language_profiles import BUCKETS, detect_statistically, label_language, language_scores, learn_profiles
from korpusmill.operators.naming import majority_language

rng = random.Random(4)
RU = "и не в на что быть он с этот как по весь она так из для тот мочь если человек время рука день новый последний город дорога стоять работа книга вода большой дом".split()
KY = "менен анын бар болот деп бир жана кыргыз эл жер суу китеп чоң шаар бала кыз уул тоо ат кой жол айыл башка адам жаңы эски алып келди барды турат эмес".replace("ң", "н").split()
EN = "the of and to in that is was he for it with as his on be at by had not are but from or have an they which one you were her all she there would their".split()
WORDS = {"ru": RU, "ky": KY, "en": EN}


def text(lang, n):
    return ", ".join(rng.choice(WORDS[lang]) for _ in range(n)).capitalize()


def labelled(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id bigint, text string, lang string")


@pytest.fixture(scope="module")
def rows():
    return [(lang, text(lang, rng.randint(5, 40))) for lang in WORDS for _ in range(40)] + [(None, "x y z"), ("en", None), ("en", "12 34"), ("ru", "")]


@pytest.fixture(scope="module")
def profiles(spark, rows):
    return learn_profiles(labelled(spark, rows))


def plain_grams(t):
    t = " " + re.sub(r"[^a-zа-яёңүө]+", " ", (t or "").lower()).strip() + " "
    return [(ord(a) * 961 + ord(b) * 31 + ord(c)) % BUCKETS for a, b, c in zip(t, t[1:], t[2:])]


def test_weights_and_scores_match_a_plain_loop(spark, rows, profiles):
    counts = {lang: Counter(g for own, t in rows if own == lang for g in plain_grams(t)) for lang in WORDS}
    plain = {lang: [math.floor(math.log((c[b] + 1) / (c.total() + BUCKETS)) * 1000 + 0.5) for b in range(BUCKETS)] for lang, c in counts.items()}
    assert list(profiles.weights) == ["en", "ky", "ru"]
    assert all(abs(a - b) <= 1 for lang in plain for a, b in zip(plain[lang], profiles.weights[lang]))
    texts = [t for _, t in rows[::7]] + ["", None, "1", "a", "Ё ё", "é" * 3, "long " * 2000]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(language_scores(F.col("t"), profiles)).collect()
    for t, (s,) in zip(texts, got):
        if t and "é" in t:
            continue
        assert tuple(s) == tuple(sum(profiles.weights[lang][g] for g in plain_grams(t)) for lang in ("en", "ky", "ru"))


def test_held_out_texts_find_their_language(spark, profiles):
    held = [(lang, text(lang, 8)) for lang in WORDS for _ in range(50)]
    found = labelled(spark, held).select("lang", detect_statistically(F.col("text"), profiles).alias("found")).collect()
    assert sum(r["lang"] == r["found"] for r in found) >= 0.97 * len(found)


def test_given_documents_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = learn_profiles(docs.where("doc_id % 2 = 0"), rows=150)
    found = docs.where("doc_id % 2 = 1").select("lang", detect_statistically(F.col("text"), known).alias("found")).collect()
    share = sum(r["lang"] == r["found"] for r in found) / len(found)
    assert share >= 0.9, share


def test_learning_is_bounded_by_rows_and_stable(spark, rows):
    a = learn_profiles(labelled(spark, rows), rows=5)
    b = learn_profiles(labelled(spark, rows).repartition(7), rows=5)
    assert a.weights == b.weights and a.weights != learn_profiles(labelled(spark, rows), rows=6).weights


def test_labels(apply, profiles):
    texts = [None, " \n", "Бул менин үйүм", text("ky", 9), text("ru", 9), text("en", 9), "12 34", "привет", "hello", "the cat which was in что"]
    labels = apply(lambda c: label_language(c, profiles), texts)
    assert labels[:6] == ["ru", "ru", "ky", "ky", "ru", "en"] and labels[6] == "ru" and labels[8:] == ["en", "en"]


def test_other_languages_count_by_script(spark, apply):
    rows = [("de", "der die das und nicht"), ("de", "ein und zwei der"), ("bg", "това е един ден"), ("bg", "това не е")]
    known = learn_profiles(labelled(spark, rows))
    assert apply(lambda c: label_language(c, known), ["der und die", "това е ден"]) == ["en", "ru"]


def test_no_rows_and_no_letters(spark, apply):
    none = learn_profiles(labelled(spark, []))
    assert none.weights == {} and apply(lambda c: label_language(c, none), ["abc", "где"]) == ["en", "ru"]
    assert learn_profiles(labelled(spark, [("en", "1"), (None, "abc")])).weights.keys() <= {"en"}


def test_majority_by_profiles(spark, profiles):
    sections = spark.createDataFrame([(1, text("ky", 9)), (1, text("ky", 9)), (1, text("en", 9)), (2, text("ru", 9))], "doc_id bigint, content string")
    got = majority_language(sections, lambda c: label_language(c, profiles)).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["language"], r["folder"]) for r in got] == [(1, "ky", "kyrgyz"), (2, "ru", "russian")]


def test_texts_are_not_dealt_by_language(spark):
    """The rows to learn from are those of one ranking of all; only texts of the last digest are shuffled."""
    rng = random.Random(3)
    rows = [(rng.choice(["en", "ru", None]), f"text {i}", rng.choice([None, "a", "b", "c", "d", "e", "f"])) for i in range(90)]
    known = spark.createDataFrame(rows, "lang string, text string, digest string")
    for n in (1, 7, 20, 500):
        sure, tied = lp._first_by_digest(known, n)
        assert "Exchange" not in sure._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.lang, r.text) for r in sure.unionByName(tied).collect())
        want = []
        for lang in ("en", "ru"):
            of = sorted((r[2] or "", r[1]) for r in rows if r[0] == lang)[:n]
            want += [(lang, t) for _, t in of]
        assert got == sorted(want)
