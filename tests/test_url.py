from urllib.parse import urljoin

from pyspark.sql import functions as F

from korpusmill.functions import url
from korpusmill.profiles import EN, KG, RU


def test_canonical_url(apply):
    cases = {
        "HTTP://Site.KG:80//a//b/?q=1#f": "http://site.kg/a/b",
        "https://site.kg:443": "https://site.kg/",
        "https://site.kg:8443/": "https://site.kg:8443/",
        "http://site.kg:443/x": "http://site.kg:443/x",
        "//site.kg/a/": "https://site.kg/a",
        "https://site.kg/a;p=1/b;q=2": "https://site.kg/a;p=1/b",
        "mailto:a@b.c": "mailto:a@b.c",
        "tel:+996;ext=1": "tel:+996",
        "/only/path": "https:///only/path",
        " https://site.kg/a\n": "https://site.kg/a",
        "https://site.kg/Кафе/": "https://site.kg/Кафе",
    }
    got = apply(url.canonical_url, list(cases))
    assert got == list(cases.values())
    assert apply(url.canonical_url, got) == got
    assert apply(lambda c: url.canonical_url(c, False), ["HTTP://S.KG:80/"]) == ["http://s.kg:80/"]


def test_join_url_agrees_with_the_standard_library(spark):
    bases = ["https://h.kg/a/b", "https://h.kg/a/b/", "https://h.kg", "http://h.kg/a?x=1#y", "https://h.kg/a/./c/../d"]
    links = [
        "", "x", "./x", "../x", "../../x", "../../../x", "/x/../y", "/x//y", "//o.kg/z", "?q=2", "#top", "?q#t", "x?y=../z",
        "https://o.kg/../k", "mailto:a@b.c", "javascript:void(0)", ".", "..", "./", "../", "a/./b/../c", "tel:+1", "x/..", "Кафе/меню",
    ]
    pairs = [(b, x) for b in bases for x in links]
    df = spark.createDataFrame(pairs, "b string, x string").select("b", "x", url.join_url(F.col("b"), F.col("x")).alias("j"))
    got = {(r.b, r.x): r.j for r in df.collect()}
    assert got == {(b, x): urljoin(b, x) for b, x in pairs}


def scope(spark, path, profile, strict=False):
    return spark.range(1).select(url.scope_path(F.lit(path), profile, strict)).first()[0]


def test_scope_root_covers_its_children(spark):
    assert scope(spark, "/kg/chastnym-klientam/", KG) == "/kg"
    assert scope(spark, "/kg/chastnym-klientam/x", KG) == "/kg/x"
    assert scope(spark, "/kg/chastnym-klientam/", KG, strict=True) == "/kg/chastnym-klientam"
    assert scope(spark, "/kg/chastnym-klientam/x", KG, strict=True) == "/kg/x"
    assert scope(spark, "/kg/chastnym-klientamx", KG) == "/kg/chastnym-klientamx"
    assert scope(spark, "/kg/chastnym-klientam/x", RU) == "/kg/chastnym-klientam/x"
    assert scope(spark, "/EN/chastnym-klientam/x", EN) == "/en/x"
    assert scope(spark, "", EN) == "/" and scope(spark, "//", EN) == "/"


def test_within_scope(spark):
    rows = [("/a", "/a", True), ("/a/b", "/a", True), ("/ab", "/a", False), ("/x", "/", True), ("/", "/a", False)]
    df = spark.createDataFrame(rows, "p string, r string, want boolean")
    assert df.where(url.within_scope(F.col("p"), F.col("r")) != F.col("want")).isEmpty()


def test_files_and_domains(apply, spark):
    assert apply(url.looks_like_file, ["https://a/x.PDF", "https://a/x.pdf/", "https://a/xpdf", "https://a/i.webp"]) == [True, False, False, True]
    same = spark.range(1).select(
        url.same_domain(F.lit("https://A.kg:443/x"), F.lit("http://a.kg/")), url.same_domain(F.lit("https://m.a.kg"), F.lit("https://a.kg"))
    ).first()
    assert tuple(same) == (True, False)


def test_subcategory_path(spark):
    none, crumbs = F.array().cast("array<string>"), F.array(F.lit("Home"))
    row = spark.range(1).select(
        url.subcategory_path(none, F.lit("/kg/a/b"), F.lit("/kg/")), url.subcategory_path(crumbs, F.lit("/kg/a"), F.lit("/kg")),
        url.subcategory_path(none, F.lit("/a/b"), F.lit("/")), url.subcategory_path(none, F.lit("/kg"), F.lit("/kg")),
    ).first()
    assert [list(x) for x in row] == [["a", "b"], ["Home"], ["a", "b"], []]


def test_category_name(spark):
    rows = [
        (["Башкы", "Тарифтер", "HOME"], "t", "Тарифтер"), (["Главная"], "Title", "Title"), ([], None, "uslugi"), (None, "", "uslugi"),
    ]
    df = spark.createDataFrame(rows, "crumbs array<string>, title string, want string")
    got = df.select("want", url.category_name(F.lit("https://h/kg/uslugi/"), F.col("crumbs"), F.col("title"), KG).alias("got"))
    assert [r.got for r in got.collect()] == [r[2] for r in rows]
    root = spark.range(1).select(url.category_name(F.lit("https://h/"), F.lit(None).cast("array<string>"), F.lit(None), KG))
    assert root.first()[0] == "category"
