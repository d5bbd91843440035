"""Registered queries on text, language and URL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from korpusmill.catalog import inputs as I
from korpusmill.catalog import sql as q
from korpusmill.functions import headers, text, url
from korpusmill.functions.language import detect_language, lang_to_folder
from korpusmill.operators import language_profiles as L
from korpusmill.profiles import KG, RU

QUERIES, ORACLES = {}, {}


def _register(name, query, oracle=None):
    QUERIES[name] = query
    if oracle:
        ORACLES[name] = oracle


def _digest(c):
    """Whole texts are compared by digest and length."""
    return [F.sha1(c).alias("digest"), F.length(c).cast("bigint").alias("n_chars")]


def _sql_digest(x):
    return f"sha1({x}) AS digest, length({x}) AS n_chars"


_register(
    "normalize_space",
    lambda spark, d: I.spaced_documents(spark, d).select("doc_id", *_digest(text.normalize_space(F.col("text")))),
    f"WITH {I.SPACED}, t AS (SELECT doc_id, {q.norm_space('text')} AS n FROM spaced) SELECT doc_id, {_sql_digest('n')} FROM t",
)
_register(
    "normalize_multiline",
    lambda spark, d: I.spaced_documents(spark, d).select("doc_id", *_digest(text.normalize_multiline(F.col("text")))),
    f"WITH {I.SPACED}, t AS (SELECT doc_id, {q.norm_lines('text')} AS n FROM spaced) SELECT doc_id, {_sql_digest('n')} FROM t",
)
_register(
    "sha1_norm",
    lambda spark, d: I.spaced_documents(spark, d).select("doc_id", text.sha1_norm(F.col("text")).alias("text_hash")),
    f"WITH {I.SPACED} SELECT doc_id, sha1(lower({q.norm_space('text')})) AS text_hash FROM spaced",
)
_register(
    "short_about",
    lambda spark, d: I.table(spark, d, "conversations").select(
        "conv_id", "turn", text.short_about(text.normalize_space(F.col("text"))).alias("about")
    ),
    f"""WITH t AS (SELECT conv_id, turn, {q.norm_space('text')} AS n FROM conversations)
    SELECT conv_id, turn, CASE WHEN n <> '' THEN left(n, 280) || CASE WHEN length(n) > 280 THEN '…' ELSE '' END END AS about FROM t""",
)
_register(
    "sanitize_filename",
    lambda spark, d: I.table(spark, d, "documents").select(
        "doc_id",
        text.sanitize_filename(F.col("text")).alias("section_file"),
        text.sanitize_filename(F.translate("text", "aeiou", '<?"|.'), 140, None).alias("category_file"),
    ),
    f"""SELECT doc_id, {q.sanitize('text')} AS section_file,
    {q.sanitize("translate(text, 'aeiou', '<?" + chr(34) + "|.')", 140, None)} AS category_file FROM documents""",
)
_TAIL = "substr(t, CAST(floor(length(t) * 0.7::DOUBLE) AS INTEGER) + 1)"
_FOOTER_RE2 = "(?i)(?:" + "|".join(text.FOOTER_PHRASES).replace(text.WS, q.WS) + ")"
_register(
    "trim_footer_noise",
    lambda spark, d: I.footed_documents(spark, d).select("doc_id", *_digest(text.trim_footer_noise(F.col("text")))),
    f"""WITH {I.FOOTED}, s AS (SELECT doc_id, trim(text) AS t FROM footed),
    m AS (SELECT doc_id, t, {_TAIL} AS tail, regexp_extract({_TAIL}, {q.quote(_FOOTER_RE2)}) AS hit FROM s),
    c AS (SELECT doc_id, CASE WHEN length(t) < 300 OR hit = '' THEN t
      ELSE rtrim(left(t, length(t) - length(tail) + instr(tail, hit) - 1)) END AS n FROM m)
    SELECT doc_id, {_sql_digest('n')} FROM c""",
)
_register(
    "detect_language",
    lambda spark, d: I.trilingual_documents(spark, d).select(
        "doc_id",
        detect_language(F.col("text")).alias("language"),
        lang_to_folder(F.upper(detect_language(F.col("text")))).alias("folder"),
    ),
    f"""WITH {I.TRILINGUAL}, t AS (SELECT doc_id, {q.language('text')} AS language FROM trilingual)
    SELECT doc_id, language, {q.folder('upper(language)')} AS folder FROM t""",
)


def _detected(spark, d):
    docs = I.table(spark, d, "documents")
    profiles = L.learn_profiles(docs)
    scores = docs.select("doc_id", "text", L.language_scores(F.col("text"), profiles).alias("s"))
    best = L.best_language(F.col("s"), profiles)
    sums = [F.col("s")[f"s{i}"].alias(f"score_{lang}") for i, lang in enumerate(profiles.weights)]
    return scores.select("doc_id", best.alias("detected"), F.when(best.startswith("en"), "en").alias("english"), *sums)


_SQL_LANGS = ("de", "en", "es", "fr")
_register(
    "language_profiles",
    _detected,
    rf"""WITH spelled AS (SELECT doc_id, lang, string_split(' ' || trim(regexp_replace(lower(coalesce(text, '')), '\P{{L}}+', ' ', 'g')) || ' ', '') AS cs FROM documents),
    grams AS (SELECT doc_id, lang, (unicode(cs[i]) * 961 + unicode(cs[i + 1]) * 31 + unicode(cs[i + 2])) % {L.BUCKETS} AS bucket
     FROM (SELECT *, unnest(range(1, len(cs) - 1)) AS i FROM spelled)),
    chosen AS (SELECT doc_id FROM documents WHERE lang IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), text) <= {L.ROWS_A_LANGUAGE}),
    counted AS (SELECT lang, bucket, count(*) AS n FROM grams WHERE doc_id IN (SELECT doc_id FROM chosen) GROUP BY ALL),
    totals AS (SELECT lang, sum(n) AS total FROM counted GROUP BY lang),
    weights AS (SELECT t.lang, b.bucket, CAST(round(ln((coalesce(n, 0) + 1.0) / (total + {L.BUCKETS})) * {L.SCALE}) AS INTEGER) AS w
     FROM totals t CROSS JOIN (SELECT unnest(range({L.BUCKETS})) AS bucket) b LEFT JOIN counted c ON c.lang = t.lang AND c.bucket = b.bucket),
    sums AS (SELECT g.doc_id, w.lang, sum(w.w)::BIGINT AS s FROM (SELECT doc_id, bucket FROM grams) g JOIN weights w USING (bucket) GROUP BY ALL),
    best AS (SELECT doc_id, arg_min(lang, (-s, lang)) AS detected, {', '.join(f"max(s) FILTER (WHERE lang = '{x}') AS score_{x}" for x in _SQL_LANGS)} FROM sums GROUP BY doc_id)
    SELECT d.doc_id, detected, CASE WHEN detected LIKE 'en%' THEN 'en' END AS english, {', '.join(f"coalesce(score_{x}, 0)::BIGINT AS score_{x}" for x in _SQL_LANGS)}
    FROM documents d LEFT JOIN best USING (doc_id)""",
)

# --- header lines
_LETTERS, _UPPERS = headers.LETTER, headers.UPPER
SQL_QUALITY = (
    "CASE WHEN {x} = '' THEN 0.0 WHEN {x} LIKE '%.' OR {x} LIKE '%;' THEN 0.2 "
    "WHEN len(string_split({x}, ' ')) <= 2 THEN 0.35 "
    f"WHEN NOT regexp_matches({{x}}, '{_LETTERS}') THEN 0.5 "
    f"ELSE 0.5 + least(0.5, len(regexp_extract_all({{x}}, '{_UPPERS}')) / len(regexp_extract_all({{x}}, '{_LETTERS}'))) END"
)


def sql_section_key(x: str) -> str:
    return f"nullif({q.group(x, rf'^({q.NUM}){q.WS}*[.)]?{q.WS}*[^\n]{{2,220}}{q.WS}*$', 1)}, '')"


def sql_toc_key(x: str) -> str:
    return f"nullif({q.group(x, rf'^({q.NUM}){q.WS}*[.)]?{q.WS}*[^\n]+?{q.WS}*$', 1)}, '')"


_register(
    "header_quality",
    lambda spark, d: I.document_lines(spark, d).select(
        "doc_id", "side", "line_no", F.round(headers.header_quality(F.col("text")), 9).alias("quality")
    ),
    f"WITH {I.LINES} SELECT doc_id, side, line_no, round(({SQL_QUALITY.format(x='text')})::DOUBLE, 9) AS quality FROM lines",
)
_register(
    "section_keys",
    lambda spark, d: I.document_lines(spark, d).select(
        "doc_id", "side", "line_no",
        headers.section_key(F.col("text")).alias("section_key"),
        headers.toc_section_key(F.col("text")).alias("toc_key"),
        headers.is_definition(F.col("text")).alias("is_definition"),
    ),
    f"""WITH {I.LINES} SELECT doc_id, side, line_no, {sql_section_key('text')} AS section_key, {sql_toc_key('text')} AS toc_key,
    {q.has('text', rf'(?i){q.WS}[–—-]{q.WS}+[a-zа-яёҥүө0-9]')} AS is_definition FROM lines""",
)

# --- URLs
_register(
    "canonical_urls",
    lambda spark, d: I.varied_urls(spark, d).select(
        "page_id",
        url.canonical_url(F.col("url"), False).alias("keeps_ports"),
        url.canonical_url(F.col("url"), True).alias("strips_ports"),
        url.looks_like_file(url.canonical_url(F.col("url"))).alias("is_file"),
    ),
    f"""WITH {I.VARIED} SELECT page_id, {q.canonical('url', False)} AS keeps_ports, {q.canonical('url')} AS strips_ports,
    {q.has(q.canonical('url'), '(?i)' + chr(92) + '.(?:' + '|'.join(url.FILE_SUFFIXES) + ')$')} AS is_file FROM varied""",
)
_register(
    "join_urls",
    lambda spark, d: I.varied_urls(spark, d)
    .withColumn("href", F.explode(F.array(*map(F.lit, ("/abs/x", "rel?q=1#f", "//h.example/z", "#top", "?p=2", "../up", "./a/../b", "mailto:a@b.c", "https://o.example/y")))))
    .select("page_id", "href", url.join_url(F.col("url"), F.col("href")).alias("joined")),
    rf"""WITH {I.VARIED}, h AS (SELECT page_id, url, unnest(['/abs/x','rel?q=1#f','//h.example/z','#top','?p=2','../up','./a/../b','mailto:a@b.c','https://o.example/y']) AS href FROM varied),
    p AS (SELECT page_id, href, lower(regexp_extract(url, '^([A-Za-z]+):', 1)) AS s, regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS h,
      regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS query FROM h),
    dirs AS (SELECT *, regexp_replace(regexp_replace(path, '[^/]*$', ''), '/+', '/', 'g') AS dir FROM p)
    SELECT page_id, href, CASE href WHEN '/abs/x' THEN s || '://' || h || '/abs/x'
      WHEN 'rel?q=1#f' THEN s || '://' || h || dir || 'rel?q=1#f' WHEN '//h.example/z' THEN s || '://h.example/z'
      WHEN '#top' THEN s || '://' || h || path || query || '#top' WHEN '?p=2' THEN s || '://' || h || path || '?p=2'
      WHEN '../up' THEN s || '://' || h || regexp_replace(dir, '[^/]*/$', '') || 'up'
      WHEN './a/../b' THEN s || '://' || h || dir || 'b' ELSE href END AS joined FROM dirs""",
)


def _scope(profile, strict):
    p = url.url_path(url.canonical_url(F.concat(F.lit("https://o.example"), F.col("path"))))
    return url.scope_path(p, profile, strict)


_SCOPE_PATHS = r"""paths AS (SELECT page_id, root, '/' || root || CASE page_id % 3 WHEN 0 THEN '' ELSE '/chastnym-klientam' END
 || CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE '/' || page_id END AS path
 FROM pages, (SELECT unnest(['ru', 'KG', 'en', 'de']) AS root))"""


def _sql_scope(langs: str, strict: bool) -> str:
    after = "(/)" if strict else "(/|$)"
    return q.sub("path", rf"(?i)^/({langs})/chastnym-klientam{after}", r"/\1\2", "")


def _scope_query(spark, d):
    k = F.col("page_id")
    path = F.concat(
        F.lit("/"), F.col("root"),
        F.when(k % 3 == 0, "").otherwise("/chastnym-klientam"),
        F.when(k % 5 == 0, "").when(k % 5 == 1, "x").otherwise(F.concat(F.lit("/"), k.cast("string"))),
    )
    paths = I.table(spark, d, "pages").select("page_id", F.explode(F.array(*map(F.lit, ("ru", "KG", "en", "de")))).alias("root"))
    kg, strict, ru = _scope(KG, False), _scope(KG, True), _scope(RU, False)
    return paths.withColumn("path", path).select(
        "path", "page_id",
        F.lower(kg).alias("kg_scope"), F.lower(strict).alias("strict_scope"), F.lower(ru).alias("ru_scope"),
        url.within_scope(kg, F.lit("/kg")).alias("in_kg"), url.within_scope(kg, F.lit("/")).alias("in_root"),
    )


_register(
    "scope_filter",
    _scope_query,
    f"""WITH {_SCOPE_PATHS}, s AS (SELECT path, page_id, {_sql_scope('ru|kg|en', False)} AS k,
      {_sql_scope('ru|kg|en', True)} AS t, {_sql_scope('ru|en', False)} AS r FROM paths)
    SELECT path, page_id, lower(k) AS kg_scope, lower(t) AS strict_scope, lower(r) AS ru_scope,
    CASE WHEN regexp_matches(path, '(?i)^/kg/chastnym-klientam(/|$)') THEN true ELSE k = '/kg' OR k LIKE '/kg/%' END AS in_kg,
    true AS in_root FROM s""",
)
_register(
    "subcategory_paths",
    lambda spark, d: I.varied_urls(spark, d).select(
        "page_id",
        F.array_join(
            url.subcategory_path(
                F.when(F.col("page_id") % 9 == 0, F.array(F.lit("Home"), F.lit("Tariffs"))).otherwise(F.array().cast("array<string>")),
                url.url_path(url.canonical_url(F.col("url"))), F.lit("/en/"),
            ), ">",
        ).alias("subcategory"),
        url.same_domain(F.col("url"), F.concat(F.lit("https://"), F.upper(url.url_host(F.col("url"))))).alias("same_host"),
    ),
    f"""WITH {I.VARIED}, c AS (SELECT page_id, {q.canonical('url')} AS u, url FROM varied)
    SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'Home>Tariffs'
      ELSE array_to_string(list_filter(string_split(replace({q.path('u')}, '/en', ''), '/'), lambda s: s <> ''), '>') END AS subcategory,
    NOT regexp_matches(url, '(?i)^http://[^/?#]*:443|^http://[^/?#]*:80') AS same_host FROM c""",
)
