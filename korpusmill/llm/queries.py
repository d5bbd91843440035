"""Registered queries of the numbered operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korpusmill.llm import collocations, decontaminate, fingerprints, html_extract, license_scan, line_dedup
from korpusmill.llm import maxent_lm, near_dedup, quality, sp_encoding, token_planes, url_filter, whitening
from korpusmill.llm.common import read
from korpusmill.session import shared_folder

QUERIES, ORACLES = {}, {}

SQL_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL_WORDS = "list_filter(string_split_regex({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def _register(name: str, oracle: str | None = None):
    def add(query):
        QUERIES[name] = query
        if oracle:
            ORACLES[name] = oracle
        return query

    return add


# --- 1: URL filter
#: The contract's rules, and the host labels whose pages make up the list of the query.
URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
LISTED_HOSTS = ("cheap-pills", "spam-farm")


def listed_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs of all pages on hosts with a listed label."""
    labels = F.split(url_filter.url_host(F.col("url")), r"\.")
    return pages.where(F.arrays_overlap(labels, F.array(*map(F.lit, LISTED_HOSTS)))).select(url_filter.canonical(F.col("url")).alias("canonical"))


_FITS = " ".join(
    f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
    for r, _ in sorted(URL_RULES, key=lambda r: -len(r[0]))
)
_SAYS = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in URL_RULES)


@_register("op1_url_filter", f"""WITH parts AS (
 SELECT page_id, {SQL_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
  regexp_replace('&' || regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*[?]([^#]*)', 1), '&(utm_[a-z]+|ref)=[^&]*', '', 'g') AS query FROM pages),
forms AS (SELECT page_id, host, path, CASE {_FITS} END AS rule,
  regexp_replace(host, '^www[.]|:(80|443)$', '', 'g') || regexp_replace(path, '/+$', '') ||
  CASE WHEN query IN ('', '&') THEN '' ELSE '?' || substr(query, 2) END AS canonical FROM parts),
listed AS (SELECT DISTINCT canonical FROM forms WHERE len(list_intersect(string_split(host, '.'), {list(LISTED_HOSTS)})) > 0)
SELECT page_id, host, path, rule,
 CASE rule {_SAYS} ELSE CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END END AS verdict FROM forms""")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, listed_urls(pages), URL_RULES).drop("possible")


# --- 2: line dedup
SQL_KEPT_LINES = """doc_lines AS (
 SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {table})),
keyed AS (SELECT *, """ + SQL_LOWER.format("regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')") + """ AS key FROM doc_lines),
owners AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
cut AS (SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE o.owner < k.doc_id) AS n_dropped,
 coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE o.owner IS NULL OR o.owner = k.doc_id), '') AS kept
 FROM keyed k LEFT JOIN owners o ON k.key = o.key GROUP BY k.doc_id)"""


@_register("op2_line_dedup", f"WITH {SQL_KEPT_LINES.format(table='documents')} SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM cut")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


# --- 3: MinHash near-dedup
def sql_components(table: str, words: int, percent: int) -> str:
    """CTEs from ``table`` (doc_id, text) to ``parts`` (doc_id, n_shingles, component_id)."""
    whole = f"list_transform(range(1, len(ws) - {words - 2}), lambda i: array_to_string(ws[i:i + {words - 1}], ' '))"
    return f"""shingle_words AS (SELECT doc_id, {SQL_WORDS.format(SQL_LOWER.format("coalesce(text, '')"))} AS ws FROM {table}),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')] ELSE {whole} END) AS sh FROM shingle_words),
shingle_counts AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
meets AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM meets JOIN shingle_counts x ON x.doc_id = a JOIN shingle_counts y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM {table} UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON reach.r = ways.a),
parts AS (SELECT t.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
 FROM {table} t JOIN reach ON reach.doc_id = t.doc_id LEFT JOIN shingle_counts s ON s.doc_id = t.doc_id GROUP BY t.doc_id)"""


@_register("op3_near_dedup", f"WITH RECURSIVE {sql_components('documents', 2, 80)} SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM parts")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), words=2, percent=80)


# --- 4: licence scan (its rules are regular expressions of another engine; tests compare it with brute force)
@_register("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read(spark, sf_dir, "documents"))


# --- 5: benchmark decontamination
@_register("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("doc", "doc_id")


# --- 6: HTML extraction (the SQL holds for pages whose article has paragraphs and one headline, as all given ones have)
@_register("op6_html_extract", r"""WITH articles AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS a FROM pages),
blocks AS (SELECT page_id, url, list_transform(string_split_regex(a, '</?(?:p|h1)>'), lambda b: trim(regexp_replace(regexp_replace(
 regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(b, '<br>', ' '), '<[^>]*>', '', 'g'),
 '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#x27;?', chr(39), 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS bs FROM articles),
texts AS (SELECT page_id, url, array_to_string(list_filter(bs, lambda b: b <> ''), chr(10) || chr(10)) AS text FROM blocks)
SELECT page_id, url, text, length(text) AS n_chars FROM texts""")
def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(read(spark, sf_dir, "pages"))


# --- 7: document fingerprints
@_register("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(read(spark, sf_dir, "documents"))


# --- 8: LM scoring
@_register("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_texts(read(spark, sf_dir, "documents"))


# --- 9: quality classifier
@_register("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, quality.train(docs, read(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


# --- 10: SentencePiece encoding and decoding
@_register("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_encoding.round_trip(read(spark, sf_dir, "documents"))


# --- 11: token ids in files of bit planes
@_register("op11_token_planes")
def op11_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    token_planes.write_token_files(read(spark, sf_dir, "documents"), path)
    return token_planes.read_token_files(spark, path)


# --- 12: phrase collocations
_CUTS = """SELECT c.lang, c.phrase, c.size, c.a, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score, k
 FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
 JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k], ' ') JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:], ' ')"""


@_register("op12_collocations", f"""WITH parts AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({SQL_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
piece_words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM parts),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM piece_words WHERE len(ws) > 0),
grams AS (SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase FROM places, (SELECT unnest([1, 2, 3]) AS size) WHERE i + size - 1 <= len(ws)),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS ws, f AS a FROM counts WHERE size > 1 AND f >= 10),
cuts AS ({_CUTS}),
scored AS (SELECT lang, phrase, size, a, arg_min(l, score * 4 + k) AS l, arg_min(r, score * 4 + k) AS r, min(score)::BIGINT AS score FROM cuts GROUP BY lang, phrase, size, a),
inner_phrases AS (SELECT lang, a AS b, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM candidates WHERE size = 3),
taken AS (SELECT lang, phrase, max(b) AS b FROM inner_phrases GROUP BY ALL),
left_over AS (SELECT s.* FROM scored s LEFT JOIN taken t ON s.size = 2 AND t.lang = s.lang AND t.phrase = s.phrase WHERE t.b IS NULL OR 100 * t.b < 50 * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM left_over JOIN totals USING (lang) QUALIFY rank <= 2000""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


# --- 13: embedding whitening
@_register("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))
