"""The queries of the training-data operators on the corpus tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.functions.dialect import SPACES
from quillframe.llm import html, jaccard, lines, packing, pieces, pii, quality, toxicity, vectors, warc
from quillframe.sources.tables import spread, table

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; workers find it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents", "doc_id", "text"))
    return quality.coverage(docs, "doc_id")


def _repetition_sql() -> str:
    """The same measures by joining words to strings instead of rolling hashes over their numbers."""
    grams, covered, chars, over = [], [], [], []
    for n, most in quality.MOST_NGRAM.items():
        words = ", ".join(["w", *(f"lead(w, {k}) OVER t" for k in range(1, n))])
        grams.append(f"CASE WHEN lead(w, {n - 1}) OVER t IS NOT NULL THEN concat_ws(chr(1), {words}) END AS g{n}")
        covered.append(f"coalesce(max(k{n}) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 0) > 1 AS c{n}")
        chars.append(f"coalesce(sum(length(w)) FILTER (WHERE c{n}), 0)::BIGINT AS dup_chars_{n}")
        over.append(f"dup_chars_{n} > {most} * word_chars")
    counted = ", ".join(f"CASE WHEN g{n} IS NOT NULL THEN count(*) OVER (PARTITION BY r, g{n}) END AS k{n}" for n in quality.MOST_NGRAM)
    word, white = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
m AS (SELECT r, regexp_extract_all(text, '{word}') AS ws, string_split(text, chr(10)) AS ls FROM d),
w AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM m),
g AS (SELECT r, i, w, {", ".join(grams)} FROM w WINDOW t AS (PARTITION BY r ORDER BY i)),
k AS (SELECT r, i, w, {counted} FROM g),
c AS (SELECT r, w, {", ".join(covered)} FROM k),
n AS (SELECT r, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars, count(*) FILTER (WHERE c{quality.BASE}) AS n_repeat_words, {", ".join(chars)} FROM c GROUP BY r),
l AS (SELECT r, unnest(ls) AS x, generate_subscripts(ls, 1) AS i FROM m),
y AS (SELECT r, x, row_number() OVER (PARTITION BY r, x ORDER BY i) > 1 AS again, length(regexp_replace(x, '{white}', '', 'g')) AS chars FROM l WHERE regexp_matches(x, '{word}')),
z AS (SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE again) AS n_dup_lines, coalesce(sum(chars) FILTER (WHERE again), 0)::BIGINT AS dup_line_chars FROM y GROUP BY r),
a AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
      coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(dup_line_chars, 0) AS dup_line_chars, {", ".join(f"coalesce(dup_chars_{n}, 0) AS dup_chars_{n}" for n in quality.MOST_NGRAM)}
      FROM d LEFT JOIN n USING (r) LEFT JOIN z USING (r)),
b AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEAT_PERCENT} * n_words AS base_failed FROM a)
SELECT *, NOT base_failed AND NOT (dup_line_chars > {quality.MOST_LINE_CHARS} * word_chars OR {" OR ".join(over)}) AS kept FROM b
"""


ORACLE_SQL["op1_repetition"] = _repetition_sql()


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(spread(table(spark, sf_dir, "documents", "doc_id", "text")))
    base = F.filter("spans", lambda s: s["kind_no"] < len(pii.BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in pii.BASE_KINDS), F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.applied(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id")
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.col("__sha256").alias("kept_sha256"))


ORACLE_SQL["op7_line_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
l AS (SELECT r, doc_id, u.i, u.x FROM d, LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS x, generate_subscripts(string_split(d.text, chr(10)), 1) AS i) u),
k AS (SELECT *, translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, (c.key IS NOT NULL AND k.doc_id <> c.keeper) AS gone FROM k LEFT JOIN common c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.packed(spread(table(spark, sf_dir, "documents", "doc_id", "text")), tokenizer_file(WORD_TOKENIZER), "doc_id")
    return out.select("doc_id", F.col("__piece").alias("piece"), F.col("__start").alias("start"), F.col("__length").alias("length"), F.col("__crc32").alias("ids_crc32"), F.col("__sequence").alias("sequence_id"), F.col("__offset").alias("offset"))


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return vectors.top_k(rows.where(F.col("vec_id") % 50 == 0), rows, 5).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL["op9_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op10_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encoded(spread(table(spark, sf_dir, "documents", "doc_id", "text")), tokenizer_file(PIECE_MODEL), F.xxhash64("doc_id"), "doc_id", with_ids=False)
    return out.select("doc_id", F.col("__n_ids").alias("n_ids"), F.col("__crc32").alias("ids_crc32"), F.col("__lossless").alias("lossless"))


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.classes(spread(table(spark, sf_dir, "documents", "doc_id", "text")))
    return found.select(F.when(~F.col("no_id"), F.col("d")).alias("doc_id"), "class_id", "copy_id", "n_links")


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    out = toxicity.scored(spread(docs), model, "doc_id")
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


@query
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"), "page_id", "url")
    return out.select("page_id", "url", F.col("__main").alias("text"), F.length("__main").cast("long").alias("n_chars"))


# The supplied pages have one article, of a title and paragraphs without class names; on these SQL says it all.
_TEXT_SQL = "regexp_replace(regexp_replace(x, '<br/?>', ' ', 'g'), '<[^>]*>', '', 'g')"
for _name, _sign in (("nbsp", "chr(160)"), ("copy", "chr(169)"), ("middot", "chr(183)"), ("quot", "chr(34)"), ("#39", "chr(39)"), ("#x27", "chr(39)"), ("lt", "'<'"), ("gt", "'>'")):
    _TEXT_SQL = f"replace({_TEXT_SQL}, '&{_name};', {_sign})"
_TEXT_SQL = f"regexp_replace({_TEXT_SQL}, '&amp;?', '&', 'g')"  # titles are cut, some inside a reference
ORACLE_SQL["op8_main_text"] = f"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS body FROM pages),
t AS (SELECT page_id, url, array_to_string(list_filter(list_transform(regexp_split_to_array(body, '</?(?:h1|p)>'),
      lambda x: trim(regexp_replace({_TEXT_SQL}, '[{SPACES}]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM a)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""


@query
def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolved(warc.captures(table(spark, sf_dir, "pages", "page_id", "url", "html")))
    fields = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n")
    return found.select("record_id", F.col("key").alias("canonical_url"), "ts", "base_id", "verdict", "status", fields.alias("fields"))


ORACLE_SQL["op2_revisits"] = r"""
WITH t AS (SELECT page_id AS p, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+/?[^/?#]*)', 1) || CASE WHEN page_id % 3 = 0 THEN '/' WHEN page_id % 3 = 1 THEN '?utm_source=feed' ELSE '#top' END AS url, coalesce(html, '') AS html FROM pages),
u AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM t),
o AS (SELECT *, lower(regexp_extract(u, '^([a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?@]*@)?[^/?]*)', 1)) AS place,
      regexp_replace(regexp_extract(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS path, regexp_extract(u, '\?(.*)$', 1) AS query FROM u),
h AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(place, '^(http://.*):80$', '\1'), '^(https://.*):443$', '\1'), '^[^:]*://(?:[^@]*@)?', ''), '^www\d*\.', '') AS host,
      array_to_string(list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|fbclid|gclid|ref|sessionid|phpsessid)(=|$)'))), '&') AS rest FROM o),
c AS (SELECT p, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN rest <> '' THEN '?' || rest ELSE '' END END AS key,
      '"' || md5(html)[1:16] || '"' AS tag, 'day ' || (p // 100) AS date, length(html) AS size FROM h),
r AS (SELECT p * 2 AS id, key, p * 10 AS ts, tag, date, size FROM c WHERE p % 11 <> 0 AND p % 13 <> 0),
v AS (SELECT p, p * 2 + 1 AS id, key, p * 10 + 25 AS ts, p % 17 = 0 AS bare, p % 17 <> 0 AND p % 5 = 0 AS dated, CASE WHEN p % 7 = 0 THEN '"changed"' ELSE 'W/' || tag END AS tag, CASE WHEN p % 3 = 0 THEN 'another day' ELSE date END AS date FROM c),
j AS (SELECT v.*, b.id AS base, b.tag AS btag, b.date AS bdate, b.size, row_number() OVER (PARTITION BY v.id ORDER BY b.ts DESC, b.id DESC) AS n FROM v LEFT JOIN r b ON b.key = v.key AND b.ts <= v.ts),
w AS (SELECT *, CASE WHEN base IS NULL THEN 'no_base' WHEN bare THEN 'unchecked' WHEN dated THEN CASE WHEN date = bdate THEN 'resolved' ELSE 'date_mismatch' END
      WHEN regexp_replace(tag, '^W/', '') = btag THEN 'resolved' ELSE 'etag_mismatch' END AS verdict FROM j WHERE n = 1)
SELECT id AS record_id, key AS canonical_url, ts, CASE WHEN verdict = 'resolved' THEN base END AS base_id, verdict, (CASE WHEN verdict = 'resolved' THEN 200 ELSE 304 END)::INTEGER AS status,
  CASE WHEN verdict = 'resolved' THEN concat_ws(chr(10), 'cache-control: max-age=' || CASE WHEN dated THEN '60' ELSE '3600' END, 'content-length: ' || size, 'content-type: text/html', 'etag: ' || CASE WHEN dated THEN btag ELSE tag END, 'last-modified: ' || bdate)
       WHEN dated THEN concat_ws(chr(10), 'content-length: 0', 'last-modified: ' || date)
       ELSE concat_ws(chr(10), 'cache-control: max-age=3600', CASE WHEN NOT bare AND p % 4 = 0 THEN 'connection: X-Trace' END, 'content-length: 0', CASE WHEN NOT bare THEN 'etag: ' || tag END, CASE WHEN NOT bare AND p % 4 = 0 THEN 'x-trace: ' || p END) END AS fields
FROM w
"""
