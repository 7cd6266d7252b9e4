"""Queries: blocks, roles and order-dependent grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillframe.functions import dialect, text as T
from quillframe.operators import aggregates, classify, sequence
from quillframe.plans.corpus import PLAIN, RULES, blocks, texts, turns, with_blocks, with_turns
from quillframe.plans.registry import query
from quillframe.sources.lines import char_total as totals, line_blocks
from quillframe.sources.tables import table


@query(with_blocks("SELECT document, ordinal, locator, raw_text FROM lines"))
def blocks_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_blocks(table(spark, sf_dir, "documents", "doc_id", "text"))


@query(with_blocks("SELECT document, count(*) AS n_blocks, sum(length(raw_text))::BIGINT AS n_chars FROM lines GROUP BY document"))
def char_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(line_blocks(table(spark, sf_dir, "documents", "doc_id", "text")))


@query(with_blocks("SELECT document, ordinal, text FROM texts"))
def collapse_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("document", "ordinal", "text")


@query(with_blocks("SELECT document, ordinal, role FROM roles"))
def role_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks(spark, sf_dir).select("document", "ordinal", "role")


@query(with_blocks("SELECT document, ordinal, role, kind FROM blocks"))
def role_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks(spark, sf_dir).select("document", "ordinal", "role", "kind")


_REGISTERED = ", reg AS (SELECT DISTINCT substr(sha256(b.text), 1, 12) AS banner_id FROM blocks b JOIN documents d ON d.doc_id = b.document WHERE d.lang <> 'en' AND b.ordinal = 1 AND b.text <> '')"


@query(with_blocks(_REGISTERED + " SELECT document, ordinal, CASE WHEN text = '' THEN 'empty' WHEN substr(sha256(text), 1, 12) IN (SELECT banner_id FROM reg) THEN 'banner' WHEN starts_with(text, 'Released under') THEN 'callout-head' ELSE role END AS role FROM blocks"))
def role_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty before registered banners (by hash) before callout heads before the rules; banners are the first lines of documents in other languages."""
    foreign = line_blocks(table(spark, sf_dir, "documents", "doc_id", "text", "lang").where("lang <> 'en'"), derived={"text": T.collapse_ws})
    banners = foreign.where("ordinal = 1 AND text <> ''").select(T.content_id(F.col("text"), 12).alias("banner_id"))
    heads = F.when(F.startswith("text", F.lit("Released under")), "callout-head")
    return classify.precedence(blocks(spark, sf_dir), banners, heads).select("document", "ordinal", "role")


_RUN = "sum((kind = 'section-banner')::INT) OVER w AS section_run"
_CARRY = (
    f", runs AS (SELECT *, {_RUN}, last_value(CASE WHEN kind = 'section-banner' THEN text END IGNORE NULLS) OVER w AS section FROM blocks WINDOW w AS (PARTITION BY document ORDER BY ordinal ROWS UNBOUNDED PRECEDING)), "
    "carry AS (SELECT *, last_value(CASE WHEN kind = 'sub-module' THEN text END IGNORE NULLS) OVER v AS subsection, last_value(CASE WHEN kind = 'section' THEN substr(text, 1, 30) END IGNORE NULLS) OVER v AS node FROM runs WINDOW v AS (PARTITION BY document, section_run ORDER BY ordinal ROWS UNBOUNDED PRECEDING))"
)


@query(with_blocks(f"{_CARRY} SELECT document, ordinal, section, subsection, node FROM carry"))
def carry_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.section_carry(blocks(spark, sf_dir)).select("document", "ordinal", "section", "subsection", "node")


@query(with_blocks(f"{_CARRY} SELECT role, kind, count(*) AS n_blocks, count(DISTINCT document) AS n_documents, count(section) AS n_in_sections, sum(length(text))::BIGINT AS n_chars, sum((text = '')::INT)::BIGINT AS n_empty, max(length(text))::BIGINT AS longest FROM carry GROUP BY role, kind"))
def carve_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: lines, roles, sections, and what there is of each."""
    carried = sequence.section_carry(blocks(spark, sf_dir))
    return aggregates.carve_report(carried, F.count("section").alias("n_in_sections"))


@query(with_blocks(f"{_CARRY} SELECT document, kind, section, count(*) AS n FROM carry GROUP BY document, kind, section"))
def section_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.histogram(sequence.section_carry(blocks(spark, sf_dir)), "document", "kind", "section")


_QUESTIONS = ", open AS (SELECT *, last_value(CASE WHEN kind = 'stem' THEN 'stem' WHEN kind IN ('section', 'sub-module', 'section-banner') THEN 'close' END IGNORE NULLS) OVER w AS state, sum((kind = 'stem')::INT) OVER w AS number FROM {of} WHERE kind <> 'header' WINDOW w AS (PARTITION BY document ORDER BY ordinal ROWS UNBOUNDED PRECEDING)), questions AS (SELECT *, CASE WHEN state = 'stem' THEN number::BIGINT END AS question, kind = 'stem' AS is_stem FROM open)"


@query(with_blocks(_QUESTIONS.format(of="blocks") + " SELECT document, ordinal, question, is_stem FROM questions"))
def question_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.question_runs(blocks(spark, sf_dir)).select("document", "ordinal", "question", "is_stem")


@query(with_blocks(_QUESTIONS.format(of="blocks") + " SELECT document, question, count(*) AS n_body, sum(length(text))::BIGINT AS n_chars FROM questions WHERE question IS NOT NULL AND NOT is_stem GROUP BY document, question"))
def question_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = blocks(spark, sf_dir).select("document", "ordinal", "kind", F.length("text").alias("n"))  # texts stay where they are
    rows = sequence.question_runs(lines).where("question IS NOT NULL AND NOT is_stem")
    return rows.groupBy("document", "question").agg(F.count("*").alias("n_body"), F.sum("n").alias("n_chars"))


@query(with_turns(_QUESTIONS.format(of="turns") + ", j AS (SELECT document, question, count(*) AS n_blocks, string_agg(text, '' ORDER BY ordinal) AS joined FROM questions WHERE question IS NOT NULL GROUP BY document, question) SELECT *, substr(sha256(joined), 1, 16) AS atom_id FROM j"))
def joined_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.joined_text(sequence.question_runs(turns(spark, sf_dir)).where("question IS NOT NULL"), "document", "question")


_HEADING = "regexp_matches(raw_text, '^[^ \\n]+ [^ \\n]+\\.')"


def _boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_word = F.regexp_extract("raw_text", r"^(\S+)", 1)
    return sequence.heading_boundaries(line_blocks(table(spark, sf_dir, "documents", "doc_id", "text")), F.col("raw_text").rlike(r"^[^ \n]+ [^ \n]+\."), first_word)


_BOUNDARIES = (
    f", rows_ AS (SELECT *, CASE WHEN {_HEADING} THEN regexp_extract(raw_text, '^([^\\t\\n\\v\\f\\r ]+)', 1) END AS key FROM lines WHERE trim(raw_text) <> ''), "
    "ahead AS (SELECT *, lead(key) OVER (PARTITION BY document ORDER BY ordinal) AS next_key FROM rows_), "
    "kept AS (SELECT *, lag(key) OVER (PARTITION BY document ORDER BY ordinal) AS last_key FROM ahead WHERE key IS NOT NULL AND (next_key IS NULL OR next_key = key)), "
    "bounds AS (SELECT * FROM kept WHERE last_key IS NULL OR last_key <> key)"
)


@query(with_blocks(f"{_BOUNDARIES} SELECT document, ordinal, key FROM bounds"))
def heading_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boundaries(spark, sf_dir).select("document", "ordinal", "key")


@query(with_blocks(f"{_BOUNDARIES}, cls AS (SELECT *, CASE WHEN length(key) > 4 THEN 'long' ELSE 'short' END AS class FROM bounds), stops AS (SELECT document, max(ordinal) + 1 AS stop FROM lines GROUP BY document), ends AS (SELECT *, lead(ordinal) OVER (PARTITION BY document ORDER BY ordinal) AS nxt FROM cls) SELECT document, class, key, ordinal AS start, coalesce(nxt, stop) AS \"end\" FROM ends JOIN stops USING (document) WHERE class = 'long'"))
def boundary_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends come from boundaries of all classes; only then is a class chosen."""
    ends = line_blocks(table(spark, sf_dir, "documents", "doc_id", "text")).groupBy("document").agg((F.max("ordinal") + 1).alias("stop"))
    classed = _boundaries(spark, sf_dir).withColumn("class", F.when(F.length("key") > 4, "long").otherwise("short"))
    return sequence.boundary_spans(classed, ends).where("class = 'long'")


@query("WITH p AS (SELECT *, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM orders) SELECT o_custkey, o_orderkey, previous FROM p WHERE o_orderkey <= previous")
def monotonic_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderdate").withColumn("ordinal", F.struct("o_orderdate", "o_orderkey"))
    return sequence.monotonic(orders, "o_custkey", value="o_orderkey").select("o_custkey", "o_orderkey", "previous")


@query(with_turns(_QUESTIONS.format(of="turns") + " SELECT document, ordinal, coalesce(last_value(CASE WHEN regexp_matches(text, '^[A-Z]') AND kind = 'body' THEN substr(text, 1, 6) END IGNORE NULLS) OVER (PARTITION BY document, question ORDER BY ordinal ROWS UNBOUNDED PRECEDING), '题干') AS owner FROM questions WHERE question IS NOT NULL"))
def figure_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last sub-part's label in the question, else its stem."""
    rows = sequence.question_runs(turns(spark, sf_dir)).where("question IS NOT NULL")
    label = F.when(F.col("text").rlike("^[A-Z]") & (F.col("kind") == "body"), F.substring("text", 1, 6))
    return rows.select("document", "ordinal", F.coalesce(sequence.carried(label, "document", "question"), F.lit("题干")).alias("owner"))


@query(with_blocks("SELECT document, ordinal, CASE WHEN regexp_matches(text, '\\(([0-9]+)\\)') THEN regexp_extract(text, '\\(([0-9]+)\\)', 1) ELSE '?' END AS label FROM blocks WHERE contains(text, '(')"))
def sub_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.regexp_extract("text", r"\(([0-9]+)\)", 1)
    return texts(spark, sf_dir).where(F.contains("text", F.lit("("))).select("document", "ordinal", F.when(label != "", label).otherwise("?").alias("label"))


_OPTIONS_SQL = "opts AS (SELECT l_orderkey AS question, l_linenumber * 1000000000::BIGINT + l_partkey AS ordinal, chr(65 + (l_partkey % 4)::INT) AS label FROM lineitem)"


def _options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").select(F.col("l_orderkey").alias("question"), (F.col("l_linenumber").cast("long") * 1000000000 + F.col("l_partkey")).alias("ordinal"), F.char(F.lit(65) + F.col("l_partkey") % 4).alias("label"))


@query(f"WITH {_OPTIONS_SQL}, b AS (SELECT *, label <= lag(label) OVER (PARTITION BY question ORDER BY ordinal) AS back FROM opts), g AS (SELECT *, sum(coalesce(back, false)::INT) OVER (PARTITION BY question ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS group_no FROM b), l AS (SELECT question, group_no::BIGINT AS group_no, string_agg(label, '' ORDER BY ordinal) AS labels FROM g GROUP BY question, group_no) SELECT *, labels = 'ABCD' AS complete, labels <> substr('ABCD', 1, length(labels)) AS gap FROM l")
def option_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.option_groups(_options(spark, sf_dir), "question")


@query("WITH e AS (SELECT user_id, event_id AS ordinal, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id // 3 END AS printed FROM events), l AS (SELECT *, last_value(printed IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last, row_number() OVER (PARTITION BY user_id ORDER BY ordinal) = 1 AS first FROM e) SELECT user_id, ordinal, printed, sum((CASE WHEN printed IS NULL THEN first ELSE last IS NULL OR printed <> last + 1 END)::INT) OVER (PARTITION BY user_id ORDER BY ordinal ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM l")
def numbering_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "user_id", "event_id").select("user_id", F.col("event_id").alias("ordinal"), F.when(F.col("event_id") % 11 != 0, F.floor(F.col("event_id") / 3)).alias("printed"))
    return sequence.numbering_islands(rows, "user_id").select("user_id", "ordinal", "printed", "run")


@query("SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, (row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_orderkey, l_linenumber) + 4)::BIGINT AS shown FROM lineitem")
def list_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters by list and level that start at five."""
    rows = table(spark, sf_dir, "lineitem", "l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber").withColumn("ordinal", F.struct("l_orderkey", "l_linenumber"))
    return sequence.list_numbers(rows, "l_suppkey", "l_returnflag", start=F.lit(5)).select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", F.col("shown").cast("long").alias("shown"))


@query(with_blocks(", c AS (SELECT *, coalesce(role <> lag(role) OVER (PARTITION BY document ORDER BY ordinal), true) AS new FROM blocks), g AS (SELECT *, sum(new::INT) OVER (PARTITION BY document ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS island FROM c) SELECT document, island::BIGINT AS island, role, count(*) AS n_rows, min(ordinal) AS first_row FROM g GROUP BY document, island, role"))
def adjacent_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks(spark, sf_dir)
    grouped = sequence.islands(rows.withColumn("new", F.col("role") != F.lag("role").over(sequence.over("document"))), F.col("new"), "document")
    return grouped.groupBy("document", "island", "role").agg(F.count("*").alias("n_rows"), F.min("ordinal").alias("first_row"))


@query(with_blocks(", r AS (SELECT *, kind = 'section' AS joins FROM blocks WHERE trim(text) <> ''), n AS (SELECT *, lag(joins) OVER w AS prev_joins, lead(text) OVER w AS next_text, lead(joins) OVER w AS next_joins FROM r WINDOW w AS (PARTITION BY document ORDER BY ordinal)) SELECT document, ordinal, CASE WHEN joins AND next_text IS NOT NULL AND NOT coalesce(next_joins, false) THEN text || ' ' || next_text ELSE text END AS title FROM n WHERE NOT (coalesce(prev_joins, false) AND NOT joins)"))
def join_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.join_next(blocks(spark, sf_dir), F.col("kind") == "section").select("document", "ordinal", "title")


@query("SELECT o_custkey, o_orderkey, o_orderpriority, coalesce(lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = o_orderpriority, false) AS repeats FROM orders")
def suppress_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderpriority").withColumn("ordinal", F.col("o_orderkey"))
    return sequence.suppress_repeats(rows, "o_custkey", title="o_orderpriority").drop("ordinal")


@query(with_blocks("SELECT document, ordinal, coalesce(last_value(CASE kind WHEN 'section-banner' THEN 0 WHEN 'stem' THEN 2 WHEN 'section' THEN 1 END IGNORE NULLS) OVER (PARTITION BY document ORDER BY ordinal ROWS UNBOUNDED PRECEDING), 0)::INTEGER AS list_level FROM blocks"))
def list_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.when(F.col("kind") == "section-banner", 0).when(F.col("kind") == "stem", 2).when(F.col("kind") == "section", 1)
    return sequence.list_level(blocks(spark, sf_dir), event, "document").select("document", "ordinal", "list_level")


@query(with_blocks("SELECT document, ordinal, last_value(CASE WHEN kind <> 'callout' THEN locator END IGNORE NULLS) OVER (PARTITION BY document ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS owner FROM blocks"))
def nearest_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.nearest_owner(blocks(spark, sf_dir), F.col("kind") != "callout", F.col("locator"), "document").select("document", "ordinal", "owner")


@query("WITH n AS (SELECT user_id, event_id, least(CASE WHEN lag(event_type, 1) OVER w = event_type THEN 1 END, CASE WHEN lead(event_type, 1) OVER w = event_type THEN 1 END, CASE WHEN lag(event_type, 2) OVER w = event_type THEN 2 END, CASE WHEN lead(event_type, 2) OVER w = event_type THEN 2 END)::INTEGER AS distance FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT * FROM n")
def near_neighbour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "user_id", "event_id", "event_type").withColumn("ordinal", F.col("event_id"))
    return sequence.near_neighbour(rows, 2, "user_id", value="event_type").select("user_id", "event_id", "distance")


@query(with_turns("SELECT document, ordinal, bool_or(contains(text, '?') OR speaker = 'system') OVER (PARTITION BY document ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS opened FROM turns"))
def tag_latch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(spark, sf_dir)
    return sequence.latch(rows, F.contains("text", F.lit("?")) | (F.col("speaker") == "system"), "document", name="opened").select("document", "ordinal", "opened")


@query(with_blocks(f"{_CARRY} SELECT document, ordinal, CASE WHEN section IS NOT NULL AND kind = 'body' THEN 'restored' ELSE kind END AS kind FROM carry"))
def kind_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sequence.section_carry(blocks(spark, sf_dir))
    return rows.select("document", "ordinal", F.when(F.col("section").isNotNull() & (F.col("kind") == "body"), "restored").otherwise(F.col("kind")).alias("kind"))


@query(with_turns(_QUESTIONS.format(of="turns") + ", a AS (SELECT document, question, count(*) FILTER (WHERE speaker = 'assistant') AS n_answers FROM questions WHERE question IS NOT NULL GROUP BY document, question) SELECT document, question, CASE WHEN n_answers = 0 THEN 'explanation' ELSE 'question' END AS kind FROM a"))
def kind_demote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question nobody answers is an explanation."""
    rows = sequence.question_runs(turns(spark, sf_dir)).where("question IS NOT NULL").groupBy("document", "question").agg(F.count_if(F.col("speaker") == "assistant").alias("n"))
    return rows.select("document", "question", F.when(F.col("n") == 0, "explanation").otherwise("question").alias("kind"))


@query(with_blocks(f"{_CARRY} SELECT document, ordinal, CASE WHEN coalesce(section = 'SE', false) THEN 1 WHEN section IS NOT NULL AND subsection IS NOT NULL THEN 3 WHEN section IS NOT NULL THEN 2 ELSE 4 END::INTEGER AS new_level FROM carry WHERE kind = 'section'"))
def relevel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sequence.section_carry(blocks(spark, sf_dir)).where("kind = 'section'")
    held = lambda c: F.when(F.col(c).isNotNull(), "yes")
    rows = rows.withColumn("banner", F.when(F.col("section") == "SE", "SE").otherwise(held("section"))).withColumn("parent", held("subsection"))
    return sequence.relevel(rows, [("SE", "", 1), ("yes", "yes", 3), ("yes", "", 2)], 4).select("document", "ordinal", "new_level")


@query("SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY coalesce(c_mktsegment, ''), coalesce(c_acctbal, 0), c_custkey)::BIGINT AS place FROM customer")
def doc_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order by two fields, null before everything."""
    segment, balance = F.coalesce("c_mktsegment", F.lit("")), F.coalesce("c_acctbal", F.lit(0.0))
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    return sequence.places(rows, ["c_nationkey"], [segment, F.floor(balance / 100)], [segment, balance, "c_custkey"]).select("c_custkey", "place")


@query("SELECT doc_id, '第A' || CASE WHEN doc_id < 10 THEN '0' || doc_id ELSE doc_id::VARCHAR END || '讲' AS label FROM documents")
def doc_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id").select("doc_id", T.doc_label(F.col("doc_id")).alias("label"))


@query("SELECT l_orderkey, l_linenumber, ((row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1) // 3)::BIGINT AS row_no FROM lineitem")
def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options in rows of three."""
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber"))
    return table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", F.floor((n - 1) / 3).alias("row_no"))


@query(with_blocks(", c AS (SELECT document, ordinal, text, sum(length(text)) OVER (PARTITION BY document ORDER BY ordinal ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM blocks), b AS (SELECT *, stop - length(text) AS start FROM c) SELECT document, ordinal, substr(text, (greatest(100, start) - start + 1), (least(600, stop) - greatest(100, start))) AS part FROM b WHERE start < 600 AND stop > 100"))
def stream_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters 100 to 600 of each document's stream, by block."""
    return sequence.stream_slice(texts(spark, sf_dir).select("document", "ordinal", "text"), 100, 600, "document").select("document", "ordinal", "part")


@query(with_blocks(", r AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY document, ordinal) AS nth FROM blocks), s AS (SELECT role, count(*) AS n, length(text) // 100 AS style FROM blocks GROUP BY role, style), d AS (SELECT role, style AS dominant, row_number() OVER (PARTITION BY role ORDER BY n DESC, style) AS k FROM s) SELECT r.role, count(*) AS hits, sum((document % 2 = 0)::INT)::BIGINT AS in_scope, string_agg(locator, ';' ORDER BY nth) FILTER (WHERE nth <= 4) AS samples, any_value(dominant)::BIGINT AS dominant, count(*) >= 2 AS promotable FROM r JOIN d ON r.role = d.role AND d.k = 1 GROUP BY r.role"))
def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks(spark, sf_dir).withColumn("style", F.floor(F.length("text") / 100))
    return aggregates.census(rows, F.col("document") % 2 == 0, "style")


@query(with_blocks(f", f AS (SELECT count(*) AS total, sum((role <> '{PLAIN}')::INT)::BIGINT AS matched FROM blocks WHERE trim(text) <> '') SELECT *, round(matched / total, 6) AS coverage, CASE WHEN round(matched / total, 6) > 0.8 THEN 'match' ELSE 'no match' END AS verdict FROM f"))
def fingerprint_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.fingerprint(blocks(spark, sf_dir), F.col("role") != PLAIN)


_PREDICATES = {f"{r.order}:{r.id}": r.pattern for r in RULES} | {"never": "\\d{40}"}


@query(with_blocks(", h AS (" + " UNION ALL ".join(f"SELECT {dialect.sql_literal(n)} AS predicate, sum(regexp_matches(text, {dialect.sql_literal(dialect.matching(p))})::INT)::BIGINT AS hits FROM blocks" for n, p in _PREDICATES.items()) + ") SELECT *, CASE WHEN hits = 0 THEN 'NEVER_MATCHES' END AS problem FROM h"))
def predicate_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.predicate_hits(texts(spark, sf_dir), {n: dialect.matches(p, F.col("text")) for n, p in _PREDICATES.items()})


@query("SELECT doc_id, sha256(text) AS digest, substr(sha256(text), 1, 16) AS atom_id, substr(sha256(text), 1, 12) AS banner_id FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2("text", 256)
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", digest.alias("digest"), T.content_id(F.col("text")).alias("atom_id"), T.content_id(F.col("text"), 12).alias("banner_id"))
