"""Queries: the chain from lines to units, spans and its gate, over the corpus as an exam paper."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.operators import carve, gates
from quillframe.plans.corpus import PLAIN, blocks, with_blocks
from quillframe.plans.registry import query
from quillframe.plans.grouped import _CARRY
from quillframe.sources.shared import checkpointed
from quillframe.sources.tables import table

# Lines of no role become rows of options and parts with blanks, by their number; contacts open a tag; first lines are headers.
_EXAM = (
    ", exam AS (SELECT document, ordinal, locator, role, CASE WHEN ordinal = 1 AND document % 2 = 0 THEN 'header' ELSE kind END AS kind, made AS text, CASE WHEN made = text THEN raw_text ELSE made END AS raw_text, p = 'o' AS is_option, p = 's' AS is_sub, role = 'contact' AS is_tag "
    "FROM (SELECT *, CASE p WHEN 'o' THEN 'A．' || length(text) || '  B．' || ordinal || ' C．' || document || CASE WHEN ordinal % 8 = 1 THEN ' D．' || length(text) ELSE '' END WHEN 's' THEN '(' || ordinal || ') __ ' || text || ' ____' ELSE text END AS made "
    f"FROM (SELECT *, CASE WHEN role = '{PLAIN}' AND ordinal % 4 = 1 THEN 'o' WHEN role = '{PLAIN}' AND ordinal % 4 = 2 THEN 's' ELSE '' END AS p FROM blocks)))"
)
_PLACED = (
    _EXAM
    + _CARRY.replace("FROM blocks", "FROM exam")
    + ", opened AS (SELECT *, CASE WHEN kind <> 'header' AND last_value(CASE WHEN kind = 'stem' THEN 'stem' WHEN kind IN ('section', 'sub-module', 'section-banner') THEN 'close' END IGNORE NULLS) OVER w = 'stem' THEN sum((kind = 'stem')::INT) OVER w END::BIGINT AS question FROM carry WINDOW w AS (PARTITION BY document ORDER BY ordinal ROWS UNBOUNDED PRECEDING)), "
    "tagged AS (SELECT *, coalesce(bool_or(is_tag AND kind <> 'stem') OVER (PARTITION BY document, question ORDER BY ordinal ROWS UNBOUNDED PRECEDING), false) AS after_tag, max(CASE WHEN kind = 'stem' THEN document || '/' || locator END) OVER (PARTITION BY document, question) AS place FROM opened), "
    "placed AS (SELECT *, CASE WHEN question IS NOT NULL THEN place END AS unit, CASE WHEN question IS NOT NULL AND kind = 'stem' THEN 'stem' WHEN question IS NOT NULL AND is_option AND NOT after_tag THEN 'option' WHEN question IS NOT NULL AND is_sub THEN 'sub_question' WHEN question IS NOT NULL THEN 'body' "
    "WHEN kind = 'section-banner' THEN 'section' WHEN kind = 'sub-module' THEN 'subsection' WHEN kind = 'section' THEN 'node' WHEN kind = 'header' THEN 'header' ELSE 'content' END AS part FROM tagged)"
)
_OPTIONS = (
    ", opt AS (SELECT document, question, unit, ordinal, locator, unnest(['A', 'B', 'C', 'D']) AS label, unnest([length(plain_text)::VARCHAR, ordinal::VARCHAR, document::VARCHAR, CASE WHEN ordinal % 8 = 1 THEN length(plain_text)::VARCHAR END]) AS text FROM placed JOIN (SELECT document AS d, ordinal AS o, text AS plain_text FROM texts) ON d = document AND o = ordinal WHERE part = 'option'), "
    "options AS (SELECT *, row_number() OVER w AS option_no, dense_rank() OVER (PARTITION BY document, question ORDER BY ordinal) - 1 AS group_no FROM opt WHERE text IS NOT NULL WINDOW w AS (PARTITION BY document, question ORDER BY ordinal, label))"
)
_ASKED = (
    _OPTIONS
    + ", grp AS (SELECT document, question, group_no, string_agg(label, '' ORDER BY label) AS labels FROM options GROUP BY ALL), grps AS (SELECT document, question, list(labels ORDER BY group_no) AS option_groups FROM grp GROUP BY ALL), "
    "whole AS (SELECT document, question, unit, max(CASE WHEN part = 'stem' THEN section END) AS section, max(CASE WHEN part = 'stem' THEN subsection END) AS subsection, max(CASE WHEN part = 'stem' THEN node END) AS node, max(CASE WHEN part = 'stem' THEN role END) AS role, max(CASE WHEN part = 'stem' THEN text END) AS stem, count(*) AS n_blocks, string_agg(text, '' ORDER BY ordinal) AS joined FROM placed WHERE question IS NOT NULL GROUP BY document, question, unit), "
    "asked AS (SELECT whole.*, coalesce(option_groups, []) AS option_groups FROM whole LEFT JOIN grps ON whole.document = grps.document AND whole.question = grps.question)"
)
_FREE = (
    ", heads AS (SELECT DISTINCT document, CASE WHEN part = 'node' THEN substr(text, 1, 30) ELSE text END AS heading FROM placed WHERE part IN ('section', 'subsection', 'node') AND text <> ''), "
    "free AS (SELECT p.document, p.locator, p.raw_text, CASE WHEN bool_or(coalesce(contains(p.raw_text, h.heading), false)) THEN 'heading' ELSE 'prose' END AS unit_kind FROM placed p LEFT JOIN heads h ON h.document = p.document WHERE question IS NULL AND regexp_matches(p.raw_text, '[^" + "{spaces}" + "]') GROUP BY ALL)"
)
_UNITS = (
    ", units AS (SELECT unit, NULL::VARCHAR AS parent, 'question' AS kind, row_number() OVER (PARTITION BY document ORDER BY question) - 1 AS ordinal, concat_ws(' / ', nullif(section, ''), nullif(subsection, ''), nullif(node, '')) AS path, CASE WHEN len(option_groups) = 1 THEN 1 END::INTEGER AS max_choices, joined AS text FROM asked "
    "UNION ALL SELECT unit || '#opt' || option_no, unit, 'option', option_no, NULL, NULL, text FROM options "
    "UNION ALL SELECT unit || '#sub' || n, unit, 'sub_question', n, NULL, NULL, text FROM (SELECT *, row_number() OVER (PARTITION BY document, question ORDER BY ordinal) AS n FROM placed WHERE part = 'sub_question') "
    "UNION ALL SELECT document || '/' || locator || '#unclaimed', NULL, unit_kind, 0, document::VARCHAR, NULL, raw_text FROM free "
    "UNION ALL SELECT unit || '#answer', unit, 'answer', 0, NULL, NULL, 'q' || quality || '、t' || toxic FROM asked JOIN (SELECT doc_id, any_value(quality) AS quality, any_value(toxic) AS toxic FROM labels GROUP BY doc_id HAVING count(*) = 1) ON doc_id = document WHERE question = 1)"
)


def _sql(*parts: str) -> str:
    from quillframe.functions.dialect import SPACES

    return with_blocks("".join(parts).replace("{spaces}", SPACES))


def _exam(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, carve.Marks]:
    rows = blocks(spark, sf_dir)
    plain, n = F.col("role") == PLAIN, F.col("ordinal")
    text = lambda c: F.col(c).cast("string")
    long = F.length("text").cast("string")
    row = F.concat(F.lit("A．"), long, F.lit("  B．"), text("ordinal"), F.lit(" C．"), text("document"), F.when(n % 8 == 1, F.concat(F.lit(" D．"), long)).otherwise(""))
    made = F.when(plain & (n % 4 == 1), row).when(plain & (n % 4 == 2), F.concat(F.lit("("), text("ordinal"), F.lit(") __ "), "text", F.lit(" ____"))).otherwise(F.col("text"))
    rows = rows.withColumn("made", made).withColumn("raw_text", F.when(F.col("made") == F.col("text"), F.col("raw_text")).otherwise(F.col("made")))
    kind = F.when((n == 1) & (F.col("document") % 2 == 0), "header").otherwise(F.col("kind"))
    out = rows.select("document", "ordinal", "locator", "role", kind.alias("kind"), F.col("made").alias("text"), "raw_text")
    return out, carve.Marks(plain & (n % 4 == 1), plain & (n % 4 == 2), F.col("role") == "contact")


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carve.placed(*_exam(spark, sf_dir))


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placed blocks, written once for the several tables that are made of them."""
    return checkpointed(_placed(spark, sf_dir))


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of a document answer its first question."""
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("document")).agg(F.count("*").alias("n"), F.first("quality").alias("q"), F.first("toxic").alias("t")).where("n = 1")
    return labels.select("document", F.lit(1).cast("long").alias("question"), F.concat(F.lit("q"), F.col("q").cast("string"), F.lit("、t"), F.col("t").cast("string")).alias("answer"))


def _units(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    found = carve.options(rows)
    return carve.units(rows, carve.questions(rows, found), found, _answers(spark, sf_dir))


@query(_sql(_PLACED, " SELECT document, ordinal, section, subsection, node, question, unit, part FROM placed"))
def carve_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block's place: what is above it, its question, what it is there."""
    return _placed(spark, sf_dir).select("document", "ordinal", "section", "subsection", "node", "question", "unit", "part")


@query(_sql(_PLACED, " SELECT document, row_number() OVER (PARTITION BY document ORDER BY part <> 'header', ordinal) AS place, part AS level, section, subsection, node, role, CASE WHEN part IN ('node', 'header') THEN substr(text, 1, 30) WHEN part <> 'content' THEN text END AS label, locator, text FROM placed WHERE question IS NULL"))
def carve_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers first, then sections, nodes and what stands outside questions."""
    return carve.tree(_placed(spark, sf_dir))


@query(_sql(_PLACED, _OPTIONS, " SELECT document, question, ordinal, label, text, option_no, group_no::BIGINT AS group_no FROM options"))
def carve_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options of all questions, none behind a tag."""
    return carve.options(_placed(spark, sf_dir)).select("document", "question", "ordinal", "label", "text", "option_no", "group_no")


@query(_sql(_PLACED, _ASKED, " SELECT document, question, unit, section, subsection, node, role, stem, n_blocks, joined, array_to_string(option_groups, ' ') AS option_groups, len(option_groups) > 0 AND len(list_filter(option_groups, lambda g: g <> 'ABCD')) = 0 AS complete, array_to_string(list_filter(option_groups, lambda g: g <> substr('ABCD', 1, length(g))), ' ') AS option_gaps, substr(sha256(joined), 1, 16) AS atom_id FROM asked"))
def carve_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with their place, text and option groups."""
    rows = _kept(spark, sf_dir)
    out = carve.questions(rows, carve.options(rows)).drop("locator")
    return out.withColumns({c: F.array_join(c, " ") for c in ("option_groups", "option_gaps")})


@query(_sql(_PLACED, _ASKED, _FREE, _UNITS, " SELECT * FROM units"))
def atom_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All units: questions, options, parts, answers, and what nobody claims."""
    return _units(spark, sf_dir, _kept(spark, sf_dir))


_STREAM = (
    ", cuts AS (SELECT document || '/' || locator AS block, unit, raw_text, list_filter(regexp_split_to_array(regexp_replace(raw_text, '([A-H][.．、:：])', chr(1) || '\\1', 'g'), chr(1)), lambda x: x <> '') AS c FROM placed WHERE part = 'option'), "
    "spn AS (SELECT block, coalesce(list_sum(list_transform(c[1:k - 1], lambda x: length(x))), 0)::BIGINT AS char_start, list_sum(list_transform(c[1:k], lambda x: length(x)))::BIGINT AS char_end, unit, 'option' AS role FROM (SELECT *, unnest(range(1, len(c) + 1)) AS k FROM cuts) "
    "UNION ALL SELECT document || '/' || locator, 0, length(raw_text), unit, part FROM placed WHERE question IS NOT NULL AND part <> 'option' AND length(raw_text) > 0 "
    "UNION ALL SELECT document || '/' || locator, 0, length(raw_text), document || '/' || locator || '#unclaimed', unit_kind FROM free), "
    "rest AS (SELECT document || '/' || locator AS block, 0::BIGINT AS char_start, length(raw_text)::BIGINT AS char_end, document || '/' || locator || '#residual' AS unit, 'residual' AS role FROM placed WHERE question IS NULL AND length(raw_text) > 0 AND NOT regexp_matches(raw_text, '[^" + "{spaces}" + "]'))"
)


@query(_sql(_PLACED, _FREE, _STREAM, " SELECT * FROM spn UNION ALL SELECT * FROM rest"))
def atom_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every character of every block with the unit it belongs to."""
    return carve.spans(_kept(spark, sf_dir))


@query(_sql(_PLACED, _FREE, _STREAM, ", alls AS (SELECT * FROM spn UNION ALL SELECT * FROM rest), e AS (SELECT ((SELECT sum(char_end - char_start) FROM alls) <> (SELECT sum(length(raw_text)) FROM placed))::INT + (SELECT count(*) FROM placed WHERE regexp_matches(raw_text, '[^{spaces}]') AND document || '/' || locator NOT IN (SELECT block FROM spn)) AS n) SELECT 'persisted' AS gate, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status, n::BIGINT AS n_errors FROM e"))
def atom_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persistence gate over the whole chain: all characters attributed, no visible block without a span."""
    runs = spark.createDataFrame([("corpus", "h", 1, 1.0)], "source_id string, schema_hash string, started_at int, ratio double")
    return gates.status(gates.persisted_stream(carve.stream(_kept(spark, sf_dir)), runs), ["persisted"])


@query(_sql(_PLACED, _ASKED, _FREE, _UNITS, ", blk AS (SELECT unit, sum(len(regexp_extract_all(raw_text, '[_＿]{2,}')))::BIGINT AS n_blanks FROM placed WHERE question IS NOT NULL GROUP BY unit) SELECT a.parent AS unit, a.text AS answer, n_blanks, 2::INTEGER AS n_segments, n_blanks = 2 AS pairable FROM units a JOIN blk ON blk.unit = a.parent WHERE a.kind = 'answer' AND n_blanks > 0"))
def answer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions and their answer child: whether blanks and segments of the answer are as many."""
    rows = _kept(spark, sf_dir)
    return carve.answer_pairs(_units(spark, sf_dir, rows), carve.blanks(rows))


_VISIBLE = "regexp_matches(raw_text, '[^{spaces}]')"
_BLANKS = "len(regexp_extract_all(raw_text, '[_＿]{2,}'))"


@query(
    _sql(
        _PLACED,
        _ASKED,
        f" SELECT * FROM (SELECT count(*) AS n_blocks, count(DISTINCT document) AS n_documents, count(DISTINCT role) AS n_roles, sum(length(raw_text))::BIGINT AS n_chars, coalesce(sum(length(raw_text)) FILTER (WHERE question IS NOT NULL), 0)::BIGINT AS n_question_chars, count(*) FILTER (WHERE {_VISIBLE}) AS n_visible, count(*) FILTER (WHERE {_VISIBLE} AND question IS NULL) AS n_unclaimed, ",
        "".join(f"count(*) FILTER (WHERE part = '{p}') AS n_{p}, " for p in ("header", "section", "subsection", "node", "content", "stem", "body")),
        "count(*) FILTER (WHERE part = 'option') AS n_option_rows, count(*) FILTER (WHERE part = 'sub_question') AS n_sub_questions, 0::BIGINT AS n_unnumbered_parts, count(section) AS n_in_sections, count(subsection) AS n_in_subsections, count(node) AS n_in_nodes, ",
        f"coalesce(sum({_BLANKS}) FILTER (WHERE question IS NOT NULL), 0)::BIGINT AS n_blanks, count(*) FILTER (WHERE question IS NOT NULL AND {_BLANKS} > 0) AS n_blocks_with_blanks, max(length(raw_text))::BIGINT AS longest_block FROM placed), ",
        "(SELECT count(*) AS n_options, 0::BIGINT AS n_recovered_options, count(*) FILTER (WHERE text = '') AS n_empty_options, max(option_no)::BIGINT AS most_options, count(DISTINCT label) AS n_labels FROM options), ",
        "(SELECT count(*) AS n_questions, count(*) FILTER (WHERE len(option_groups) > 0) AS n_choice_questions, count(*) FILTER (WHERE len(option_groups) = 1) AS n_single_group, count(*) FILTER (WHERE len(option_groups) > 1) AS n_several_groups, count(*) FILTER (WHERE len(option_groups) > 0 AND len(list_filter(option_groups, lambda g: g <> 'ABCD')) = 0) AS n_complete, "
        "count(*) FILTER (WHERE len(list_filter(option_groups, lambda g: g <> substr('ABCD', 1, length(g)))) > 0) AS n_with_gaps, coalesce(sum(len(option_groups)), 0)::BIGINT AS n_groups, count(DISTINCT sha256(joined)) AS n_distinct_questions, max(n_blocks) AS most_blocks, max(length(joined))::BIGINT AS longest_question, coalesce(sum(length(stem)), 0)::BIGINT AS n_stem_chars FROM asked)",
    )
)
def chain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measures of the chain over the corpus, in one row."""
    rows = _kept(spark, sf_dir)
    found = carve.options(rows)
    return carve.report(rows, found, carve.questions(rows, found))
