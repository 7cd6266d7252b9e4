"""Queries: gates and verification on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.functions.dialect import SPACES
from quillframe.operators import gates
from quillframe.plans.attributed import _GAPS, _SPANS, _spans, _stream
from quillframe.plans.corpus import with_blocks
from quillframe.plans.registry import query
from quillframe.sources.tables import table

_LEVELS = "lv AS (SELECT p_brand AS style, p_size AS level, max(p_retailprice) AS size, max(p_partkey) % 2 = 0 AS bold, min(p_partkey) AS space, count(*) AS indent FROM part GROUP BY 1, 2)"


@query(
    f"WITH {_LEVELS}, u AS (SELECT *, lag(size) OVER w AS psize, lag(bold) OVER w AS pbold, lag(space) OVER w AS pspace, lag(indent) OVER w AS pindent, lag(level) OVER w AS plevel FROM lv WINDOW w AS (PARTITION BY style ORDER BY level)), "
    "c AS (SELECT 'SIZE_GROWS' AS code, style, level FROM u WHERE size > psize UNION ALL SELECT 'SIZE_EQUAL_WITHOUT_BOLD', style, level FROM u WHERE size = psize AND NOT pbold AND bold UNION ALL SELECT 'SPACE_GROWS', style, level FROM u WHERE space > pspace "
    "UNION ALL SELECT 'INDENT_SHRINKS', style, level FROM u WHERE indent < pindent UNION ALL SELECT 'LEVEL_SKIPPED', style, level FROM u WHERE level > plevel + 1) "
    "SELECT 'heading_ladder' AS gate, code, 'error' AS severity, style AS document, level::VARCHAR AS locator, NULL::VARCHAR AS detail FROM c"
)
def ladder_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as styles, sizes as heading levels."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size", "p_retailprice")
    levels = parts.groupBy(F.col("p_brand").alias("style"), F.col("p_size").alias("level")).agg(F.max("p_retailprice").alias("size"), (F.max("p_partkey") % 2 == 0).alias("bold"), F.min("p_partkey").alias("space"), F.count("*").alias("indent"))
    return gates.heading_ladder(levels)


@query(with_blocks(_SPANS + ", r AS (SELECT *, max(char_end) OVER (PARTITION BY block ORDER BY char_start, char_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM (SELECT block, char_start - CASE WHEN role = 'option' AND length(block) % 5 = 0 THEN 30 ELSE 0 END AS char_start, char_end - CASE WHEN role = 'option' AND length(block) % 5 = 0 THEN 30 ELSE 0 END AS char_end FROM spn)) SELECT block, CASE WHEN char_end <= char_start THEN 'SPAN_EMPTY' ELSE 'SPAN_OVERLAP' END AS code FROM r WHERE char_end <= char_start OR char_start < reached"))
def span_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans moved so that some may cross: those that do, or are empty."""
    spans = _spans(spark, sf_dir)
    shift = F.when((F.col("role") == "option") & (F.length("block") % 5 == 0), 30).otherwise(0)
    moved = spans.withColumn("char_start", F.col("char_start") - shift).withColumn("char_end", F.col("char_end") - shift)
    return gates.attribution.overlaps(moved).select("block", "code")


@query(with_blocks(_GAPS + ", own AS (SELECT block, arg_min(unit, char_start) AS unit FROM spn GROUP BY block), f AS (SELECT block, char_start, char_end FROM spn UNION ALL SELECT block, gap_start, gap_end FROM gaps), g AS (SELECT block, sum(char_end - char_start) AS got FROM f GROUP BY block), t AS (SELECT sum(n_chars) AS total, sum(coalesce(got, 0)) AS attributed FROM blk LEFT JOIN g ON blk.block = g.block), e AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events) SELECT gate, CASE WHEN n_errors > 0 THEN 'fail' ELSE 'pass' END AS status, n_errors FROM (SELECT 'persisted' AS gate, ((SELECT (total <> attributed)::INT FROM t) + (SELECT count(*) FROM blk WHERE regexp_matches(raw_text, '[^" + SPACES + "]') AND block NOT IN (SELECT block FROM spn)) + (SELECT count(*) FROM e WHERE value < previous))::BIGINT AS n_errors)"))
def gate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persistence gate: blocks that no span claims, then all characters once gaps are filled; events are its run ledger."""
    runs = table(spark, sf_dir, "events", "user_id", "event_id", "value").select(F.col("user_id").alias("source_id"), F.lit("h").alias("schema_hash"), F.col("event_id").alias("started_at"), F.col("value").alias("ratio"))
    return gates.status(gates.persisted_stream(_stream(spark, sf_dir), runs), ["persisted"])


@query("WITH w AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_partkey * 36000.0)::DOUBLE / 36000 * 10 / 12 AS expected, CASE WHEN l_partkey % 5 <> 0 THEN l_partkey * 10.0 / 12 + CASE WHEN l_partkey % 3 = 0 THEN 0.2 ELSE 0 END END AS width FROM lineitem) SELECT CASE WHEN width IS NULL THEN 'FIGURE_WIDTH_MISSING' ELSE 'FIGURE_WIDTH_DRIFT' END AS code, l_orderkey::VARCHAR AS document, l_linenumber::VARCHAR AS locator FROM w WHERE width IS NULL OR abs(width - expected) > 0.05")
def figure_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figure widths of lines against those expected from font sizes."""
    p = F.col("l_partkey")
    width = F.when(p % 5 != 0, p * 10.0 / 12 + F.when(p % 3 == 0, 0.2).otherwise(0.0))
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("locator"), (p * 36000).alias("emu"), F.lit(10).alias("body_pt"), F.lit(12).alias("source_pt"), width.alias("width_mm"))
    return gates.figure_widths(rows).select("code", "document", "locator")


@query("WITH s AS (SELECT text, any_value(doc_id) AS wanted FROM documents WHERE length(text) >= 8 GROUP BY text HAVING count(*) = 1), o AS (SELECT text, any_value(doc_id // 2) AS got FROM documents WHERE length(text) >= 8 AND lang <> 'en' GROUP BY text HAVING count(*) = 1) SELECT 'NUMBER_DIFFERS' AS code, wanted || ' ' || got AS detail FROM s JOIN o USING (text) WHERE wanted <> got")
def numbering_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of texts that stand once on each side."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    source = docs.select("text", F.col("doc_id").alias("ordinal"))
    output = docs.where("lang <> 'en'").select("text", F.floor(F.col("doc_id") / 2).alias("ordinal"))
    return gates.numbering_rendered(source, output).select("code", "detail")
