"""Queries: characters, spans, gaps, blanks, order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillframe.functions import text as T
from quillframe.functions.dialect import SPACES
from quillframe.operators import attribution
from quillframe.plans.corpus import bare_lines, blocks, turns, with_blocks, with_turns
from quillframe.plans.registry import query
from quillframe.sources.tables import table

# Spans on lines: characters 5 to 25 and 40 to 90, as far as the line goes; the block is document and line.
_SPANS = (
    ", blk AS (SELECT document || ':' || ordinal AS block, document, length(raw_text)::BIGINT AS n_chars, raw_text FROM lines), "
    "spn AS (SELECT block, 5::BIGINT AS char_start, least(n_chars, 25)::BIGINT AS char_end, block || '#a' AS unit, 'stem' AS role FROM blk WHERE n_chars > 5 "
    "UNION ALL SELECT block, 40::BIGINT, least(n_chars, 90)::BIGINT, block || '#b', 'option' FROM blk WHERE n_chars > 40)"
)


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans and block ends of all lines in one pass; see :func:`attribution.stream`."""
    rows = bare_lines(spark, sf_dir).select(F.concat_ws(":", "document", "ordinal").alias("block"), "document", F.length("raw_text").cast("long").alias("n_chars"), F.col("raw_text").rlike(f"[^{SPACES}]").alias("visible"))
    part = lambda start, end, unit, role: F.when(F.col("n_chars") > start, attribution.event(F.lit(start), F.least("n_chars", F.lit(end)), F.concat("block", F.lit(unit)), F.lit(role)))
    events = F.array_compact(F.array(part(5, 25, "#a", "stem"), part(40, 90, "#b", "option"), attribution.block_end(F.col("n_chars"))))
    return rows.select("block", "document", "visible", F.inline(events))


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream(spark, sf_dir).where("role IS NOT NULL").select(*attribution.SPAN)


_GAPS = (
    _SPANS + ", reach AS (SELECT *, coalesce(max(char_end) OVER (PARTITION BY block ORDER BY char_start, char_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached FROM spn), "
    "tails AS (SELECT blk.block, coalesce(max(char_end), 0) AS gap_start, any_value(n_chars) AS gap_end FROM blk LEFT JOIN spn ON blk.block = spn.block GROUP BY blk.block), "
    "gaps AS (SELECT block, reached::BIGINT AS gap_start, char_start AS gap_end FROM reach WHERE char_start > reached UNION ALL SELECT block, gap_start::BIGINT, gap_end FROM tails WHERE gap_end > gap_start)"
)


@query(with_blocks(_GAPS + ", own AS (SELECT block, arg_min(unit, char_start) AS unit FROM spn GROUP BY block) SELECT block, char_start, char_end, unit, role FROM spn UNION ALL SELECT g.block, gap_start, gap_end, coalesce(unit, g.block || '#residual'), 'residual' FROM gaps g LEFT JOIN own o ON g.block = o.block"))
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.filled_stream(_stream(spark, sf_dir))


@query(with_blocks(_SPANS + ", g AS (SELECT block, sum(char_end - char_start) AS got FROM spn GROUP BY block), t AS (SELECT document, sum(coalesce(got, 0))::BIGINT AS attributed, sum(n_chars)::BIGINT AS total FROM blk LEFT JOIN g ON blk.block = g.block GROUP BY document) SELECT *, CASE WHEN total > 0 THEN round(attributed / total, 6) END AS ratio FROM t"))
def attribution_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.attributed_stream(_stream(spark, sf_dir), "document")


@query("WITH p AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events) SELECT *, coalesce(value < previous, false) AS fell FROM p")
def ratchet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runs of a user: each value against the one before it."""
    return attribution.ratchet(table(spark, sf_dir, "events", "user_id", "event_id", "value"), "user_id", order="event_id", value="value")


@query("WITH t AS (SELECT c_custkey AS block, 'name ' || repeat('_', (c_custkey % 4)::INT) || ' and ' || repeat('_', (c_nationkey % 5)::INT) || ' end' AS text, 5 + (c_custkey % 4) + 5 AS second FROM customer), m AS (SELECT block, block || '#u' AS unit, 5::INTEGER AS start, (5 + block % 4)::INTEGER AS \"end\" FROM t WHERE block % 4 >= 2 UNION ALL SELECT t.block, t.block || '#u', (second)::INTEGER, (second + c_nationkey % 5)::INTEGER FROM t JOIN customer ON c_custkey = block WHERE c_nationkey % 5 >= 2) SELECT unit, block, row_number() OVER (PARTITION BY unit ORDER BY start)::INTEGER AS blank_no, start, \"end\", 'underscore' AS evidence FROM m")
def blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks of two or more underscores in texts made from customers."""
    score = lambda n: F.repeat(F.lit("_"), n.cast("int"))
    text = F.concat(F.lit("name "), score(F.col("c_custkey") % 4), F.lit(" and "), score(F.col("c_nationkey") % 5), F.lit(" end"))
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey").select(F.col("c_custkey").alias("block"), text.alias("text"))
    spans = rows.select("block", F.lit(0).alias("char_start"), F.length("text").alias("char_end"), F.concat(F.col("block").cast("string"), F.lit("#u")).alias("unit"))
    return attribution.blanks(spans, rows)


@query("WITH w AS (SELECT o_orderkey, chr(65 + i) AS label, (i * 20 + o_custkey % 10)::BIGINT AS start FROM orders, (SELECT unnest([0, 1, 2]) AS i)), p AS (SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey, (l_partkey % 80)::BIGINT AS off FROM lineitem), b AS (SELECT *, lead(start) OVER (PARTITION BY o_orderkey ORDER BY start) AS until FROM w) SELECT p.o_orderkey, p.l_linenumber, p.l_partkey, p.off AS \"offset\", coalesce(b.label, 'lead') AS label FROM p LEFT JOIN b ON p.o_orderkey = b.o_orderkey AND off >= start + 2 AND (until IS NULL OR off < until + 2)")
def interval_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures at offsets to the option windows of their row."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").withColumn("i", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    windows = orders.select("o_orderkey", F.char(F.col("i").cast("long") + 65).alias("label"), (F.col("i") * 20 + F.col("o_custkey") % 10).cast("long").alias("start"))
    points = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", (F.col("l_partkey") % 80).alias("offset"))
    return attribution.interval_assign(points, windows, "o_orderkey", "offset")


@query("SELECT l_suppkey, l_returnflag, row_number() OVER w::BIGINT AS figure_no, l_quantity FROM lineitem WINDOW w AS (PARTITION BY l_suppkey, l_returnflag ORDER BY l_quantity, l_extendedprice, l_orderkey, l_linenumber) QUALIFY l_quantity > 10")
def figure_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of figures in their unit; those without a size are skipped but use up a number."""
    rows = table(spark, sf_dir, "lineitem", "l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber")
    found = attribution.figure_ordinals(rows, F.col("l_quantity") > 10, "l_suppkey", "l_returnflag", order=["l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber"])
    return found.select("l_suppkey", "l_returnflag", F.col("figure_no").cast("long").alias("figure_no"), "l_quantity")


@query(with_turns("SELECT document, ordinal, len(list_filter(regexp_split_to_array(regexp_replace(text, '[.。．][\\t\\n\\v\\f\\r ]*$', ''), '[、，,；;]'), lambda x: trim(x) <> ''))::INTEGER AS n_segments FROM turns WHERE speaker = 'assistant'"))
def answer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).where("speaker = 'assistant'").select("document", "ordinal", F.size(T.answer_segments(F.col("text"))).alias("n_segments"))


@query(with_blocks("SELECT role, nth::BIGINT AS nth, document, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY document, ordinal) AS nth FROM blocks) WHERE nth <= 4"))
def samples_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four blocks of every role."""
    n = F.row_number().over(Window.partitionBy("role").orderBy("document", "ordinal"))
    return blocks(spark, sf_dir).withColumn("nth", n.cast("long")).where("nth <= 4").select("role", "nth", "document", "ordinal")


@query("WITH p AS (SELECT l_suppkey, l_orderkey, l_partkey, lag(l_partkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_partkey) AS previous FROM lineitem) SELECT l_suppkey, sum(coalesce((l_partkey < previous)::INT, 0))::BIGINT AS n_inversions FROM p GROUP BY l_suppkey")
def order_inversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", "l_suppkey", "l_orderkey", "l_partkey").withColumn("at", F.struct("l_orderkey", "l_partkey"))
    return attribution.inversions(rows, "l_suppkey", order="at", position="l_partkey")
