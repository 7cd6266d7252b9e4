"""The rule table for the supplied corpus, its block tables, and the same tables in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.functions import dialect
from quillframe.functions.dialect import Rule
from quillframe.functions.text import collapse_ws
from quillframe.sources.lines import line_blocks, turn_blocks
from quillframe.sources.tables import spread, table

PLAIN = "plain"
#: Roles of lines, most specific first; two rules may share an id.
RULES = [
    Rule(10, "blank", "body", r"\s*$"),
    Rule(20, "licence", "callout", r".*\b(Licen[sc]e|Copyright)\b"),
    Rule(30, "shout", "section-banner", r"[A-ZÀ-Þ]{3}"),
    Rule(40, "contact", "callout", r".*\S@\S"),
    Rule(50, "listed", "sub-module", r"\S+ \| \S"),
    Rule(60, "figure", "stem", r".*\d"),
    Rule(70, "short", "section", r".{1,40}$"),
    Rule(71, "figure", "stem", r".*%%%"),
]
ROLES = sorted({r.id for r in RULES} | {PLAIN})


def bare_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents as they stand: what nobody classifies is not normalised either."""
    return line_blocks(spread(table(spark, sf_dir, "documents", "doc_id", "text")))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents with their normalised text."""
    return line_blocks(spread(table(spark, sf_dir, "documents", "doc_id", "text")), derived={"text": collapse_ws})


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents with text, role and kind."""
    docs = spread(table(spark, sf_dir, "documents", "doc_id", "text"))
    lines = line_blocks(docs, derived={"text": collapse_ws, "role": lambda text: dialect.first_match(RULES, text, PLAIN)})
    return lines.withColumn("kind", dialect.kind_of(RULES, F.col("role")))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of the conversations; a user's turn is a stem, a system's a header."""
    kind = F.when(F.col("speaker") == "user", "stem").when(F.col("speaker") == "system", "header").otherwise("body")
    return turn_blocks(table(spark, sf_dir, "conversations")).withColumn("kind", kind).withColumn("text", F.col("raw_text"))


LINES_SQL = "lines AS (SELECT doc_id AS document, i::BIGINT AS ordinal, 'body/p[' || i || ']' AS locator, x AS raw_text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))"
COLLAPSED = f"trim(regexp_replace(raw_text, '[{dialect.SPACES}]+', ' ', 'g'))"
BLOCKS_SQL = (
    f"{LINES_SQL}, texts AS (SELECT *, {COLLAPSED} AS text FROM lines), roles AS (SELECT *, {dialect.first_match_sql(RULES, 'text', PLAIN)} AS role FROM texts), "
    f"blocks AS (SELECT *, {dialect.kind_of_sql(RULES, 'role')} AS kind FROM roles)"
)
TURNS_SQL = "turns AS (SELECT conv_id AS document, turn AS ordinal, 'turn[' || turn || ']' AS locator, role AS speaker, text AS raw_text, text, CASE role WHEN 'user' THEN 'stem' WHEN 'system' THEN 'header' ELSE 'body' END AS kind FROM conversations)"


def with_blocks(sql: str) -> str:
    return f"WITH {BLOCKS_SQL} {sql}" if not sql.startswith(",") else f"WITH {BLOCKS_SQL}{sql}"


def with_turns(sql: str) -> str:
    return f"WITH {TURNS_SQL} {sql}" if not sql.startswith(",") else f"WITH {TURNS_SQL}{sql}"
