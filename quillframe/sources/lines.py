"""Line-oriented sources as block tables: one row per line, with its locator and its text as it stands."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.text import marker_ordinal

def _with_field(name: str, make: Callable[[Column], Column], of: str) -> Callable[[Column], Column]:
    return lambda row: row.withField(name, make(row[of]))


def line_blocks(docs: DataFrame, document: str = "doc_id", text: str = "text", derived: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """document, ordinal (from 1), locator and raw_text of every line, and columns derived from one another in turn.

    The first of ``derived`` is a function of the line, each further one of the one before. They are made
    before the lines are taken apart, so that each is computed once, whatever filters come later.
    """
    each = F.transform(F.split(F.col(text), "\n"), lambda x: F.struct(x.alias("raw_text")))
    last = "raw_text"
    for name, make in (derived or {}).items():
        each = F.transform(each, _with_field(name, make, last))
        last = name
    lines = docs.select(F.col(document).alias("document"), F.posexplode(each).alias("pos", "line"))
    ordinal = F.col("pos").cast("long") + 1
    return lines.select("document", ordinal.alias("ordinal"), F.concat(F.lit("body/p["), ordinal.cast("string"), F.lit("]")).alias("locator"), "line.*")


def marker_lines(lines: DataFrame, text: str = "raw_text") -> DataFrame:
    """Of rendered lines, those that begin with a printed number, with that number."""
    return lines.withColumn("printed", marker_ordinal(F.col(text))).where("printed IS NOT NULL")


def turn_blocks(conversations: DataFrame) -> DataFrame:
    """Turns as blocks: document is the conversation, ordinal the turn, role as given."""
    return conversations.select(F.col("conv_id").alias("document"), F.col("turn").alias("ordinal"), F.concat(F.lit("turn["), F.col("turn").cast("string"), F.lit("]")).alias("locator"), F.col("role").alias("speaker"), F.col("text").alias("raw_text"))


def char_total(blocks: DataFrame) -> DataFrame:
    """Blocks and characters of each document."""
    return blocks.groupBy("document").agg(F.count("*").alias("n_blocks"), F.sum(F.length("raw_text")).cast("long").alias("n_chars"))


def media(parts: DataFrame, content: str = "content", name: str = "name") -> DataFrame:
    """A media store: one row per distinct content, the first name by order kept; sha256 prefix and extension."""
    digest = F.substring(F.sha2(F.col(content), 256), 1, 16)
    return parts.groupBy(digest.alias("media_id")).agg(F.min(name).alias("name"), F.count("*").alias("n_uses")).withColumn("ext", F.lower(F.regexp_extract("name", r"\.([A-Za-z0-9]+)$", 1)))
