"""Tables in text documents as rows, with the heading they stand under."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def table_rows(files: DataFrame) -> DataFrame:
    """path, line_no, heading (the last one before) and cells of every table row; rulers are left out.

    files: path and value (the whole text).
    """
    lines = files.select("path", F.posexplode(F.split("value", "\n")).alias("line_no", "line")).withColumn("line", F.trim("line"))
    title = F.regexp_extract("line", r"^#{1,6}\s+(.*)$", 1)
    upto = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("heading", F.last(F.when(title != "", title), ignorenulls=True).over(upto))
    rows = lines.where(F.col("line").rlike(r"^\|.*\|$") & ~F.col("line").rlike(r"^\|[\s:|-]+\|$"))
    cells = F.transform(F.split(F.regexp_extract("line", r"^\|(.*)\|$", 1), r"\|"), lambda c: F.trim(F.replace(c, F.lit("`"), F.lit(""))))
    return rows.select("path", "line_no", "heading", cells.alias("cells"))


def read_tables(spark, path: str) -> DataFrame:
    text = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), "value")
    return table_rows(text)


def provenance(rows: DataFrame, ported: str, adjudications: str) -> tuple[DataFrame, DataFrame]:
    """Vendored files (path, digest, kind: copied or, under the heading ``ported``, ported) and decisions (path, digest, verdict, why)."""
    section = F.coalesce(F.col("heading"), F.lit(""))
    cell = lambda k: F.get("cells", F.lit(k))
    files = rows.where(~section.contains(adjudications)).select(F.regexp_extract(cell(1), r"([^\s`]+\.(?:py|json))", 1).alias("path"), cell(2).alias("digest"), F.when(section.contains(ported), "ported").otherwise("copied").alias("kind")).where("path <> ''")
    decided = rows.where(section.contains(adjudications)).select(cell(0).alias("path"), cell(1).alias("digest"), cell(2).alias("verdict"), cell(3).alias("why")).where(F.col("digest").rlike("^[0-9a-f]{64}$"))
    return files, decided
