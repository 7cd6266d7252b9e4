"""From raw documents to packed sequences: five stages, each one operator, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.llm import common, jaccard, lines, packing, pii, quality, queries
from quillframe.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep. Null and empty texts, and those under ten words, go."""
    return quality.rejected_out(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that several share, which stay in the one with the largest doc_id."""
    return lines.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the least doc_id."""
    return jaccard.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    return pii.masked_out(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its place in a sequence."""
    out = packing.packed(docs, queries.tokenizer_file(queries.WORD_TOKENIZER), "doc_id")
    return out.select("doc_id", F.col("__piece").alias("piece"), F.col("__start").alias("start"), F.col("__length").alias("length"), F.col("__crc32").alias("ids_crc32"), F.col("__sequence").alias("sequence_id"), F.col("__offset").alias("offset"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: Rolling hashes, near-duplicate classes and token ids are not for SQL; a brute-force version tests the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each but the last written to the shared folder and read again.

    A stage's table goes once the next one is written; that of the last but one stays, as the result reads it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    folder = common.stage_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        here = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(here)
        docs = spark.read.parquet(here)
        if before is not None:
            common.removed(spark, before)
        before = here
    return STAGES[-1][1](spark, docs, sf_dir)
