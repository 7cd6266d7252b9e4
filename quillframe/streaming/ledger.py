"""The run ledger as a stream: windows, sessions, late data, repeats, and the question machine with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

QUESTION_SCHEMA = "document long, ordinal long, question long, is_stem boolean"


def _watermarked(events: DataFrame, late: str) -> DataFrame:
    """A stream with its watermark, which needs times with a zone; a batch as it is."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and type; rows later than ``late`` are not counted in a stream."""
    rows = _watermarked(events, late)
    return rows.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("v")).select(F.col("window.start").alias("start"), "event_type", "n", "v")


def sliding(events: DataFrame, width: str = "1 hour", step: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    rows = _watermarked(events, late)
    return rows.groupBy(F.window("ts", width, step)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    rows = _watermarked(events, late)
    return rows.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def once(events: DataFrame, *keys: str, late: str = "2 hours") -> DataFrame:
    """Repeats of the same keys within the watermark are dropped."""
    return _watermarked(events, late).dropDuplicatesWithinWatermark([*keys]) if events.isStreaming else events.dropDuplicates([*keys])


def question_machine(blocks: DataFrame) -> DataFrame:
    """The open and close machine of questions over a stream of blocks (document, ordinal, kind), one state per document.

    Blocks of a document come in order. The state is the number of the last question and whether it is open.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, is_open = state.get if state.exists else (0, False)
        for frame in frames:
            out = []
            for ordinal, kind in frame.sort_values("ordinal")[["ordinal", "kind"]].itertuples(index=False):
                if kind == "header":
                    continue
                if kind == "stem":
                    number, is_open = number + 1, True
                elif kind in ("section", "sub-module", "section-banner"):
                    is_open = False
                out.append((key[0], ordinal, number if is_open else None, kind == "stem"))
            yield pd.DataFrame(out, columns=["document", "ordinal", "question", "is_stem"]).astype({"question": "Int64"})
        state.update((number, is_open))

    return blocks.groupBy("document").applyInPandasWithState(step, QUESTION_SCHEMA, "number long, is_open boolean", "append", GroupStateTimeout.NoTimeout)


def read_stream(spark: SparkSession, folder: str, name: str, files_at_once: int = 1) -> DataFrame:
    """A table's parquet file as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name}.parquet*")


def drained(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """All that is there now, as a table in memory."""
    done = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    done.awaitTermination()
    return stream.sparkSession.table(name)
