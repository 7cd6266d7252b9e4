"""Shared pieces: shared-folder checkpoints, Arrow text buffers and bounded slices of record batches."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.sources.shared import checkpointed, removed, share_package, stage_folder  # noqa: F401

BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20
HOT_ROWS = 1000
#: Bytes that the regular expression class [\x20\x09-\x0D] matches.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def small_batches(frame: DataFrame) -> DataFrame:
    """``frame``, in a session whose Arrow batches hold BATCH_ROWS rows and about BATCH_BYTES at most.

    Texts are long, and a batch is held whole. The session keeps the lower limits; any result is the same with others.
    """
    spark = frame.sparkSession
    share_package(spark)
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    return frame


def freed(spark: SparkSession) -> None:
    """Lets go of the shuffle files of tables that nothing reads any more: Spark deletes them once the driver's objects are collected."""
    gc.collect()
    spark._jvm.System.gc()


def partitions_for(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_limit(spark: SparkSession, n_rows: int) -> int:
    """Rows of one key from which it is hot: a quarter of a partition's mean. At most four keys a partition are."""
    return max(HOT_ROWS, -(-n_rows // (4 * partitions_for(spark))))


def joined_to_hot(rows: DataFrame, one: DataFrame, key: str, weight: str, n_rows: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``one``, which has a row per ``key`` and in ``weight`` how many of the ``n_rows`` rows have it.

    The few hot keys are looked up where their rows are; all others meet in an exchange.
    """
    hot = F.col(weight) > hot_limit(rows.sparkSession, n_rows)
    few = F.broadcast(one.where(hot))  # at most four rows a partition
    rest = rows.join(F.broadcast(one.where(hot).select(key)), key, "left_anti")
    return rows.join(few, key).unionByName(rest.join(one.where(~hot), key, how), allowMissingColumns=True)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose ``column`` holds about ``most`` bytes; a longer text is a run of its own."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # the worker lives on for other tasks


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins (one more for the end); null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pa.concat_arrays([column])
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeStringArray:
    """The byte ranges ``starts`` to ``ends`` (ascending, disjoint) of ``raw`` as an Arrow array."""
    n = ends - starts
    offsets = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n, out=offsets[1:])
    marks = np.zeros(len(raw) + 1, dtype=np.int8)
    full = n > 0
    marks[starts[full]] += 1  # disjoint, so no start or end comes twice
    marks[ends[full]] -= 1
    kept = raw[np.cumsum(marks[:-1], dtype=np.int8).astype(bool)]
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets.tobytes()), pa.py_buffer(kept.tobytes()))


def exact_ids(values: pa.Array) -> np.ndarray:
    """Equal values get equal numbers, others different ones."""
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values. For large arrays of integers a plain sort is far faster than numpy's own function, which hashes."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finalizer of a published generator (splitmix64), by element."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def row_key(*names: str) -> Column:
    """128 bits that identify the values of ``names``, nulls included."""
    return F.md5(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))
