"""Reading the star-schema and corpus tables."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.sources.shared import share_package


class NotOne(ValueError):
    """A name that should mean one file and means none or several."""


def resolved(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern of any file system, sorted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(str(f.getPath()) for f in found)


def only(spark: SparkSession, pattern: str) -> str:
    """The one path that matches; none or several are refused."""
    found = resolved(spark, pattern)
    if len(found) != 1:
        raise NotOne(f"{pattern}: {len(found)} files {[PurePosixPath(f).name for f in found[:3]]}")
    return found[0]


def spread(frame: DataFrame) -> DataFrame:
    """``frame`` over as many partitions as there are cores, where its files give fewer.

    A few files, or files of one row group, leave cores idle before work that costs far more than this
    exchange. Inputs of a cluster's size have more partitions than cores and stay as they are.
    """
    context = getattr(frame.sparkSession, "sparkContext", None)
    if context is None or frame.rdd.getNumPartitions() >= context.defaultParallelism:
        return frame
    return frame.repartition(context.defaultParallelism)


def partitions(*frames: DataFrame, pieces: int = 8) -> int:
    """How many partitions an exchange needs for few rows in each: ``pieces`` for each one that the largest of ``frames`` has.

    Left to itself Spark merges partitions up to 64 MB as they are written, where rows that are much alike take next to
    nothing; in memory, sorted, they fill a task.
    """
    spark = frames[0].sparkSession
    context = getattr(spark, "sparkContext", None)
    least = 0 if context is None else max(4 * context.defaultParallelism, *(pieces * f.rdd.getNumPartitions() for f in frames))
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The table ``name`` of ``folder``; only ``columns`` when any are given, so the scan is pruned."""
    share_package(spark)
    frame = spark.read.parquet(f"{folder}/{name}.parquet")
    return frame.select(*(F.col(f"`{c}`") for c in columns)) if columns else frame
