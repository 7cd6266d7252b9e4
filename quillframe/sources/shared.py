"""What all executors share: the folder in which lineage is cut, and this package."""

from __future__ import annotations

import hashlib
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


class NoSharedFolder(RuntimeError):
    """A cluster whose session names no shared folder."""


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only where all of Spark is this process."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise NoSharedFolder("spark.checkpoint.dir is not set; a machine's own folder is not seen by the others")
    return tempfile.mkdtemp(prefix="quillframe-")


def packed() -> bytes:
    """This package as a zip file that Python imports from; its bytes depend on its content alone."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as file:
        for path in sorted((PACKAGE_ROOT / "quillframe").rglob("*.py")):
            entry = zipfile.ZipInfo(str(path.relative_to(PACKAGE_ROOT)), date_time=(1980, 1, 1, 0, 0, 0))
            file.writestr(entry, path.read_bytes())
    return out.getvalue()


def ship_package(spark: SparkSession) -> str:
    """Puts this package into the shared folder and gives it to all workers."""
    data = packed()
    place = f"{shared_folder(spark)}/quillframe-{hashlib.sha256(data).hexdigest()[:16]}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        stream = files.create(path)
        stream.write(bytearray(data))
        stream.close()
    spark.sparkContext.addPyFile(place)
    return place


def share_package(spark: SparkSession) -> None:
    """Lets Python workers import this package: by the driver's own path where that is theirs too, else by shipping it once."""
    context = getattr(spark, "sparkContext", None)
    if context is None:
        return
    have = context.environment.get("PYTHONPATH", "")
    if str(PACKAGE_ROOT) not in have.split(":"):
        context.environment["PYTHONPATH"] = f"{PACKAGE_ROOT}:{have}".rstrip(":")
    if not context.master.startswith("local") and context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        ship_package(spark)


def checkpointed(frame: DataFrame) -> DataFrame:
    """``frame`` written to the shared checkpoint folder and read back, partition by partition."""
    spark = frame.sparkSession
    share_package(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return frame.checkpoint(eager=True)


def stage_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, for tables that one run writes and reads again."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def removed(spark: SparkSession, folder: str) -> None:
    """Deletes ``folder`` of any file system that Spark can write."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
