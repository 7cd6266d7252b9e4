"""Writing the relational tables: a log of runs, of which only committed ones are seen.

Every run writes its tables into folders of its own, judges them there, and becomes visible by one small commit
that names its sources. A reader takes, for each source, the rows of the last committed run that named it: so a
source whose new run gives no rows has none, a failed run leaves nothing behind, and no run is ever half there.
Ledger tables keep the rows of all committed runs; tables without sources are those of the last run that wrote
them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.operators import gates
from quillframe.sources.shared import removed

TABLES = ("unit_kinds", "sources", "blocks", "units", "spans", "blanks", "layout_facts", "media", "figures", "templates", "runs")
LEDGERS = ("runs",)
SHOWN = 100
_COMMIT = "run string, at long, table string, source string"


class GateFailed(RuntimeError):
    """The staged tables were refused. ``n`` counts all findings; ``findings`` holds the first ``SHOWN`` by order."""

    def __init__(self, n: int, findings: list):
        super().__init__(f"{n} findings, first: {findings[:3]}")
        self.n, self.findings = n, findings


class Present(RuntimeError):
    """A folder that holds tables already."""


def _commits(spark: SparkSession, folder: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/commits")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(_COMMIT).parquet(f"{folder}/commits")


def initialise(spark: SparkSession, folder: str) -> None:
    """Makes an empty place for tables; refuses one that is there."""
    if _commits(spark, folder) is not None:
        raise Present(folder)
    spark.createDataFrame([], _COMMIT).write.mode("errorifexists").parquet(f"{folder}/commits")


def read(spark: SparkSession, folder: str, name: str, by: str = "source_id") -> DataFrame:
    """The rows of a table that are current."""
    commits = _commits(spark, folder)
    if commits is None:
        raise FileNotFoundError(f"no tables in {folder}")
    mine = commits.where(F.col("table") == name)
    rows = spark.read.parquet(f"{folder}/{name}")
    if name in LEDGERS:
        live = mine.select("run").distinct()
        return rows.join(live, "run", "left_semi").drop("run")
    newest = F.max(F.struct("at", "run"))
    if by not in rows.columns:
        last = mine.agg(newest.alias("c")).select("c.run")
        return rows.join(last, "run", "left_semi").drop("run")
    live = mine.groupBy("source").agg(newest.alias("c")).select(F.col("source").alias("__source"), F.col("c.run").alias("__run"))
    same = rows[by].cast("string").eqNullSafe(F.col("__source")) & (rows["run"] == F.col("__run"))
    return rows.join(live, same, "left_semi").drop("run")


def persist(spark: SparkSession, tables: dict[str, DataFrame], folder: str, judge: Callable[[dict[str, DataFrame]], DataFrame], by: str = "source_id", dry_run: bool = False, sources: DataFrame | None = None) -> dict[str, DataFrame]:
    """Writes ``tables`` under ``folder`` and commits them if ``judge`` finds no error in what was staged.

    ``sources`` (column ``by``) names the sources of the run, those without rows too; by default those of the table
    sources, or of all tables. A failed gate removes what was staged and raises; a dry run removes it and gives
    what is current.
    """
    run = uuid.uuid4().hex
    place = {name: f"{folder}/{name}/run={run}" for name in tables}
    staged = {}
    for name, rows in tables.items():
        rows.write.mode("errorifexists").parquet(place[name])
        staged[name] = spark.read.parquet(place[name])
    errors = judge(staged).where("severity = 'error'").select(*gates.FINDING)
    n = errors.count()
    first = errors.orderBy(*gates.FINDING).limit(SHOWN).collect() if n else []
    if n or dry_run:
        for path in place.values():
            removed(spark, path)
        if n:
            raise GateFailed(n, first)
        return {name: read(spark, folder, name, by) for name in tables if _commits(spark, folder) is not None}
    owners = sources if sources is not None else staged.get("sources")
    if owners is None or by not in owners.columns:
        keyed = [rows.select(by) for rows in staged.values() if by in rows.columns]
        owners = gates.union(*keyed) if keyed else spark.createDataFrame([], f"{by} string")
    names = spark.createDataFrame([(name,) for name in tables], "table string")
    last = _commits(spark, folder)
    at = (last.agg(F.max("at")).first()[0] or 0) + 1 if last is not None else 1
    every = owners.select(F.col(by).cast("string").alias("source")).distinct()
    each = names.join(every, F.lit(True), "left") if not every.isEmpty() else names.withColumn("source", F.lit(None).cast("string"))
    whole = names.where(~F.col("table").isin(*(n for n, rows in staged.items() if by in rows.columns))).withColumn("source", F.lit(None).cast("string"))
    commit = each.unionByName(whole).distinct().select(F.lit(run).alias("run"), F.lit(at).cast("long").alias("at"), "table", "source")
    commit.coalesce(1).write.mode("append").parquet(f"{folder}/commits")  # the one switch
    return {name: read(spark, folder, name, by) for name in tables}
