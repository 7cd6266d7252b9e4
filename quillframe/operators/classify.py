"""What a block is: precedence of marks over rules, and refusal of roles that nobody mapped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions import text as T
from quillframe.functions.dialect import BadRules


def precedence(blocks: DataFrame, banners: DataFrame, heads: Column) -> DataFrame:
    """role of each block: empty, else banner (its text's hash is registered), else ``heads`` where it says one, else the rules' role."""
    known = banners.select("banner_id").distinct().withColumn("__known", F.lit(True))
    rows = blocks.withColumn("banner_id", T.content_id(F.col("text"), 12)).join(known, "banner_id", "left")
    role = F.when(F.col("text") == "", "empty").when(F.col("__known"), "banner")
    return rows.withColumn("role", F.coalesce(role, heads, F.col("role"))).drop("__known", "banner_id")


def refuse_unmapped(blocks: DataFrame, mapping: DataFrame, key: str = "role") -> DataFrame:
    """``blocks``, if the mapping knows every key in use; else the run is refused with those it lacks."""
    lacking = blocks.select(key).distinct().join(mapping.select(key), key, "left_anti").sort(key)
    names = [r[0] for r in lacking.collect()]  # at most the roles that rules can give
    if names:
        raise BadRules(f"roles without a kind: {names}")
    return blocks
