"""Counts, histograms, modes, identities, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carve_report(blocks: DataFrame, *more: Column) -> DataFrame:
    """One row by kind and role: blocks, documents, characters, blanks, longest, and what ``more`` aggregates give."""
    return blocks.groupBy("role", "kind").agg(
        F.count("*").alias("n_blocks"),
        F.countDistinct("document").alias("n_documents"),
        F.sum(F.length("text")).cast("long").alias("n_chars"),
        F.sum(F.when(F.col("text") == "", 1).otherwise(0)).cast("long").alias("n_empty"),
        F.max(F.length("text")).cast("long").alias("longest"),
        *more,
    )


def census(blocks: DataFrame, scope: Column, style: str, samples: int = 4) -> DataFrame:
    """By role: hits, hits in scope, the most frequent style (least on ties), first samples, promotable from two hits."""
    by_style = blocks.groupBy("role", style).agg(F.count("*").alias("n"), F.sum(scope.cast("long")).alias("s"))
    counts = by_style.groupBy("role").agg(F.sum("n").alias("hits"), F.sum("s").alias("in_scope"), F.max_by(style, F.struct("n", F.lit(0) - F.col(style))).alias("dominant"))
    first = first_rows(blocks, samples, "role", order=["document", "ordinal"])
    shown = first.groupBy("role").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "locator"))), lambda s: s["locator"]), ";").alias("samples"))
    return counts.join(shown, "role").withColumn("promotable", F.col("hits") >= 2)


def fingerprint(blocks: DataFrame, matched: Column, least: float = 0.8) -> DataFrame:
    """Share of non-empty blocks that a template knows; an empty scope is refused."""
    rows = blocks.where(F.trim("text") != "").agg(F.count("*").alias("total"), F.sum(matched.cast("long")).alias("matched"))
    checked = F.when(F.col("total") == 0, F.raise_error(F.lit("fingerprint: no non-empty block in scope"))).otherwise(F.round(F.col("matched") / F.col("total"), 6))
    return rows.withColumn("coverage", checked).withColumn("verdict", F.when(F.col("coverage") > least, "match").otherwise("no match"))


def predicate_hits(blocks: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """Each predicate's own number of hits (not first match), and its problem."""
    counted = blocks.agg(*(F.sum(p.cast("long")).alias(name) for name, p in predicates.items()))
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("predicate"), F.col(n).alias("hits")) for n in predicates)))
    return counted.select(rows.alias("r")).select("r.*").withColumn("problem", F.when(F.col("hits") == 0, "NEVER_MATCHES"))


def weighted_mode(runs: DataFrame, *keys: str, size: str, weight: str, place: str) -> DataFrame:
    """The size with the most characters; on ties the one seen first."""
    totals = runs.groupBy(*keys, size).agg(F.sum(weight).alias("w"), F.min(place).alias("first"))
    return totals.groupBy(*keys).agg(F.max_by(size, F.struct("w", -F.col("first"))).alias("body_size"), F.max("w").cast("long").alias("weight"))


def dominant_run(runs: DataFrame, *keys: str, size: str, chars: str, place: str) -> DataFrame:
    """The size of the longest single run that has one; on ties the first."""
    return runs.where(F.col(size).isNotNull()).groupBy(*keys).agg(F.max_by(size, F.struct(chars, -F.col(place))).alias("dominant_size"))


def sum_identity(parts: DataFrame, totals: DataFrame, key: str, value: str, total: str, tolerance: float = 0.005) -> DataFrame:
    """Whether parts add up to the declared total: ok, MISMATCH, no-total, no-sections."""
    summed = parts.groupBy(key).agg(F.sum(value).alias("parts_sum"))
    rows = summed.join(totals.select(key, F.col(total).alias("declared")), key, "full_outer")
    verdict = F.when(F.col("declared").isNull(), "no-total").when(F.col("parts_sum").isNull(), "no-sections").when(F.abs(F.col("parts_sum") - F.col("declared")) <= tolerance, "ok").otherwise("MISMATCH")
    return rows.withColumn("verdict", verdict)


def histogram(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def coverage(occurring: DataFrame, recorded: DataFrame, *keys: str) -> DataFrame:
    """Occurring facts with how often each was recorded; missing: not at all."""
    a, b = histogram(occurring, *keys).withColumnRenamed("n", "n_occurring"), histogram(recorded, *keys).withColumnRenamed("n", "n_recorded")
    return a.join(b, list(keys), "left").withColumn("n_recorded", F.coalesce("n_recorded", F.lit(0))).withColumn("missing", F.col("n_recorded") == 0)


def before_after(before: DataFrame, after: DataFrame, *keys: str) -> DataFrame:
    a, b = histogram(before, *keys).withColumnRenamed("n", "n_before"), histogram(after, *keys).withColumnRenamed("n", "n_after")
    return a.join(b, list(keys), "full_outer").select(*keys, F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))


def before_kept(before: DataFrame, kept: Column, *keys: str) -> DataFrame:
    """:func:`before_after` where what comes after is the rows that ``kept`` holds for: one pass."""
    return before.groupBy(*keys).agg(F.count("*").alias("n_before"), F.count_if(kept).alias("n_after"))


def distributions(source: DataFrame, output: DataFrame, adjudicated: list[str]) -> DataFrame:
    """Verdict for each property: unused, adjudicated, unlinked, weakened, connected.

    Both sides hold (property, value). One value throughout while the source varies is unlinked; fewer
    values than the source is weakened.
    """
    a = source.groupBy("property").agg(F.count("*").alias("n_source"), F.countDistinct("value").alias("source_values"))
    b = output.groupBy("property").agg(F.count("*").alias("n_output"), F.countDistinct("value").alias("output_values"))
    rows = a.join(b, "property", "full_outer").select("property", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_source", "source_values", "n_output", "output_values")))
    verdict = F.when(F.col("n_source") == 0, "unused").when(F.col("property").isin(*adjudicated), "adjudicated").when((F.col("source_values") > 1) & (F.col("output_values") <= 1), "unlinked").when(F.col("output_values") < F.col("source_values"), "weakened").otherwise("connected")
    return rows.withColumn("verdict", verdict)


def content_copies(blocks: DataFrame, digest: Column) -> DataFrame:
    """Contents that stand at several places."""
    return blocks.groupBy(digest.alias("digest")).agg(F.count("*").alias("n_copies"), F.min(F.struct("document", "ordinal")).alias("f")).where("n_copies > 1").select("digest", "n_copies", F.col("f.document").alias("first_document"), F.col("f.ordinal").alias("first_ordinal"))


def balance(rows: DataFrame, *keys: str, images: Column, owners: Column, placed: Column) -> DataFrame:
    """Images, owners and placed ones by key; unattributed where they differ."""
    out = rows.groupBy(*keys).agg(*(F.sum(c.cast("long")).alias(n) for n, c in (("n_images", images), ("n_owners", owners), ("n_placed", placed))))
    return out.withColumn("code", F.when((F.col("n_images") != F.col("n_owners")) | (F.col("n_owners") != F.col("n_placed")), "FIGURE_UNATTRIBUTED"))


def digest_of(rows: DataFrame, *keys: str, name: str, content: Column) -> DataFrame:
    """One digest by key over names and contents in the order of names."""
    each = F.sort_array(F.collect_list(F.struct(F.col(name).alias("a"), F.sha2(content, 256).alias("d"))))
    return rows.groupBy(*keys).agg(F.count("*").alias("n_parts"), F.sha2(F.array_join(F.transform(each, lambda r: F.concat_ws(":", r["a"].cast("string"), r["d"])), "\n"), 256).alias("digest"))


def top_rows(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """A report of the first ``k`` rows."""
    return rows.orderBy(*order).limit(k)


def first_rows(rows: DataFrame, k: int, *keys: str, order: list) -> DataFrame:
    """The first ``k`` rows of each key, with nth. The limit on the rank lets every partition drop all but its own first ones before the exchange."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("nth") <= k)


def origin_limit(rows: DataFrame, origin: str, *keys: str) -> DataFrame:
    """The most occurrences of ``keys`` in any one origin: the number that a batch may claim."""
    return rows.groupBy(origin, *keys).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max("n").alias("limit"), F.count("*").alias("n_origins"))


def plain_mode(rows: DataFrame, *keys: str, value: str, place: str) -> DataFrame:
    """The most frequent value, each row counted once; on ties the one seen first. Null values do not count."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(place).alias("first"))
    best = F.min(F.struct((-F.col("n")).alias("k"), "first", F.col(value).alias("v"))).alias("b")
    return counted.groupBy(*keys).agg(best).select(*keys, F.col("b.v").alias(value), (-F.col("b.k")).alias("n"))
