"""Which characters belong to which unit: half-open spans, gaps, ratios, blanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.functions.udfs import regex_spans


SPAN = ("block", "char_start", "char_end", "unit", "role")


def event(start: Column, end: Column, unit: Column, role: Column) -> Column:
    """A span as an element of a stream."""
    return F.struct(start.cast("long").alias("char_start"), end.cast("long").alias("char_end"), unit.cast("string").alias("unit"), role.cast("string").alias("role"))


def block_end(n_chars: Column) -> Column:
    """Where a block ends: an element without unit and role."""
    nothing = F.lit(None)
    return event(n_chars, n_chars, nothing, nothing)


def stream(spans: DataFrame, blocks: DataFrame) -> DataFrame:
    """Spans and block ends (role null) of two tables as one; sources that make both in one pass build it themselves."""
    ends = blocks.select("block", F.inline(F.array(block_end(F.col("n_chars")))))
    return spans.select(*SPAN).unionByName(ends)


def _by_start():
    return Window.partitionBy("block").orderBy("char_start", "char_end")


def filled_stream(rows: DataFrame) -> DataFrame:
    """The spans and a residual span for each gap, of the block's first unit or, without one, of a unit of its own.

    One exchange by block: what was reached so far, the block's end last, gives every gap.
    """
    at_end = F.col("role").isNull()
    order = Window.partitionBy("block").orderBy(at_end, "char_start", "char_end").rowsBetween(Window.unboundedPreceding, -1)
    first = F.min(F.when(~at_end, F.struct("char_start", "unit"))).over(Window.partitionBy("block"))
    placed = rows.select(*SPAN, F.coalesce(F.max("char_end").over(order), F.lit(0)).cast("long").alias("reached"), first["unit"].alias("owner"))
    unit = F.coalesce("owner", F.concat(F.col("block").cast("string"), F.lit("#residual")))
    gap = F.when(F.col("char_start") > F.col("reached"), event(F.col("reached"), F.col("char_start"), unit, F.lit("residual")))
    own = F.when(~at_end, event(*(F.col(c) for c in SPAN[1:])))
    return placed.select("block", F.inline(F.array_compact(F.array(gap, own))))


def filled(spans: DataFrame, blocks: DataFrame) -> DataFrame:
    """:func:`filled_stream` of spans and the blocks (block, n_chars) they lie in."""
    return filled_stream(stream(spans, blocks))


def attributed_stream(rows: DataFrame, *keys: str) -> DataFrame:
    """attributed, total and their ratio by ``keys``, columns that spans and block ends both have."""
    at_end = F.col("role").isNull()
    sums = rows.groupBy(*keys).agg(F.sum(F.when(at_end, F.lit(0)).otherwise(F.col("char_end") - F.col("char_start"))).cast("long").alias("attributed"), F.sum(F.when(at_end, F.col("char_end")).otherwise(0)).cast("long").alias("total"))
    return sums.withColumn("ratio", F.when(F.col("total") > 0, F.round(F.col("attributed") / F.col("total"), 6)))


def overlaps(spans: DataFrame) -> DataFrame:
    """Spans that begin before an earlier one of their block ends, and empty ones."""
    reached = F.max("char_end").over(_by_start().rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.withColumn("reached", reached)
    code = F.when(F.col("char_end") <= F.col("char_start"), "SPAN_EMPTY").when(F.col("char_start") < F.col("reached"), "SPAN_OVERLAP")
    return rows.withColumn("code", code).where("code IS NOT NULL").drop("reached")


def attribution(spans: DataFrame, blocks: DataFrame, *keys: str) -> DataFrame:
    """attributed, total and their ratio by ``keys``."""
    got = spans.groupBy("block").agg(F.sum(F.col("char_end") - F.col("char_start")).alias("got"))
    rows = blocks.join(got, "block", "left").groupBy(*keys).agg(F.sum(F.coalesce("got", F.lit(0))).cast("long").alias("attributed"), F.sum("n_chars").cast("long").alias("total"))
    return rows.withColumn("ratio", F.when(F.col("total") > 0, F.round(F.col("attributed") / F.col("total"), 6)))


def ratchet(runs: DataFrame, *keys: str, order: str, value: str) -> DataFrame:
    """Runs with the value before them and whether it fell."""
    previous = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    return runs.withColumn("previous", previous).withColumn("fell", F.coalesce(F.col(value) < F.col("previous"), F.lit(False)))


BLANK = "[_＿]{2,}"


def blanks(spans: DataFrame, blocks: DataFrame, *keys: str) -> DataFrame:
    """Runs of underscores inside spans, numbered in their unit; evidence "underscore"."""
    found = blocks.select("block", *keys, F.explode(regex_spans(BLANK)(F.col("text"))).alias("m"))
    inside = spans.join(found, "block").where("m.start >= char_start AND m.end <= char_end")
    number = F.row_number().over(Window.partitionBy("unit").orderBy("block", F.col("m.start")))
    return inside.select("unit", "block", number.alias("blank_no"), F.col("m.start").alias("start"), F.col("m.end").alias("end"), F.lit("underscore").alias("evidence"))


def interval_assign(points: DataFrame, windows: DataFrame, key: str, offset: str, lead: int = 2) -> DataFrame:
    """Each point in the option window [start + lead, next start + lead) of its row; the last window is open, earlier points lead.

    Windows of a row are few; the row is the join key, so no pairs beyond it arise.
    """
    bounded = windows.withColumn("until", F.lead("start").over(Window.partitionBy(key).orderBy("start")))
    hit = (points[key] == bounded[key]) & (points[offset] >= bounded["start"] + lead) & (F.col("until").isNull() | (points[offset] < F.col("until") + lead))
    return points.join(bounded, hit, "left").select(points["*"], F.coalesce(bounded["label"], F.lit("lead")).alias("label"))


def inversions(rows: DataFrame, *keys: str, order: str, position: str) -> DataFrame:
    """Adjacent descents of ``position`` in the order of the output."""
    previous = F.lag(position).over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("previous", previous).groupBy(*keys).agg(F.sum(F.coalesce((F.col(position) < F.col("previous")).cast("long"), F.lit(0))).alias("n_inversions"))


def figure_ordinals(figures: DataFrame, usable: Column, *keys: str, order: list[str]) -> DataFrame:
    """Numbers of figures in their unit; skipped ones use up theirs."""
    return figures.withColumn("figure_no", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(usable)
