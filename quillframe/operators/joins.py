"""Joins between questions, answers, owners, sources and copies."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEM_PREFIX = 18


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def last_by(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key: later writers win."""
    values = F.max(F.struct(order, *(c for c in rows.columns if c not in (*keys, order)))).alias("r")
    return rows.groupBy(*keys).agg(values).select(*keys, "r.*")


def answer_join(questions: DataFrame, answers: DataFrame, place: list[str]) -> DataFrame:
    """Each question with its answer: by place and beginning of the stem, else by place and number.

    Places may be null and match null. Of several answers the last one counts. matched_by tells which key hit.
    """
    prefix = lambda rows: rows.withColumn("prefix", F.substring("stem", 1, STEM_PREFIX))
    by_stem = last_by(prefix(answers).select(*place, "prefix", "ordinal", "answer"), [*place, "prefix"], "ordinal").select(*place, "prefix", F.col("answer").alias("stem_answer"))
    by_number = last_by(answers.where("number IS NOT NULL").select(*place, "number", "ordinal", "answer"), [*place, "number"], "ordinal").select(*place, "number", F.col("answer").alias("number_answer"))
    rows = prefix(questions)
    rows = rows.join(by_stem, _same(rows, by_stem, [*place, "prefix"]), "left").select(rows["*"], "stem_answer")
    rows = rows.join(by_number, _same(rows, by_number, place) & (rows["number"] == by_number["number"]), "left").select(rows["*"], "number_answer")
    return rows.withColumn("answer", F.coalesce("stem_answer", "number_answer")).withColumn("matched_by", F.when(F.col("stem_answer").isNotNull(), "stem").when(F.col("number_answer").isNotNull(), "number"))


def first_owner(spans: DataFrame) -> DataFrame:
    """The unit of the first span of each block."""
    return spans.groupBy("block").agg(F.min_by("unit", F.struct("char_start", "unit")).alias("owner"))


def owner_join(blocks: DataFrame, units: DataFrame) -> DataFrame:
    """The first unit by order at each block's locator, or at its table for blocks in tables."""
    root = F.substring_index("locator", "/tr[", 1)
    first = units.groupBy("document", F.col("locator").alias("root")).agg(F.min_by("unit", "ordinal").alias("owner"))
    return blocks.withColumn("root", root).join(first, ["document", "root"], "left")


def orphans(blocks: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks with text that no span claims."""
    return blocks.join(spans, keys, "left_anti")


def unclaimed(blocks: DataFrame, is_claimed: Column, heading: Column, per: str = "document", order: str = "ordinal", text: str = "raw_text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Blocks that nobody claims: a heading if one of its document's heading texts (``heading``, null for none) is inside it, else prose.

    Both sides are the same table, so it is read once: each document's headings come first, then its
    unclaimed blocks, with the columns ``carry``. A task holds the headings of one document, as an automaton, and
    streams the blocks.
    """
    sides = F.array_compact(F.array(F.when(heading != "", F.struct(F.lit(0).alias("side"), heading.alias("words"))), F.when(~is_claimed, F.struct(F.lit(1).alias("side"), F.col(text).alias("words")))))
    rows = blocks.select(per, order, F.inline(sides), *carry)
    dealt = rows.repartition(per).sortWithinPartitions(per, "side", order)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return dealt.mapInArrow(_headed, ", ".join([*(f"`{c}` {kinds[c]}" for c in (per, order, *carry)), "unit_kind string"]))


def _headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks behind the headings of their document, which the side column sorts before them."""
    unset = object()
    key, automaton = unset, None
    for batch in batches:
        keys, sides, words = (batch.column(i).to_pylist() for i in (0, 2, 3))
        kept, kinds = [], []
        for i, (now, side, text) in enumerate(zip(keys, sides, words)):
            if key is unset or now != key:
                key, automaton, made = now, None, False
            if side == 0:
                automaton = automaton or ahocorasick.Automaton()
                automaton.add_word(text, 1)
                continue
            if automaton is not None and not made:
                automaton.make_automaton()
                made = True
            hit = automaton is not None and next(automaton.iter(text or ""), None) is not None
            kept.append(i)
            kinds.append("heading" if hit else "prose")
        names = [c for c in batch.schema.names if c not in ("side", "words")]
        rows = batch.select(names).take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(kinds, pa.string())], names=[*names, "unit_kind"])


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows on one side only, with the side."""
    keys = left.columns
    a, b = left.distinct().withColumn("in_left", F.lit(True)), right.distinct().withColumn("in_right", F.lit(True))
    both = a.join(b, keys, "full_outer")
    return both.where("in_left IS NULL OR in_right IS NULL").select(*keys, F.when(F.col("in_left").isNotNull(), "left").otherwise("right").alias("side"))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Values whose numbers differ, with both numbers."""
    keys = left.columns
    a, b = (x.groupBy(*keys).agg(F.count("*").alias(n)) for x, n in ((left, "n_left"), (right, "n_right")))
    both = a.join(b, keys, "full_outer").select(*keys, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_left", "n_right")))
    return both.where("n_left <> n_right")


def disposition(files: DataFrame, consumed: DataFrame, excluded: DataFrame) -> DataFrame:
    """What became of each file of a batch.

    consumed; containedIn (a holder that is itself consumed, with evidence where the column exists), else
    no-evidence or holder-not-consumed; excluded (for a reason), else no-reason; ORPHAN: nobody says.
    """
    used = consumed.select("file", F.lit(True).alias("used")).distinct()
    holder = used.select(F.col("file").alias("holder"), F.col("used").alias("holder_used"))
    rows = files.join(used, "file", "left").join(holder, "holder", "left").join(excluded.select("file", "reason", F.lit(True).alias("declared")).distinct(), "file", "left")
    evident = F.trim(F.coalesce("evidence", F.lit(""))) != "" if "evidence" in files.columns else F.lit(True)
    status = F.when(F.col("used"), "consumed").when(F.col("holder_used"), F.when(evident, "containedIn").otherwise("no-evidence"))
    status = status.when(F.col("declared"), F.when(F.trim(F.coalesce("reason", F.lit(""))) != "", "excluded").otherwise("no-reason"))
    status = status.when(F.col("holder").isNotNull() & F.lit("evidence" in files.columns), "holder-not-consumed").otherwise("ORPHAN")
    return rows.withColumn("status", status).drop("used", "holder_used", "declared")


def adjudicated_drift(rows: DataFrame, upstream: DataFrame, decisions: DataFrame) -> DataFrame:
    """Vendored rows against upstream: in-sync, UPSTREAM_MOVED, adjudicated (for exactly the present hash), UPSTREAM_GONE.

    A row without a path is a consumer without provenance: PROVENANCE_MISSING; one with a path and no digest names a
    provenance from which nothing could be read: NO_ROWS.
    """
    now = upstream.select("path", F.col("digest").alias("current"))
    known = decisions.select("path", F.col("digest").alias("current"), F.lit(True).alias("decided")).distinct()
    joined = rows.join(now, "path", "left").join(known, ["path", "current"], "left")
    status = F.when(F.col("path").isNull(), "PROVENANCE_MISSING").when(F.col("digest").isNull(), "NO_ROWS")
    status = status.when(F.col("current").isNull(), "UPSTREAM_GONE").when(F.col("digest") == F.col("current"), "in-sync").when(F.col("decided"), "adjudicated").otherwise("UPSTREAM_MOVED")
    return joined.withColumn("status", status).drop("decided")


def artifact_reconcile(baseline: DataFrame, again: DataFrame, keys: list[str]) -> DataFrame:
    """same, different or absentInRepro for each artifact of the baseline."""
    other = again.select(*keys, F.col("digest").alias("other"))
    status = F.when(F.col("other").isNull(), "absentInRepro").when(F.col("digest") == F.col("other"), "same").otherwise("different")
    return baseline.join(other, keys, "left").withColumn("status", status).drop("other")


OPEN, CLOSE = "\u0001", "\u0002"


def combined_answers(answers: DataFrame, text: str = "text") -> DataFrame:
    """Parts of answers that several questions share: split before each number, decimals apart."""
    parts = F.split(F.regexp_replace(F.col(text), r"(^|[^0-9.])([0-9]{1,3})(?:[.．](?![0-9])|、)", f"$1{OPEN}$2{CLOSE}"), OPEN)
    numbered = F.transform(F.filter(parts, lambda p: F.contains(p, F.lit(CLOSE))), lambda p: F.struct(F.substring_index(p, CLOSE, 1).cast("int").alias("number"), F.trim(F.substring_index(p, CLOSE, -1)).alias("part")))
    return answers.withColumn("item", F.explode(numbered)).select(*answers.columns, "item.number", "item.part")


def sub_answers(answers: DataFrame, text: str = "text", least: int = 2) -> DataFrame:
    """Parts by "(n)" marks, when there are enough; an empty part shares the next one that is not."""
    pieces = F.filter(F.split(F.regexp_replace(F.col(text), r"[（(]\s*([0-9]{1,2})\s*[)）]", f"{OPEN}$1{CLOSE}"), OPEN), lambda p: F.contains(p, F.lit(CLOSE)))
    rows = answers.withColumn("pieces", pieces).where(F.size("pieces") >= least).select(*answers.columns, F.posexplode("pieces").alias("pos", "piece"))
    rows = rows.select(*answers.columns, "pos", F.substring_index("piece", CLOSE, 1).alias("label"), F.trim(F.substring_index("piece", CLOSE, -1)).alias("body"))
    keys = [c for c in answers.columns if c != text]
    later = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    own = F.when(F.col("body") != "", F.col("body"))
    return rows.withColumn("shared_body", F.first(own, ignorenulls=True).over(later)).withColumn("answer_shared", F.col("body") == "").drop(text)


# Statuses of the text ladder, first that holds.
def reconcile_text(source: DataFrame, output: DataFrame, keys: list[str], excluded: DataFrame) -> DataFrame:
    """source text against output text by key: a status for every source block.

    blank, ok, declared (left out on purpose), transcription (the output is longer and holds it), TEXT_PARTIAL
    (the output is inside it), letters_only (all its letters occur), TEXT_MISSING, TEXT_CHANGED.
    """
    rows = source.select(*keys, F.col("text").alias("wanted")).join(output.select(*keys, F.col("text").alias("got")), keys, "left")
    rows = rows.join(excluded.select(*keys).distinct().withColumn("declared", F.lit(True)), keys, "left")
    w, g = F.regexp_replace("wanted", r"\s+", ""), F.regexp_replace(F.coalesce("got", F.lit("")), r"\s+", "")
    status = (
        F.when(w == "", "blank")
        .when(w == g, "ok")
        .when(F.col("declared"), "declared")
        .when(F.col("got").isNull(), "TEXT_MISSING")
        .when(F.contains(g, w), "transcription")
        .when((g != "") & F.contains(w, g), "TEXT_PARTIAL")
        .when(F.forall(F.split(w, ""), lambda c: F.contains(g, c)), "letters_only")
        .otherwise("TEXT_CHANGED")
    )
    return rows.withColumn("status", status)


def text_override(blocks: DataFrame, overrides: DataFrame) -> DataFrame:
    """Blocks whose whole text has an override get it."""
    small = overrides.select(F.col("old").alias("text"), "new")
    return blocks.join(small, "text", "left").withColumn("final_text", F.coalesce("new", "text"))


def unmapped(blocks: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Keys in use that the mapping does not know, with their numbers."""
    return blocks.join(mapping.select(key), key, "left_anti").groupBy(key).agg(F.count("*").alias("n_blocks"))


def layout_missing(blocks: DataFrame, layout: DataFrame, keys: list[str]) -> DataFrame:
    return blocks.join(layout, keys, "left_anti")
