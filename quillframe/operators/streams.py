"""Streams of runs and figures inside blocks: merging by offset, arrows into gaps, transcriptions, slices of sources."""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_GAP = re.compile(r"(?<=\S)[\s　]{2,}(?=\S)")


def gaps_taken(text: str, n: int) -> list[tuple[int, int]]:
    """The ``n`` widest gaps between words (earlier ones on ties), from left to right."""
    found = sorted((m.span() for m in _GAP.finditer(text)), key=lambda s: s[0] - s[1])
    return sorted(found[: max(0, n)])


def edits(text: str, signs: list[str], limit: int) -> list[tuple[int, int, str]]:
    """Where signs go: (start, end, sign) of the widest gaps, ``limit`` at most."""
    return [(*span, sign) for span, sign in zip(gaps_taken(text, min(limit, len(signs))), signs)]


def filled(text: str, signs: list[str], limit: int) -> tuple[str, int]:
    """``text`` with signs in its widest gaps, ``limit`` at most; and how many found one."""
    made = edits(text, signs, limit)
    return replayed([{"text": text}], made)[0]["text"], len(made)


def place_arrows(blocks: DataFrame, carry: int = 2) -> DataFrame:
    """Arrows (an array per block) put into the gaps of their line or, unplaced, of at most ``carry`` later ones.

    A line takes as many as one place anchored at most. ``unplaced`` names the arrows given up at a block.
    The queue is short and lives within one document, whose lines are streamed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: deque[tuple[str, int, int]] = deque()  # sign, where it was drawn, lines waited
        key: object = waiting  # no document yet
        for batch in batches:
            out = []
            for document, ordinal, text, arrows in zip(*(c.to_pylist() for c in batch.columns)):
                if document != key:
                    key = document
                    waiting.clear()
                waiting.extend((a, ordinal, 0) for a in arrows or [])
                limit = max(Counter(w for _, w, _ in waiting).values(), default=0)
                text, n = filled(text or "", [a for a, _, _ in waiting], limit)
                for _ in range(n):
                    waiting.popleft()
                given_up = [a for a, _, age in waiting if age + 1 > carry]
                waiting = deque((a, w, age + 1) for a, w, age in waiting if age + 1 <= carry)
                out.append((document, ordinal, text, n, given_up))
            types = [batch.schema.types[0], batch.schema.types[1], pa.string(), pa.int32(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=["document", "ordinal", "text", "n_placed", "unplaced"])

    rows = blocks.select("document", "ordinal", "text", "arrows").repartition("document").sortWithinPartitions("document", "ordinal")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"document {kinds['document']}, ordinal {kinds['ordinal']}, text string, n_placed int, unplaced array<string>")


def shape_arrows(figures: DataFrame, render: str = "——{condition}→", plain: str = "——→") -> DataFrame:
    """Arrows that are drawn shapes, by block in drawing order, as text: with the shape's own words as condition.

    figures: document, ordinal, figure_no, shape, condition; only shapes named arrow count.
    """
    words = F.trim(F.coalesce("condition", F.lit("")))
    return _by_block(figures.where("shape = 'arrow'"), words, "figure_no", render, plain)


def picture_arrows(figures: DataFrame, registered: DataFrame, render: str = "——{condition}→", plain: str = "——→") -> tuple[DataFrame, DataFrame]:
    """Arrows that are small pictures, registered by content hash, from left to right; and the figures, those marked transcribed.

    figures: document, ordinal, figure_no, media_id, anchor_x (null for inline ones, which stand where they are) and
    kind. registered: media_id, condition.
    """
    known = figures.join(registered.select("media_id", "condition", F.lit(True).alias("__known")), "media_id", "left")
    taken = F.coalesce("__known", F.lit(False)) & F.col("anchor_x").isNotNull() & (F.coalesce("kind", F.lit("")) != "transcribed")
    arrows = _by_block(known.where(taken), F.trim(F.coalesce("condition", F.lit(""))), "anchor_x", render, plain)
    marked = known.withColumns({"kind": F.when(taken, "transcribed").otherwise(F.col("kind")), "text": F.when(taken, F.coalesce("condition", F.lit("")))})
    return arrows, marked.drop("__known", "condition")


def _by_block(rows: DataFrame, words: Column, order: str, render: str, plain: str) -> DataFrame:
    sign = F.when(words != "", F.replace(F.lit(render), F.lit("{condition}"), words)).otherwise(F.lit(plain))
    each = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), "figure_no", sign.alias("sign"))))
    return rows.groupBy("document", "ordinal").agg(F.transform(each, lambda r: r["sign"]).alias("arrows"))


def replayed(runs: list[dict], edits: list[tuple[int, int, str]]) -> list[dict]:
    """Runs with the edits (start, end, sign) that their joined text got: each sign goes to the run its place begins in.

    A place that spans several runs takes its characters from all of them.
    """
    out, begin = [], 0
    for run in runs:
        text, end = run["text"], begin + len(run["text"])
        kept, at = [], begin
        for start, stop, sign in edits:
            if stop <= begin or start >= end:
                continue
            kept.append(text[at - begin : max(start, at) - begin])
            if begin <= start:
                kept.append(sign)
            at = min(stop, end)
        kept.append(text[at - begin :])
        out.append({**run, "text": "".join(kept)})
        begin = end
    return out


def merged(runs: DataFrame, figures: DataFrame) -> DataFrame:
    """Runs (document, block, pos, text) and figures (document, block, figure, offset) in one order by character.

    A run with figures inside is cut there; a figure stands before the text that begins at its offset.
    Gives document, block, begin, kind, text, figure, and pos of the run.
    """
    keys = ["document", "block"]
    upto = F.sum(F.length("text")).over(Window.partitionBy(*keys).orderBy("pos"))
    placed = runs.withColumn("stop", upto).withColumn("begin", F.col("stop") - F.length("text"))
    cuts = figures.where("offset IS NOT NULL").groupBy(*keys).agg(F.array_distinct(F.collect_list(F.greatest("offset", F.lit(0)))).alias("cuts"))
    rows = placed.join(cuts, keys, "left")
    inner = F.filter(F.coalesce("cuts", F.array().cast("array<int>")), lambda c: (c > F.col("begin")) & (c < F.col("stop")))
    starts = F.array_sort(F.concat(F.array(F.col("begin").cast("int")), F.transform(inner, lambda c: c.cast("int"))))
    rows = rows.withColumn("starts", starts).select(*keys, "pos", "text", "begin", "stop", "starts", F.posexplode("starts").alias("k", "at"))
    end = F.coalesce(F.get("starts", F.col("k") + 1), F.col("stop").cast("int"))
    words = rows.select(*keys, F.col("at").cast("long").alias("begin"), F.lit("text").alias("kind"), F.substring("text", (F.col("at") - F.col("begin") + 1).cast("int"), (end - F.col("at")).cast("int")).alias("text"), F.lit(None).cast("string").alias("figure"), "pos")
    pictures = figures.where("offset IS NOT NULL").select(*keys, F.greatest("offset", F.lit(0)).cast("long").alias("begin"), F.lit("figure").alias("kind"), F.lit(None).cast("string").alias("text"), "figure", F.lit(None).cast("int").alias("pos"))
    return words.unionByName(pictures)


def transcribed(blocks: DataFrame, references: DataFrame, registered: DataFrame) -> DataFrame:
    """Blocks with registered texts of embedded objects put in at their offsets.

    references: document, ordinal, media_id, offset; registered: media_id, text. Later offsets first, so that
    earlier ones stay right.
    """
    known = references.join(registered.select("media_id", F.col("text").alias("insert")), "media_id")
    each = known.groupBy("document", "ordinal").agg(F.sort_array(F.collect_list(F.struct("offset", "insert")), asc=False).alias("inserts"))
    put = F.aggregate("inserts", F.col("text"), lambda t, i: F.concat(F.substring(t, F.lit(1), i["offset"]), i["insert"], F.substring(t, i["offset"] + 1, F.length(t))))
    return blocks.join(each, ["document", "ordinal"], "left").withColumn("text", F.when(F.col("inserts").isNotNull(), put).otherwise(F.col("text"))).drop("inserts")


def rendered(figures: DataFrame, substitutes: DataFrame) -> DataFrame:
    """Figures whose metafile has a registered raster point to that."""
    return figures.join(substitutes.select("media_id", "raster_id"), "media_id", "left").withColumn("shown_id", F.coalesce("raster_id", "media_id")).drop("raster_id")


def image_banners(figures: DataFrame, registered: DataFrame) -> DataFrame:
    """The first registered picture of each block (by its shortened hash) as a banner's label and caption."""
    known = figures.withColumn("banner_id", F.substring("media_id", 1, 12)).join(registered, "banner_id")
    return known.groupBy("document", "ordinal").agg(F.min_by(F.struct("label", "caption"), "figure_no").alias("banner")).select("document", "ordinal", "banner.*")


def banner_paragraphs(blocks: DataFrame, boxes: DataFrame, declared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks that host a text box with a declared banner get its text; and boxes whose text nobody declared."""
    marked = boxes.withColumn("text", F.trim("text")).join(declared.select(F.col("banner").alias("text"), F.lit(True).alias("known")).distinct(), "text", "left")
    banner = marked.where("known").groupBy("document", "ordinal").agg(F.min(F.struct("box", "text")).alias("b")).select("document", "ordinal", F.col("b.text").alias("banner"))
    out = blocks.join(banner, ["document", "ordinal"], "left").withColumn("text", F.coalesce("banner", "text")).withColumn("is_banner", F.col("banner").isNotNull()).drop("banner")
    return out, marked.where("known IS NULL AND text <> ''").drop("known")


#: Blocks of a source that are compared with the spans among them, on average.
SLICE = 256


def sliced(blocks: DataFrame, spans: DataFrame) -> DataFrame:
    """Blocks of a source with the document whose span [start, end) holds their ordinal.

    A source is cut into stretches of about SLICE blocks, and a span into one row per stretch that it touches, as far
    as its source has blocks. So few blocks and spans are compared, however few and long the sources are.
    """
    width = F.greatest(F.lit(1), F.ceil((F.max("ordinal") - F.min("ordinal") + 1) / F.count("*") * SLICE)).cast("long")
    sizes = blocks.groupBy("source_id").agg(F.min("ordinal").alias("__low"), F.max("ordinal").alias("__high"), width.alias("__width"))
    place = lambda c: F.floor((c - F.col("__low")) / F.col("__width")).cast("long")
    cut = blocks.join(sizes, "source_id").withColumn("__stretch", place(F.col("ordinal")))
    some = spans.join(sizes, "source_id").where("start < end AND start <= __high AND end > __low")
    first, last = place(F.greatest("start", "__low")), place(F.least(F.col("end") - 1, F.col("__high")))
    each = some.select("source_id", "start", "end", "document", F.explode(F.sequence(first, last)).alias("__stretch"))
    inside = (cut["source_id"] == each["source_id"]) & (cut["__stretch"] == each["__stretch"]) & (cut["ordinal"] >= each["start"]) & (cut["ordinal"] < each["end"])
    return cut.join(each, inside).select(*(cut[c] for c in blocks.columns), each["document"])


def figure_catalogue(figures: DataFrame) -> DataFrame:
    """Each picture once, with its first place and its size in centimetres."""
    first = F.min(F.struct("document", "ordinal", "figure_no", "cx_emu", "cy_emu")).alias("f")
    size = F.format_string("%.1fx%.1f", F.col("f.cx_emu") / 360000, F.col("f.cy_emu") / 360000)
    return figures.groupBy("media_id").agg(first, F.count("*").alias("n_uses")).select("media_id", "f.document", "f.ordinal", size.alias("display_cm"), "n_uses")
