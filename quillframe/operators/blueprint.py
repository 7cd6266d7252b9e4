"""From content to an output plan: claims, dispositions, segments, figures, tables, option rows, reactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.functions import text as T


def object_index(objects: DataFrame) -> DataFrame:
    """(source, locator) to object over the canonical and the serialised locators; the first one wins."""
    each = objects.select("source", "object", "ordinal", F.posexplode(F.concat(F.array("locator"), F.coalesce("locators", F.array().cast("array<string>")))).alias("pos", "at"))
    return each.groupBy("source", F.col("at").alias("locator")).agg(F.min_by("object", F.struct("ordinal", "pos")).alias("object"))


def claims(wanted: DataFrame, objects: DataFrame) -> DataFrame:
    """Each object's owner: the first claim by precedence and order. A claim on a missing object is unbound."""
    first = wanted.groupBy("source", "object").agg(F.min_by("block", F.struct("precedence", "ordinal", "block")).alias("owner"))
    rows = wanted.join(first, ["source", "object"]).join(objects.select("source", "object", F.lit(True).alias("there")).distinct(), ["source", "object"], "left")
    return rows.withColumn("status", F.when(F.col("there").isNull(), "unbound").when(F.col("owner") == F.col("block"), "owned").otherwise("ignored")).drop("there")


def dispositions(rows: DataFrame) -> DataFrame:
    """What becomes of each source object: block, carrier (a shape with text box or image), exclusion of a class."""
    disposition = F.when(F.col("printed"), "block").when(F.col("is_shape") & (F.col("has_box") | F.col("has_image")), "carrier").otherwise("exclusion")
    reason = F.when(F.col("is_shape"), "artwork").when(F.trim("text") == "", "spacer").otherwise("carrier")
    return rows.withColumn("disposition", disposition).withColumn("exclusion_class", F.when(F.col("disposition") == "exclusion", reason))


def provenance(digest: Column, locator: Column) -> Column:
    return F.struct(digest.alias("source_sha256"), locator.alias("locator"))


def figure_width(emu: Column, body_pt: Column, block_pt: Column, document_pt: Column) -> Column:
    """Millimetres in the output: scaled by the output's and the source's font size; the latter falls back."""
    return F.round(emu / 36000 * body_pt / F.coalesce(block_pt, document_pt, F.lit(12)), 2)


def sweep_boxes(boxes: DataFrame, claimed: DataFrame, printed: DataFrame) -> DataFrame:
    """Unclaimed text-box paragraphs: a block, or an exclusion where the document prints that text already."""
    free = boxes.join(claimed, ["source", "locator"], "left_anti")
    there = printed.select("document", F.trim("text").alias("t")).distinct().withColumn("seen", F.lit(True))
    rows = free.withColumn("t", F.trim("text")).join(there, ["document", "t"], "left")
    return rows.withColumn("disposition", F.when(F.col("seen"), "exclusion").otherwise("block")).drop("seen", "t")


def segments(streams: DataFrame, figures: DataFrame) -> DataFrame:
    """Pieces of streams (document, block, pos, kind, text, file) with figures bound by file and occurrence; rest at the end."""
    nth = F.row_number().over(Window.partitionBy("document", "block", "file").orderBy("pos"))
    pictures = streams.where("kind = 'picture'").withColumn("nth", nth)
    given = figures.withColumn("nth", F.row_number().over(Window.partitionBy("document", "block", "file").orderBy("figure")))
    keys = ["document", "block", "file", "nth"]
    bound = pictures.join(given.select(*keys, "figure"), keys, "left").select("document", "block", "pos", "kind", "text", "figure")
    rest = given.join(pictures.select(*keys), keys, "left_anti").select("document", "block", F.lit(2**30).alias("pos"), F.lit("picture").alias("kind"), F.lit("").alias("text"), "figure")
    words = streams.where("kind <> 'picture'").select("document", "block", "pos", "kind", "text", F.lit(None).cast("string").alias("figure"))
    return words.unionByName(bound).unionByName(rest)


def figure_dispositions(figures: DataFrame) -> DataFrame:
    """transcribed, shape, dropped or kept, each with its running number in the document."""
    kind = F.when(F.col("transcribed"), "transcribed").when(F.col("shape") != "picture", "shape").when(~F.col("keep"), "dropped").otherwise("kept")
    rows = figures.withColumn("disposition", kind)
    return rows.withColumn("running", F.row_number().over(Window.partitionBy("document", "disposition").orderBy("ordinal")))


def titles(blocks: DataFrame) -> DataFrame:
    """The first title of each document, with where it stands."""
    found = blocks.where("kind = 'title'").groupBy("document").agg(F.min(F.struct("ordinal", "locator", "text")).alias("t"))
    return found.select("document", F.col("t.text").alias("title"), F.struct("t.ordinal", "t.locator").alias("evidence"))


def theme_chapters(documents: DataFrame) -> DataFrame:
    """The document at which each theme of a volume first comes, once per theme, with the levels of its path."""
    first = documents.groupBy("volume", "theme").agg(F.min("ordinal").alias("ordinal"))
    return first.where("theme IS NOT NULL").withColumn("levels", F.split("theme", "/"))


def callout(paragraphs: DataFrame) -> DataFrame:
    """A callout's first paragraph is its title, the others its body."""
    return paragraphs.withColumn("part", F.when(F.row_number().over(Window.partitionBy("document", "callout").orderBy("ordinal")) == 1, "title").otherwise("body"))


def heading_slots(text: Column, separator: str = " ") -> Column:
    """Label and caption of a heading."""
    return F.struct(F.substring_index(text, separator, 1).alias("label"), F.trim(F.substring(text, F.length(F.substring_index(text, separator, 1)) + 1, F.length(text))).alias("caption"))


def own_edges(cells: DataFrame) -> DataFrame:
    """Edges (a map) that differ from the most frequent ones of their table; diagonals always stay."""
    each = cells.select("table", "cell", F.explode("edges").alias("edge", "value"))
    usual = each.groupBy("table", "edge", "value").agg(F.count("*").alias("n")).groupBy("table", "edge").agg(F.max_by("value", F.struct("n", "value")).alias("usual"))
    return each.join(usual, ["table", "edge"]).where("value <> usual OR edge IN ('tl2br', 'tr2bl')").select("table", "cell", "edge", "value")


def row_height(height: Column, body_pt: Column, source_pt: Column, rule: Column) -> Column:
    """Scaled row height; an automatic one has none."""
    return F.when(F.coalesce(rule, F.lit("auto")) != "auto", F.round(height * body_pt / source_pt, 2))


def option_rows(options: DataFrame, columns: str = "columns") -> DataFrame:
    """Options (document, question, ordinal, text, source_row) laid out anew in rows, with the source rows of each."""
    place = F.row_number().over(Window.partitionBy("document", "question").orderBy("ordinal")) - 1
    rows = options.withColumn("row_no", F.floor(place / F.col(columns)))
    whole = F.sort_array(F.collect_list(F.struct("ordinal", "text")))
    return rows.groupBy("document", "question", "row_no").agg(F.transform(whole, lambda r: r["text"]).alias("cells"), F.sort_array(F.collect_set("source_row")).alias("source_rows"))


def reactions(lines: DataFrame, adjudicated: DataFrame, boundaries: DataFrame | None = None) -> DataFrame:
    """Reactions in lines: dashed arrows always, bare ones only between joined terms; kind by the numbers of terms.

    boundaries: document, ordinal, begin and end (characters) of lines whose reaction is only a part of them.
    """
    if boundaries is not None:
        held = lines.join(boundaries.select("document", "ordinal", "begin", "end"), ["document", "ordinal"], "left")
        part = F.substring("text", F.col("begin") + 1, F.col("end") - F.col("begin"))
        lines = held.withColumn("text", F.when(F.col("begin").isNotNull(), part).otherwise(F.col("text"))).drop("begin", "end")
    arrow = F.regexp_extract("text", f"({T.ARROW})", 1)
    sides = F.split(F.regexp_replace("text", T.ARROW, "\u0001"), "\u0001")
    rows = lines.withColumn("arrow", arrow).where("arrow <> ''").withColumn("sides", sides).where("size(sides) = 2")
    rows = rows.withColumn("reactants", T.terms(F.get("sides", F.lit(0)))).withColumn("products", T.terms(F.get("sides", F.lit(1))))
    joined = F.contains("text", F.lit("+"))
    rows = rows.withColumn("status", F.when((F.length("arrow") > 1) | joined, "reaction").otherwise("skipped"))
    many, more = F.size("reactants"), F.size("products")
    kind = F.when((many > 1) & (more == 1), "combination").when((many == 1) & (more > 1), "decomposition").otherwise("neither")
    rows = rows.join(adjudicated.select("document", "ordinal", F.col("kind").alias("decided")), ["document", "ordinal"], "left")
    number = F.row_number().over(Window.partitionBy("document", "status").orderBy("ordinal"))
    return rows.withColumn("kind", F.coalesce("decided", kind)).withColumn("basis", F.when(F.col("decided").isNotNull(), "adjudicated").otherwise("counts")).withColumn("reaction", F.when(F.col("status") == "reaction", number)).drop("sides", "decided")


def table_blocks(cells: DataFrame, figures: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables as one block each, rows of cells; and the images of tables that no cell claims, as exclusions.

    cells: document, table, row_no, column_no, grid_span, v_merge, v_align, paragraphs (array). A blank cell has one
    empty segment; without an alignment it is at the top; several paragraphs stay apart. figures: document, table,
    row_no, column_no, figure_no, file, kind: pictures with a file become segments of their cell, others are carried.
    listed: document, table, image_no: the images of each table.
    """
    keys = ["document", "table", "row_no", "column_no"]
    pictured = F.coalesce((F.col("kind") == "picture") & F.col("file").isNotNull(), F.lit(False))
    number = F.sum(pictured.cast("long")).over(Window.partitionBy("document", "table").orderBy("row_no", "column_no", "figure_no").rowsBetween(Window.unboundedPreceding, 0))
    drawn = figures.withColumns({"image_no": F.when(pictured, number)})
    inside = drawn.where("image_no IS NOT NULL").groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("figure_no", "file"))), lambda f: f["file"]).alias("files"))
    words = F.filter(F.coalesce("paragraphs", F.array().cast("array<string>")), lambda p: p != "")
    segments = F.concat(words, F.coalesce("files", F.array().cast("array<string>")))
    cell = F.struct(
        "column_no",
        F.when(F.size(segments) == 0, F.array(F.lit(""))).otherwise(segments).alias("segments"),
        F.when(F.size(words) > 1, words).alias("paragraphs"),
        F.coalesce("grid_span", F.lit(1)).alias("grid_span"),
        F.col("v_merge").alias("v_merge"),
        F.coalesce("v_align", F.lit("top")).alias("v_align"),
    )
    rows = cells.join(inside, keys, "left").groupBy("document", "table", "row_no").agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    tables = rows.groupBy("document", "table").agg(F.sort_array(F.collect_list(F.struct("row_no", "cells"))).alias("rows"))
    claimed = drawn.where("image_no IS NOT NULL").select("document", "table", "image_no")
    left = listed.join(claimed, ["document", "table", "image_no"], "left_anti").withColumn("disposition", F.lit("exclude"))
    return tables, left


def sweep_shapes(shapes: DataFrame, claimed: DataFrame) -> DataFrame:
    """The shapes of a block (source, locator, shape_no, has_box) that nothing claims yet: each is carried, with its reason."""
    rows = shapes.join(claimed.select("source", "locator", "shape_no"), ["source", "locator", "shape_no"], "left_anti")
    return rows.withColumns({"disposition": F.lit("carry"), "reason": F.when(F.col("has_box"), "text box").otherwise("artwork")})


def transferred(done: DataFrame, claims_: DataFrame) -> DataFrame:
    """Claims of replaced assets go to the block that prints the replacement, each object once; with how many blocks used it.

    done: document, block, media_id, replacement; claims_: document, media_id, object, owner.
    """
    used = done.where("replacement IS NOT NULL").groupBy("document", "media_id").agg(F.min("block").alias("__to"), F.countDistinct("block").alias("n_blocks"))
    return claims_.join(used, ["document", "media_id"], "left").withColumns({"owner": F.coalesce("__to", "owner"), "n_blocks": F.coalesce("n_blocks", F.lit(0))}).drop("__to").dropDuplicates(["document", "object"])


def substitutions(segments_: DataFrame, registered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments with registered assets replaced by content, and registered assets that nothing used."""
    known = registered.select("media_id", "replacement")
    done = segments_.join(known, "media_id", "left").withColumn("final", F.coalesce("replacement", "text"))
    return done, known.join(segments_, "media_id", "left_anti")


def unbound(blocks: DataFrame, mapping: DataFrame) -> DataFrame:
    """Roles that the plan skips, with their numbers and the first place."""
    return blocks.join(mapping, "role", "left_anti").groupBy("role").agg(F.count("*").alias("n"), F.min("locator").alias("first_locator"))
