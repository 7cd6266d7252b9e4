"""From classified blocks to the relational tables: tree, questions, options, units, spans, blanks.

One pass places every block: section, subsection and node above it, the question it belongs to, whether a
tag has opened there. All windows are by document, so they share one exchange. Everything else follows from a
placed block alone, or from one aggregation by question.

Blocks: document, ordinal, locator, kind, role, text (normalised) and raw_text (as it stands).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.functions import udfs
from quillframe.functions.dialect import SPACES
from quillframe.operators import attribution, joins, sequence

LEVELS = {"section-banner": "section", "sub-module": "subsection", "section": "node", "header": "header"}


@dataclass(frozen=True)
class Marks:
    """What a block is inside a question, as conditions on it."""

    option_row: Column
    sub_question: Column
    opens_tag: Column


def placed(blocks: DataFrame, marks: Marks) -> DataFrame:
    """Blocks with section, subsection, node, question, unit (of the question), and part.

    part: stem, option, sub_question or body inside a question, header, else a level of the tree or content. After a
    block that opens a tag the question's further rows of options are explanations, so they are body.
    """
    rows = sequence.section_carry(blocks.withColumns({"__option": marks.option_row, "__sub": marks.sub_question, "__tag": marks.opens_tag}))
    header = F.col("kind") == "header"
    event = F.when(F.col("kind") == "stem", "stem").when(F.col("kind").isin(*sequence.CLOSERS), "close")
    number = F.sum((F.col("kind") == "stem").cast("long")).over(sequence.so_far("document"))
    rows = rows.withColumn("question", F.when(~header & (sequence.carried(event, "document") == "stem"), number))
    asked, stem = F.col("question").isNotNull(), F.col("kind") == "stem"
    # A question is one stretch that begins with its stem, so that the last tag and stem in the document's order tell.
    after_tag = F.coalesce(sequence.carried(F.when(asked & F.col("__tag") & ~stem, F.col("question")), "document") == F.col("question"), F.lit(False))
    place = sequence.carried(F.when(stem, F.concat_ws("/", F.col("document").cast("string"), "locator")), "document")
    part = F.when(asked & stem, "stem").when(asked & F.col("__option") & ~after_tag, "option").when(asked & F.col("__sub"), "sub_question").when(asked, "body")
    for kind, level in LEVELS.items():
        part = part.when(F.col("kind") == kind, level)
    return rows.withColumns({"unit": F.when(asked, place), "part": part.otherwise("content")}).drop("__option", "__sub", "__tag", "section_run")


def tree(rows: DataFrame) -> DataFrame:
    """Nodes outside questions in the order of the output: headers come first. A heading's label is its beginning."""
    nodes = rows.where(F.col("question").isNull())
    front = F.row_number().over(Window.partitionBy("document").orderBy(F.col("part") != "header", "ordinal"))
    label = F.when(F.col("part").isin("node", "header"), F.substring("text", 1, 30)).when(F.col("part") != "content", F.col("text"))
    return nodes.select("document", front.cast("long").alias("place"), F.col("part").alias("level"), "section", "subsection", "node", "role", label.alias("label"), "locator", "text")


def options(rows: DataFrame, chars: str = "ABCDEFGH") -> DataFrame:
    """The options of each question in order, with option_no, and group_no: a new group at every return to an earlier label."""
    each = rows.where("part = 'option'").select("document", "question", "unit", "ordinal", "locator", F.inline(udfs.split_options(chars)(F.col("text"))))
    order = Window.partitionBy("document", "question").orderBy("ordinal", "start")
    back = F.coalesce(F.col("label") <= F.lag("label").over(order), F.lit(False)).cast("long")
    return each.withColumns({"option_no": F.row_number().over(order).cast("long"), "back": back}).withColumn("group_no", F.sum("back").over(order)).drop("back")


def sub_questions(rows: DataFrame) -> DataFrame:
    """The parts of each question by their printed number, "?" without one."""
    label = F.regexp_extract("text", f"^[（(][{SPACES}]*([0-9]+)[{SPACES}]*[)）]", 1)
    number = F.row_number().over(sequence.over("document", "question")).cast("long")
    return rows.where("part = 'sub_question'").select("document", "question", "unit", "ordinal", "locator", number.alias("sub_no"), F.when(label != "", F.concat(F.lit("("), label, F.lit(")"))).otherwise("?").alias("label"), "text")


def _ordered(value: Column, name: str, *order: str) -> Column:
    """An aggregate: ``value`` of all rows in order."""
    return F.transform(F.sort_array(F.collect_list(F.struct(*order, value.alias("v")))), lambda r: r["v"]).alias(name)


def questions(rows: DataFrame, found: DataFrame, full: str = "ABCD") -> DataFrame:
    """One row per question: place, stem, joined text and its id, groups of option labels, whether all are complete, and gaps."""
    stem = lambda c: F.max(F.when(F.col("part") == "stem", F.col(c))).alias(c)
    whole = rows.where(F.col("question").isNotNull()).groupBy("document", "question", "unit").agg(*(stem(c) for c in ("section", "subsection", "node", "role", "locator")), F.max(F.when(F.col("part") == "stem", F.col("text"))).alias("stem"), F.count("*").alias("n_blocks"), F.array_join(_ordered(F.col("text"), "t", "ordinal"), "").alias("joined"))
    groups = found.groupBy("document", "question", "group_no").agg(F.array_join(_ordered(F.col("label"), "l", "option_no"), "").alias("labels")).groupBy("document", "question").agg(_ordered(F.col("labels"), "option_groups", "group_no"))
    out = whole.join(groups, ["document", "question"], "left").withColumn("option_groups", F.coalesce("option_groups", F.array().cast("array<string>")))
    gaps = F.filter("option_groups", lambda g: g != F.substring(F.lit(full), F.lit(1), F.length(g)))
    complete = (F.size("option_groups") > 0) & F.forall("option_groups", lambda g: g == full)
    return out.withColumns({"complete": complete, "option_gaps": gaps, "atom_id": F.substring(F.sha2("joined", 256), 1, 16)})


def unclaimed(rows: DataFrame) -> DataFrame:
    """Blocks with visible text outside all questions: headings, if a heading of their document is in their text, else prose."""
    heading = F.when(F.col("part").isin("section", "subsection"), F.col("text")).when(F.col("part") == "node", F.substring("text", 1, 30))
    visible = F.col("raw_text").rlike(f"[^{SPACES}]")
    return joins.unclaimed(rows, F.col("question").isNotNull() | ~F.coalesce(visible, F.lit(False)), heading, carry=("locator", "raw_text"))


def units(rows: DataFrame, asked: DataFrame, found: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """unit, parent, kind, ordinal, path, max_choices and text of all units.

    Questions in order from 0 in each document, their options, sub-questions and answers below them; and what nobody
    claims. One group of options means one choice; several belong to parts, so that nothing is said of the question.
    answers: document, question and, each where there is one, answer and explanation.
    """
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None)
    row = lambda unit, parent, kind, ordinal, path, choices, words: [unit.alias("unit"), parent.cast("string").alias("parent"), F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"), ordinal.cast("long").alias("ordinal"), path.cast("string").alias("path"), choices.cast("int").alias("max_choices"), words.alias("text")]
    path = F.concat_ws(" / ", *(F.when(F.col(c) != "", F.col(c)) for c in ("section", "subsection", "node")))
    number = F.row_number().over(Window.partitionBy("document").orderBy("question")) - 1
    parts = [
        asked.select(*row(F.col("unit"), none, "question", number, path, F.when(F.size("option_groups") == 1, 1), F.col("joined"))),
        found.select(*row(F.concat("unit", F.lit("#opt"), text("option_no")), F.col("unit"), "option", F.col("option_no"), none, none, F.col("text"))),
        sub_questions(rows).select(*row(F.concat("unit", F.lit("#sub"), text("sub_no")), F.col("unit"), "sub_question", F.col("sub_no"), none, none, F.col("text"))),
        unclaimed(rows).select(*row(F.concat(text("document"), F.lit("/"), "locator", F.lit("#unclaimed")), none, F.col("unit_kind"), F.lit(0), text("document"), none, F.col("raw_text"))),
    ]
    if answers is not None:
        given = asked.select("document", "question", "unit").join(answers, ["document", "question"])
        for field in ("answer", "explanation"):
            if field in answers.columns:
                parts.append(given.where(F.col(field).isNotNull()).select(*row(F.concat("unit", F.lit(f"#{field}")), F.col("unit"), field, F.lit(0), none, none, F.col(field))))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _block(*columns: str) -> Column:
    return F.concat_ws("/", *(F.col(c).cast("string") for c in columns)).alias("block")


def stream(rows: DataFrame, marks: str = "[A-H][.．、:：]") -> DataFrame:
    """Spans and block ends of all placed blocks, ready to be filled; visible tells blocks that must be claimed.

    A question's block is one span of its part; a row of options is cut at its markers, in the text as it stands, and
    what stands before the first is the question's too. Unclaimed blocks are a span of their own unit.
    """
    size, end = F.length("raw_text"), attribution.block_end(F.length("raw_text"))
    cuts = F.concat(F.array(F.lit("")), F.filter(F.split("raw_text", f"(?={marks})"), lambda x: x != ""))
    stops = F.transform(cuts, lambda _, k: F.aggregate(F.slice(cuts, 1, k + 1), F.lit(0), lambda a, x: a + F.length(x)))
    pieces = F.transform(F.sequence(F.lit(1), F.size(cuts) - 1), lambda k: attribution.event(F.get(stops, k - 1), F.get(stops, k), F.col("unit"), F.lit("option")))
    whole = F.array(attribution.event(F.lit(0), size, F.col("unit"), F.col("part")))
    asked = rows.where(F.col("question").isNotNull())
    inside = F.when(size == 0, F.array(end)).when(F.col("part") == "option", F.concat(pieces, F.array(end))).otherwise(F.concat(whole, F.array(end)))
    visible = F.coalesce(F.col("raw_text").rlike(f"[^{SPACES}]"), F.lit(False)).alias("visible")
    own = asked.select(_block("document", "locator"), "document", visible, F.inline(inside))
    alone = F.concat(F.col("document").cast("string"), F.lit("/"), "locator", F.lit("#unclaimed"))
    free = unclaimed(rows).select(_block("document", "locator"), "document", F.lit(True).alias("visible"), F.inline(F.array(attribution.event(F.lit(0), size, alone, F.col("unit_kind")), end)))
    blank = rows.where(F.col("question").isNull() & ~visible).select(_block("document", "locator"), "document", visible, F.inline(F.array(end)))
    return own.unionByName(free).unionByName(blank)


def spans(rows: DataFrame) -> DataFrame:
    """All spans of placed blocks, gaps filled: every character belongs to a unit."""
    return attribution.filled_stream(stream(rows))


def blanks(rows: DataFrame) -> DataFrame:
    """The blanks to fill in, by question: runs of two or more underscores."""
    found = F.regexp_count("raw_text", F.lit(attribution.BLANK))
    return rows.where(F.col("question").isNotNull()).groupBy("unit").agg(F.sum(found).cast("long").alias("n_blanks"))


def answer_pairs(all_units: DataFrame, counted: DataFrame) -> DataFrame:
    """Questions with blanks and an answer: how many segments the answer has, and whether they could be paired one by one."""
    from quillframe.functions import text as T

    child = all_units.where("kind = 'answer'").select(F.col("parent").alias("unit"), F.col("text").alias("answer"))
    rows = all_units.where("kind = 'question'").select("unit").join(child, "unit").join(counted.where("n_blanks > 0"), "unit")
    return rows.withColumn("n_segments", F.size(T.answer_segments(F.col("answer")))).withColumn("pairable", F.col("n_segments") == F.col("n_blanks"))


def report(rows: DataFrame, found: DataFrame, asked: DataFrame) -> DataFrame:
    """One row of what a volume holds: blocks by part, questions and their make-up, options, parts, blanks, repeats."""
    count = lambda where, name: F.count_if(where).alias(name)
    total = lambda value, name: F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(name)
    part, inside = F.col("part"), F.col("question").isNotNull()
    visible = F.coalesce(F.col("raw_text").rlike(f"[^{SPACES}]"), F.lit(False))
    blanks_ = F.coalesce(F.regexp_count("raw_text", F.lit(attribution.BLANK)), F.lit(0))
    numbered = F.regexp_extract("text", f"^[（(][{SPACES}]*([0-9]+)[{SPACES}]*[)）]", 1) != ""
    each = rows.agg(
        F.count("*").alias("n_blocks"),
        F.countDistinct("document").alias("n_documents"),
        F.countDistinct("role").alias("n_roles"),
        total(F.length("raw_text"), "n_chars"),
        total(F.when(inside, F.length("raw_text")), "n_question_chars"),
        count(visible, "n_visible"),
        count(visible & ~inside, "n_unclaimed"),
        *(count(part == p, f"n_{p}") for p in ("header", "section", "subsection", "node", "content", "stem", "body")),
        count(part == "option", "n_option_rows"),
        count(part == "sub_question", "n_sub_questions"),
        count((part == "sub_question") & ~numbered, "n_unnumbered_parts"),
        count(F.col("section").isNotNull(), "n_in_sections"),
        count(F.col("subsection").isNotNull(), "n_in_subsections"),
        count(F.col("node").isNotNull(), "n_in_nodes"),
        total(F.when(inside, blanks_), "n_blanks"),
        count(inside & (blanks_ > 0), "n_blocks_with_blanks"),
        F.max(F.length("raw_text")).cast("long").alias("longest_block"),
    )
    rows_of = found.agg(F.count("*").alias("n_options"), count(F.col("recovered"), "n_recovered_options"), count(F.col("text") == "", "n_empty_options"), F.max("option_no").cast("long").alias("most_options"), F.countDistinct("label").alias("n_labels"))
    groups = F.size("option_groups")
    questions_ = asked.agg(
        F.count("*").alias("n_questions"),
        count(groups > 0, "n_choice_questions"),
        count(groups == 1, "n_single_group"),
        count(groups > 1, "n_several_groups"),
        count(F.col("complete"), "n_complete"),
        count(F.size("option_gaps") > 0, "n_with_gaps"),
        total(groups, "n_groups"),
        F.countDistinct("atom_id").alias("n_distinct_questions"),
        F.max("n_blocks").alias("most_blocks"),
        F.max(F.length("joined")).cast("long").alias("longest_question"),
        total(F.length("stem"), "n_stem_chars"),
    )
    one = F.lit(1).alias("__one")
    joined = each.withColumn("__one", one).join(rows_of.withColumn("__one", one), "__one").join(questions_.withColumn("__one", one), "__one")
    return joined.drop("__one")


def atoms(blocks: DataFrame, marks: Marks, answers: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of a volume's blocks, which are placed once."""
    from quillframe.sources.shared import checkpointed

    rows = checkpointed(placed(blocks, marks))
    found = options(rows)
    asked = questions(rows, found)
    return {"blocks": rows, "tree": tree(rows), "questions": asked, "options": found, "sub_questions": sub_questions(rows), "units": units(rows, asked, found, answers), "spans": spans(rows), "blanks": blanks(rows), "stream": stream(rows)}
