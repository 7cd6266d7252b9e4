"""Order-dependent operators on blocks. Order is always a column; every window is partitioned by document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.sources.shared import checkpointed


def over(*keys: str, order: str = "ordinal"):
    return Window.partitionBy(*keys).orderBy(order)


def so_far(*keys: str, order: str = "ordinal"):
    return over(*keys, order=order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(*keys: str, order: str = "ordinal"):
    return over(*keys, order=order).rowsBetween(Window.unboundedPreceding, -1)


def carried(value: Column, *keys: str, order: str = "ordinal") -> Column:
    """The last value that is not null, up to this row."""
    return F.last(value, ignorenulls=True).over(so_far(*keys, order=order))


def section_carry(blocks: DataFrame, label: str = "text") -> DataFrame:
    """section, subsection and node of each block, from its ``kind``.

    A section banner sets the section and clears what is below it; a sub-module sets the subsection and
    leaves the node; a section heading sets the node. What is carried remembers its run of the section, so that one
    order of a document serves all.
    """
    rows = blocks.withColumn("section_run", F.sum((F.col("kind") == "section-banner").cast("long")).over(so_far("document")))
    rows = rows.withColumn("section", carried(F.when(F.col("kind") == "section-banner", F.col(label)), "document"))
    for name, kind in (("subsection", "sub-module"), ("node", "section")):
        value = F.substring(label, 1, 30) if name == "node" else F.col(label)
        last = carried(F.when((F.col("kind") == kind) & value.isNotNull(), F.struct("section_run", value.alias("value"))), "document")
        rows = rows.withColumn(name, last)
    held = lambda name: F.when(F.col(name)["section_run"].eqNullSafe(F.col("section_run")), F.col(name)["value"])
    return rows.withColumns({name: held(name) for name in ("subsection", "node")})


CLOSERS = ("section", "sub-module", "section-banner")


def question_runs(blocks: DataFrame) -> DataFrame:
    """question (1, 2, ... in each document, null outside) and is_stem. Header blocks neither open nor close one."""
    rows = blocks.where(F.col("kind") != "header")
    event = F.when(F.col("kind") == "stem", "stem").when(F.col("kind").isin(*CLOSERS), "close")
    rows = rows.withColumn("state", carried(event, "document")).withColumn("number", F.sum((F.col("kind") == "stem").cast("long")).over(so_far("document")))
    return rows.withColumn("question", F.when((F.col("state") == "stem"), F.col("number"))).withColumn("is_stem", F.col("kind") == "stem").drop("state", "number")


def joined_text(rows: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """The texts of each group in order, without a separator, and the id of the result."""
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", F.col(text).alias("x")))), lambda r: r["x"]), "")
    return rows.groupBy(*keys).agg(F.count("*").alias("n_blocks"), whole.alias("joined")).withColumn("atom_id", F.substring(F.sha2("joined", 256), 1, 16))


def islands(rows: DataFrame, new: Column, *keys: str, order: str = "ordinal", name: str = "island") -> DataFrame:
    """Numbers runs of rows: a run begins where ``new`` holds."""
    return rows.withColumn(name, F.sum(F.coalesce(new.cast("long"), F.lit(1))).over(so_far(*keys, order=order)))


def numbering_islands(rows: DataFrame, *keys: str, value: str = "printed") -> DataFrame:
    """Runs of printed numbers that go up by one; a null joins the open run and leaves its last number."""
    last = F.last(value, ignorenulls=True).over(before(*keys))
    first = F.row_number().over(over(*keys)) == 1
    new = F.when(F.col(value).isNull(), first).otherwise(last.isNull() | (F.col(value) != last + 1))
    return rows.withColumn("begins", new).transform(lambda r: islands(r, F.col("begins"), *keys, name="run"))


def list_numbers(rows: DataFrame, *keys: str, start: Column | None = None) -> DataFrame:
    """The number a list item is shown with: its count so far for its list and level, which no higher level resets."""
    begin = F.lit(1) if start is None else start
    return rows.withColumn("shown", F.row_number().over(over(*keys)) + begin - 1)


def option_groups(options: DataFrame, *keys: str, chars: str = "ABCD") -> DataFrame:
    """Groups of option labels: a new one where a label does not come after the one before it.

    complete: the group is all of ``chars``; gap: it is not even their beginning.
    """
    rows = islands(options.withColumn("back", F.col("label") <= F.lag("label").over(over(*keys))), F.coalesce(F.col("back"), F.lit(False)), *keys, name="group_no")
    labels = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "label"))), lambda r: r["label"]), "")
    found = rows.groupBy(*keys, "group_no").agg(labels.alias("labels"))
    return found.withColumn("complete", F.col("labels") == chars).withColumn("gap", F.col("labels") != F.substring(F.lit(chars), F.lit(1), F.length("labels")))


def heading_boundaries(blocks: DataFrame, is_heading: Column, key: Column, is_field: Column | None = None) -> DataFrame:
    """Headings that begin a document part: not one directly before a heading of another key, and no repeat of the last.

    ``is_field``: lines that a field makes, such as those of a table of contents, are no headings.
    """
    is_heading = is_heading if is_field is None else is_heading & ~F.coalesce(is_field, F.lit(False))
    rows = blocks.where(F.trim("raw_text") != "").withColumn("key", F.when(is_heading, key)).withColumn("next_key", F.lead(F.when(is_heading, key)).over(over("document")))
    kept = rows.where(F.col("key").isNotNull() & (F.col("next_key").isNull() | (F.col("next_key") == F.col("key"))))
    return kept.withColumn("last_key", F.lag("key").over(over("document"))).where("last_key IS NULL OR last_key <> key").drop("last_key", "next_key")


def places(rows: DataFrame, keys: list[str], buckets: list[Column], order: list[Column | str], name: str = "place") -> DataFrame:
    """The rank of each row in its key, however few keys there are.

    ``buckets``: coarse values that never go against ``order``. Only rows of one bucket are ranked among
    themselves; the numbers of rows in the buckets before are added.
    """
    coarse = [f"__b{k}" for k in range(len(buckets))]
    rows = rows.withColumns(dict(zip(coarse, buckets)))
    sizes = rows.groupBy(*keys, *coarse).agg(F.count("*").alias("__n"))
    ahead = F.sum("__n").over(Window.partitionBy(*keys).orderBy(*coarse)) - F.col("__n")
    sizes = sizes.select(*(F.col(c).alias(f"__k{k}") for k, c in enumerate([*keys, *coarse])), ahead.alias("__ahead"))
    own = rows.withColumn("__own", F.row_number().over(Window.partitionBy(*keys, *coarse).orderBy(*order)))
    same = [own[c].eqNullSafe(sizes[f"__k{k}"]) for k, c in enumerate([*keys, *coarse])]
    joined = own.join(sizes, reduce(lambda a, b: a & b, same))
    return joined.withColumn(name, (F.col("__ahead") + F.col("__own")).cast("long")).drop(*coarse, "__own", "__ahead", *(f"__k{k}" for k in range(len(same))))


def inherited(rows: DataFrame, default: Column) -> DataFrame:
    """id and value: each row's own value, else that of the nearest ancestor (based_on) that has one, else the default.

    Pointers double: a row without a value takes over its parent's value and its parent's parent, so that the
    number of rounds is the logarithm of the longest chain. What still points on after as many rounds as any
    chain of these rows needs goes in a circle and gets the default.
    """
    now = checkpointed(rows.select("id", "based_on", "value"))
    rounds = max(1, now.count()).bit_length() + 1
    for _ in range(rounds):
        open_ = F.col("value").isNull() & F.col("based_on").isNotNull()
        if now.where(open_).isEmpty():
            break
        parent = now.select(F.col("id").alias("__id"), F.col("based_on").alias("__next"), F.col("value").alias("__theirs"))
        joined = now.join(parent, open_ & (F.col("based_on") == F.col("__id")), "left")
        now = checkpointed(joined.select("id", F.when(open_, F.col("__next")).otherwise(F.col("based_on")).alias("based_on"), F.coalesce("value", "__theirs").alias("value")))
    return now.select("id", F.coalesce("value", default).alias("value"))


def boundary_spans(boundaries: DataFrame, ends: DataFrame) -> DataFrame:
    """start and end (exclusive) of each boundary's part: up to the next boundary of any class, or the document's end."""
    return boundaries.withColumn("end", F.lead("ordinal").over(over("document"))).join(ends, "document").select("document", "class", "key", F.col("ordinal").alias("start"), F.coalesce("end", "stop").alias("end"))


def latch(rows: DataFrame, flag: Column, *keys: str, name: str) -> DataFrame:
    """Whether ``flag`` has held, up to and with this row."""
    return rows.withColumn(name, F.max(flag.cast("int")).over(so_far(*keys)) == 1)


def join_next(blocks: DataFrame, joins: Column, text: str = "text") -> DataFrame:
    """Titles that take in the next non-empty block; that block goes."""
    rows = blocks.where(F.trim(text) != "").withColumn("joins", joins)
    rows = rows.withColumn("absorbed", F.coalesce(F.lag("joins").over(over("document")), F.lit(False)) & ~F.col("joins")).withColumn("next_text", F.lead(text).over(over("document"))).withColumn("next_joins", F.lead("joins").over(over("document")))
    whole = F.when(F.col("joins") & F.col("next_text").isNotNull() & ~F.coalesce("next_joins", F.lit(False)), F.concat_ws(" ", text, "next_text")).otherwise(F.col(text))
    return rows.withColumn("title", whole).where("NOT absorbed").drop("joins", "absorbed", "next_text", "next_joins")


def suppress_repeats(titles: DataFrame, *keys: str, title: str = "title") -> DataFrame:
    """repeats: the title equals the one before it on its level, so that it is not printed again."""
    return titles.withColumn("repeats", F.coalesce(F.lag(title).over(over(*keys)) == F.col(title), F.lit(False)))


def printed_once(titles: DataFrame, *keys: str, title: str = "title") -> tuple[DataFrame, DataFrame]:
    """Titles without those that repeat the one before them on their level; and these, as exclusions with their reason."""
    rows = suppress_repeats(titles, *keys, title=title)
    return rows.where("NOT repeats").drop("repeats"), rows.where("repeats").drop("repeats").withColumn("exclusion_class", F.lit("carrier"))


def nearest_owner(rows: DataFrame, is_owner: Column, owner: Column, *keys: str) -> DataFrame:
    """owner: the nearest row before this one for which ``is_owner`` holds."""
    return rows.withColumn("owner", F.last(F.when(is_owner, owner), ignorenulls=True).over(before(*keys)))


def near_neighbour(rows: DataFrame, reach: int, *keys: str, value: str) -> DataFrame:
    """The smallest distance, at most ``reach``, to a row of the same value; null without one."""
    found = [F.when(f(value, k).over(over(*keys)) == F.col(value), k) for k in range(1, reach + 1) for f in (F.lag, F.lead)]
    return rows.withColumn("distance", F.least(*found))


def reclaimed(blocks: DataFrame, *keys: str, reach: int = 2) -> DataFrame:
    """carrier: a text-box body whose whole text is a condition on an arrow at most ``reach`` blocks away.

    blocks: ordinal, text, is_body, in_box, conditions (array, null for none).
    """
    near = [f("conditions", k).over(over(*keys)) for k in range(1, reach + 1) for f in (F.lag, F.lead)]
    none = F.array().cast("array<string>")
    known = F.flatten(F.array(*(F.coalesce(c, none) for c in near)))
    text = F.trim("text")
    return blocks.withColumn("carrier", F.col("is_body") & F.col("in_box") & (text != "") & F.array_contains(F.transform(known, lambda c: F.trim(c)), text))


def list_level(rows: DataFrame, event: Column, *keys: str) -> DataFrame:
    """list_level: the level that the last event set, 0 before any."""
    return rows.withColumn("list_level", F.coalesce(carried(event, *keys), F.lit(0)))


def monotonic(rows: DataFrame, *keys: str, value: str) -> DataFrame:
    """Rows whose number is not above the one before it."""
    return rows.withColumn("previous", F.lag(value).over(over(*keys))).where(F.col(value) <= F.col("previous"))


def relevel(rows: DataFrame, rules: list[tuple[str, str, int]], default: int) -> DataFrame:
    """new_level of a heading: that of the first rule whose banner and parent it stands under ("" for any)."""
    out = None
    for banner, parent, level in rules:
        hit = F.lit(True)
        if banner:
            hit = hit & F.coalesce(F.col("banner") == banner, F.lit(False))
        if parent:
            hit = hit & F.coalesce(F.col("parent") == parent, F.lit(False))
        out = (F.when if out is None else out.when)(hit, F.lit(level))
    return rows.withColumn("new_level", out.otherwise(F.lit(default)))


def run_slice(runs: DataFrame, start: int, end: int, *keys: str) -> DataFrame:
    """:func:`stream_slice` of runs (a struct array with text and marks, in order), marks kept: the runs inside, cut at the ends."""
    each = runs.select(*keys, "ordinal", F.posexplode("runs").alias("run_no", "run"))
    rows = each.select(*keys, F.struct("ordinal", "run_no").alias("ordinal"), F.col("run.text").alias("text"), "run")
    cut = stream_slice(rows, start, end, *keys)
    return cut.select(*keys, "ordinal.ordinal", "ordinal.run_no", F.col("run").withField("text", F.col("part")).alias("run"))


def stream_slice(pieces: DataFrame, start: int, end: int, *keys: str, text: str = "text") -> DataFrame:
    """The part of each piece that lies in the characters from ``start`` to ``end`` of its stream."""
    stop = F.sum(F.length(text)).over(so_far(*keys))
    rows = pieces.withColumn("stop", stop).withColumn("begin", F.col("stop") - F.length(text))
    low, high = F.greatest(F.lit(start), F.col("begin")), F.least(F.lit(end), F.col("stop"))
    return rows.where((F.col("begin") < end) & (F.col("stop") > start)).withColumn("part", F.substring(text, (low - F.col("begin") + 1).cast("int"), (high - low).cast("int"))).drop("stop", "begin")
