"""Gates: every one turns tables into findings (gate, code, severity, document, locator, detail).

A gate has a status of its own: pass, fail, not-applicable (nothing was declared), or it refuses to judge
by raising, where a share of nothing would look like success.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.functions import text as T
from quillframe.functions.dialect import SPACES
from quillframe.operators import attribution, joins
from quillframe.sources.tables import partitions

FINDING = ["gate", "code", "severity", "document", "locator", "detail"]


class Refused(ValueError):
    """A gate without anything to judge."""


def findings(rows: DataFrame, gate: str, code: Column | str, document: Column | str = "document", locator: Column | str | None = None, detail: Column | None = None, severity: str = "error") -> DataFrame:
    text = lambda c: F.lit(None).cast("string") if c is None else (F.col(c) if isinstance(c, str) else c).cast("string")
    what = F.lit(code) if isinstance(code, str) else code
    return rows.select(F.lit(gate).alias("gate"), what.alias("code"), F.lit(severity).alias("severity"), text(document).alias("document"), text(locator).alias("locator"), text(detail).alias("detail"))


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def status(found: DataFrame, gates: list[str], undeclared: tuple[str, ...] = ()) -> DataFrame:
    """pass, fail or not-applicable of each gate, with its errors."""
    names = found.sparkSession.createDataFrame([(g, g in undeclared) for g in gates], "gate string, undeclared boolean")
    counts = found.where("severity = 'error'").groupBy("gate").agg(F.count("*").alias("n_errors"))
    rows = names.join(counts, "gate", "left").withColumn("n_errors", F.coalesce("n_errors", F.lit(0)))
    return rows.select("gate", F.when(F.col("undeclared"), "not-applicable").when(F.col("n_errors") > 0, "fail").otherwise("pass").alias("status"), "n_errors")


def refuse_empty(rows: DataFrame, what: str) -> DataFrame:
    if rows.isEmpty():
        raise Refused(f"{what}: nothing to judge")
    return rows


# --- sources and rules -------------------------------------------------------------------------------------------


def no_zero_width(blocks: DataFrame) -> DataFrame:
    """Blocks that still hold format characters."""
    bad = blocks.withColumn("n", F.size(T.format_chars(F.col("raw_text")))).where("n > 0")
    return findings(bad, "no_zero_width", "FORMAT_CHARACTERS", locator="locator", detail=F.col("n"))


def split_and_banners(found: DataFrame, declared: DataFrame, wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """Banner multisets against the declared ones, wanted documents that are missing, labels that come twice."""
    difference = joins.multiset_difference(found.select("document", "banner"), declared.select("document", "banner"))
    missing = wanted.join(documents, "document", "left_anti")
    twice = documents.groupBy("class", "number").agg(F.count("*").alias("n"), F.min("document").alias("document")).where("n > 1")
    gate = "split_and_banners"
    return union(findings(difference, gate, "BANNER_COUNT", detail=F.concat_ws(" ", "banner", "n_left", "n_right")), findings(missing, gate, "DOCUMENT_MISSING"), findings(twice, gate, "DUPLICATE_KEY", detail=F.concat_ws(" ", "class", "number")))


def exercise_items(before: DataFrame, after: DataFrame, scope: Column, kind: str, restored: str) -> DataFrame:
    """Nothing left unrestored in scope, nothing restored outside, and a scope that matches something."""
    refuse_empty(before.where(scope), "exercise_items")
    gate = "exercise_items"
    return union(findings(after.where(scope & (F.col("kind") == kind)), gate, "UNRESTORED", locator="locator"), findings(after.where(~scope & (F.col("kind") == restored)), gate, "RESTORED_OUTSIDE", locator="locator"))


def predicate_evidence(hits: DataFrame, declared: DataFrame) -> DataFrame:
    """Patterns against what they are declared to be: predicate, evidence, alternatives, unique_reason, expected_zero."""
    rows = declared.join(hits.select("predicate", "hits"), "predicate", "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    code = (
        F.when(F.coalesce(F.col("evidence"), F.lit("")) == "", "NO_EVIDENCE")
        .when(F.coalesce(F.col("alternatives"), F.lit(0)) == 0, F.when(F.coalesce(F.col("unique_reason"), F.lit("")) == "", "UNIQUE_WITHOUT_REASON"))
        .when(F.col("expected_zero") & (F.col("hits") > 0), "EXPECTED_ZERO_BUT_HIT")
        .when(~F.col("expected_zero") & (F.col("hits") == 0), "NEVER_MATCHES")
    )
    return findings(rows.withColumn("code", code).where("code IS NOT NULL"), "predicate_evidence", F.col("code"), document=None, locator="predicate", detail=F.col("hits"))


def banners_hit(references: DataFrame, declared: DataFrame, n: int) -> DataFrame:
    """Declared banners whose references are none, or implausibly few or many for ``n`` documents."""
    used = references.groupBy("banner").agg(F.count("*").alias("hits"))
    rows = declared.join(used, "banner", "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    return findings(rows.where(~F.col("hits").between(max(1, n // 2), 2 * n)), "banners_hit", "BANNER_HITS", document=None, locator="banner", detail=F.col("hits"))


# --- persistence -------------------------------------------------------------------------------------------------


def schema_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """What the relational schema enforces, as findings: keys, references, domains, spans."""
    gate, found = "schema_constraints", []

    def bad(rows: DataFrame, code: str, locator: Column | str) -> None:
        found.append(findings(rows, gate, code, document=None, locator=locator))

    for name, keys in (("sources", ["file_sha256", "volume_key"]), ("blocks", ["source_id", "locator"]), ("figures", ["unit", "ordinal"]), ("blanks", ["unit", "blank_no"]), ("layout_facts", ["source_id", "locator", "layer", "run_index", "key"])):
        if name in tables:
            bad(tables[name].groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), f"{name.upper()}_NOT_UNIQUE", F.concat_ws("|", *(F.col(k).cast("string") for k in keys)))
    if "spans" in tables:
        crossing = attribution.overlaps(tables["spans"])
        found.append(findings(crossing, gate, F.col("code"), document=None, locator="block"))
    if {"units", "unit_kinds"} <= tables.keys():
        bad(tables["units"].join(tables["unit_kinds"], "kind", "left_anti"), "UNIT_KIND_UNKNOWN", "unit")
        bad(tables["units"].where("max_choices < 1"), "MAX_CHOICES", "unit")
    if {"units", "blocks"} <= tables.keys() and "spans" in tables:
        bad(tables["spans"].join(tables["units"], "unit", "left_anti"), "SPAN_WITHOUT_UNIT", "block")
    if "figures" in tables:
        bad(tables["figures"].where("scale IS NULL OR scale <= 0 OR half_points <= 0 OR anchoring NOT IN ('inline', 'anchor', 'vml')"), "FIGURE_DOMAIN", "unit")
    return union(*found)


def persisted_stream(rows: DataFrame, runs: DataFrame, fill: bool = True) -> DataFrame:
    """No block with visible text that no span claims; then, with gaps filled, all characters attributed and none twice; no ratio below the run before.

    rows: an attribution stream with ``visible``. Orphans are looked for before filling, which would hide them.
    ``fill``: whether gaps get residual spans, as they do where tables are written.
    """
    gate, at_end = "persisted", F.col("role").isNull()
    claimed = rows.groupBy("block").agg(F.count_if(~at_end).alias("n_spans"), F.max(F.when(at_end, F.col("visible"))).alias("visible"))
    orphan = claimed.where("n_spans = 0 AND visible")
    ends = rows.where(at_end).select(*attribution.SPAN)
    spans = attribution.filled_stream(rows) if fill else rows.where(~at_end).select(*attribution.SPAN)
    total = attribution.attributed_stream(spans.unionByName(ends))
    code = F.when(F.col("attributed") > F.col("total"), "ATTRIBUTED_OVER_TOTAL").when(F.col("attributed") < F.col("total"), "TEXT_UNATTRIBUTED")
    fallen = attribution.ratchet(runs, "source_id", "schema_hash", order="started_at", value="ratio").where("fell")
    return union(
        findings(total.withColumn("code", code).where("code IS NOT NULL"), gate, F.col("code"), document=None, detail=F.col("ratio")),
        findings(orphan, gate, "ORPHAN_BLOCK", document=None, locator="block"),
        findings(fallen, gate, "RATIO_FELL", document="source_id", detail=F.col("ratio")),
    )


def persisted(spans: DataFrame, blocks: DataFrame, runs: DataFrame, fill: bool = False) -> DataFrame:
    """:func:`persisted_stream` of spans and blocks (block, n_chars, and raw_text or nothing: then any length counts as visible)."""
    visible = F.col("raw_text").rlike(f"[^{SPACES}]") if "raw_text" in blocks.columns else F.col("n_chars") > 0
    rows = attribution.stream(spans, blocks).join(blocks.select("block", visible.alias("visible")), "block", "left")
    return persisted_stream(rows, runs, fill)


def reconstructible(blocks: DataFrame, units: DataFrame, layout: DataFrame, weak: bool = False) -> DataFrame:
    """Whether text and layout can be put together again from what was kept: all or nothing.

    blocks: document, locator, text, properties (map), drawings (count); layout: the same from the record;
    units: document, text. weak: only the first eight visible characters of a block are looked for.
    """
    gate, keys = "reconstructible", ["document", "locator"]
    n = partitions(blocks, layout, units)
    recorded = layout.select("document").repartition(n, "document").distinct().withColumn("__recorded", F.lit(True))
    in_record = lambda rows: rows.join(recorded, "document", "left")
    known = F.col("__recorded") | F.col("document").isNull()
    # Documents are looked up in the record last, for the few rows that are findings otherwise.
    without = in_record(blocks.select(*keys).join(layout.select(*keys), keys, "left_anti"))
    record = layout.select(*keys, F.col("properties").alias("kept"), F.col("drawings").alias("kept_drawings"))
    both = blocks.drop("text").repartition(n, *keys).join(record.repartition(n, *keys), keys)
    found = lambda code, detail: F.struct(code.alias("code"), detail.cast("string").alias("detail"))
    got = lambda e: F.try_element_at("kept", e["key"])
    code = lambda e: F.when(got(e).isNull(), "PPR_KEY_LOST").when(got(e) != e["value"], "PPR_VALUE_DIFF")
    properties = F.transform(F.coalesce(F.map_entries("properties"), F.array()), lambda e: found(code(e), e["key"]))
    drawings = F.array(found(F.when(F.col("kept_drawings") < F.col("drawings"), "DRAWING_LOST"), F.lit(None)))
    each = both.select(*keys, F.inline(F.filter(F.concat(properties, drawings), lambda f: f["code"].isNotNull())))
    visible = lambda c: F.regexp_replace(c, r"\s+", "")
    whole = units.repartition(n, "document").groupBy("document").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", visible("text").alias("t")))), lambda r: r["t"]), "").alias("all_text"))
    probe = F.substring(visible("text"), 1, 8) if weak else visible("text")
    lost = in_record(blocks.select(*keys, "text").repartition(n, "document").join(whole, "document", "left").where((visible("text") != "") & ~F.contains(F.coalesce("all_text", F.lit("")), probe)).select(*keys))
    return union(
        findings(without.where("__recorded IS NULL").select("document").distinct(), gate, "DOCUMENT_LABEL_UNKNOWN"),
        findings(without.where(known), gate, "LAYOUT_BLOCK_MISSING", locator="locator"),
        findings(each, gate, F.col("code"), locator="locator", detail=F.col("detail")),
        findings(lost.where(known), gate, "TEXT_UNATTRIBUTED", locator="locator"),
    )


# --- declared against actual -------------------------------------------------------------------------------------


def doc_defaults(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Every declared default must be there and equal; further ones do not matter."""
    refuse_empty(declared, "doc_defaults")
    rows = declared.join(actual.withColumnRenamed("value", "now"), "key", "left")
    code = F.when(F.col("now").isNull(), "DEFAULT_MISSING").when(F.col("now") != F.col("value"), "DEFAULT_DRIFTED")
    return findings(rows.withColumn("code", code).where("code IS NOT NULL"), "doc_defaults", F.col("code"), document=None, locator="key", detail=F.col("now"))


def effective_values(declared: DataFrame, style: DataFrame, root: DataFrame, defaults: DataFrame) -> DataFrame:
    """A style's effective value (own, else root's, else the application's) against the declared one."""
    named = lambda rows, name: rows.select("key", F.col("value").alias(name))
    rows = declared.join(named(style, "own"), "key", "left").join(named(root, "rooted"), "key", "left").join(named(defaults, "given"), "key", "left")
    rows = rows.withColumn("effective", F.coalesce("own", "rooted", "given")).withColumn("origin", F.when(F.col("own").isNotNull(), "style").when(F.col("rooted").isNotNull(), "root").when(F.col("given").isNotNull(), "default"))
    return findings(rows.where("effective IS NULL OR effective <> value"), "effective_values", F.when(F.col("effective").isNull(), "VALUE_MISSING").otherwise("VALUE_DIFFERS"), document=None, locator="key", detail=F.concat_ws(" ", "effective", "origin"))


def fonts(referenced: DataFrame, declared: DataFrame) -> DataFrame:
    return findings(referenced.select("font").distinct().join(declared, "font", "left_anti"), "fonts", "FONT_UNDECLARED", document=None, locator="font")


def glyphs(blocks: DataFrame, substitutions: list[tuple[str, str]], ranges: list[tuple[int, int]], accepted: list[str]) -> DataFrame:
    """Characters that no face covers after the declared substitutions; accepted ones aside."""
    text = reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), substitutions, F.col("text"))
    rows = blocks.select("document", F.explode(F.split(text, "")).alias("ch")).where("ch <> ''").groupBy("document", "ch").agg(F.count("*").alias("n"))
    covered = reduce(lambda a, r: a | F.ascii("ch").between(*r), ranges, F.lit(False))
    return findings(rows.where(~covered & ~F.col("ch").isin(*accepted)), "glyphs", "GLYPH_UNCOVERED", detail=F.concat_ws(" ", "ch", "n"))


def table_borders(tables: DataFrame, styles: DataFrame) -> DataFrame:
    """Tables without visible edges of their own or of their style; those that only lay out options aside."""
    rows = tables.where("NOT lays_out_options").join(styles.select("style", "style_edges"), "style", "left")
    return findings(rows.where("NOT own_edges AND NOT coalesce(style_edges, false)"), "table_borders", "TABLE_WITHOUT_EDGES", locator="locator")


def unit_sanity(values: DataFrame, units: DataFrame) -> DataFrame:
    """Numeric leaves (path, key, value) against the range of their key's unit; exactly 0 means unset."""
    rows = values.join(units, "key").where("value <> 0 AND (value < low OR value > high)")
    return findings(rows, "unit_sanity", "UNIT_RANGE", document=None, locator="path", detail=F.col("value"))


def inert_version(version: str, pending: DataFrame, values: DataFrame) -> DataFrame | None:
    """Improvements held back by a version ending in -inert; None where the gate does not apply."""
    if not version.endswith("-inert"):
        return None
    rows = pending.join(values.withColumnRenamed("value", "now"), "path", "left")
    code = F.when(F.col("path").isNull(), "UNVERIFIABLE").when(F.col("now").isNull(), "PATH_MISSING").when(F.col("now") == F.col("proposed"), "ALREADY_APPLIED").when(F.col("now") != F.col("inert"), "VALUE_DIFFERS")
    return findings(rows.withColumn("code", code).where("code IS NOT NULL"), "inert_version", F.col("code"), document=None, locator="path", detail=F.col("now"))


def template_binding(declared: DataFrame, computed: DataFrame) -> DataFrame:
    """Declared template ids and hashes against recomputed ones; an undeclared one fails too."""
    rows = computed.withColumnRenamed("digest", "now").join(declared, "template", "left")
    code = F.when(F.col("digest").isNull(), "TEMPLATE_UNDECLARED").when(F.col("digest") != F.col("now"), "TEMPLATE_HASH")
    return findings(rows.withColumn("code", code).where("code IS NOT NULL"), "template_binding", F.col("code"), document=None, locator="template")


def templates_pushed(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Templates that the remote side lacks or holds with other content."""
    rows = local.join(remote.withColumnRenamed("digest", "there"), "template", "left")
    code = F.when(F.col("there").isNull(), "TEMPLATE_ABSENT").when(F.col("there") != F.col("digest"), "TEMPLATE_DIFFERS")
    return findings(rows.withColumn("code", code).where("code IS NOT NULL"), "templates_pushed", F.col("code"), document=None, locator="template")


def substituted(registered: DataFrame, applied: DataFrame, held: DataFrame) -> DataFrame:
    """Registered substitutions that were not applied and are not declared held."""
    rows = registered.select("object").distinct().join(applied.select("object"), "object", "left_anti").join(held.select("object"), "object", "left_anti")
    return findings(rows, "substituted", "NOT_SUBSTITUTED", document=None, locator="object")


def registered_count(rows: DataFrame, registered: int, gate: str = "tag_repair") -> DataFrame:
    """A finding where a repair was not made exactly as often as registered."""
    return findings(rows.agg(F.count("*").alias("n")).where(F.col("n") != registered), gate, "COUNT_DIFFERS", document=None, detail=F.concat_ws(" ", F.col("n").cast("string"), F.lit(str(registered))))


def acceptance(items: DataFrame, checks: DataFrame) -> DataFrame:
    return findings(items.join(checks, "item", "left_anti"), "acceptance", "ITEM_WITHOUT_CHECK", document=None, locator="item")


def admission(candidates: DataFrame, gates_there: DataFrame, runs: DataFrame) -> DataFrame:
    """Experience candidates: required fields, provisional status, an existing gate, runs that exist and are filled."""
    gate = "admission"
    lacking = candidates.where("rule IS NULL OR rule = '' OR gate_file IS NULL OR size(from_runs) = 0")
    wrong = candidates.where("status <> 'provisional'")
    no_gate = candidates.join(gates_there, "gate_file", "left_anti").where("gate_file IS NOT NULL")
    each = candidates.select("candidate", F.explode("from_runs").alias("run")).join(runs, "run", "left")
    code = F.when(F.col("filled").isNull(), "RUN_UNKNOWN").when(~F.col("filled"), "RUN_NOT_FILLED")
    return union(
        findings(lacking, gate, "FIELD_MISSING", document=None, locator="candidate"),
        findings(wrong, gate, "STATUS", document=None, locator="candidate"),
        findings(no_gate, gate, "GATE_UNKNOWN", document=None, locator="candidate"),
        findings(each.withColumn("code", code).where("code IS NOT NULL"), gate, F.col("code"), document=None, locator="candidate", detail=F.col("run")),
    )


def heading_ladder(levels: DataFrame) -> DataFrame:
    """Adjacent heading levels (level, size, bold, space, indent): deeper ones are not larger, bolder, wider or less indented."""
    order = Window.partitionBy("style").orderBy("level")
    up = lambda c: F.lag(c).over(order)
    rules = {
        "SIZE_GROWS": F.col("size") > up("size"),
        "SIZE_EQUAL_WITHOUT_BOLD": (F.col("size") == up("size")) & ~up("bold") & F.col("bold"),
        "SPACE_GROWS": F.col("space") > up("space"),
        "INDENT_SHRINKS": F.col("indent") < up("indent"),
        "LEVEL_SKIPPED": F.col("level") > up("level") + 1,
    }
    rows = levels.withColumn("codes", F.filter(F.array(*(F.when(F.coalesce(r, F.lit(False)), c) for c, r in rules.items())), lambda c: c.isNotNull()))
    return findings(rows.withColumn("code", F.explode("codes")), "heading_ladder", F.col("code"), document="style", locator="level")


def capability_cut(steps: DataFrame) -> DataFrame:
    """Steps (step, capability, consumes, produces) without a tag, and atomise steps that need what only compose makes."""
    gate = "capability_cut"
    makers = steps.select(F.explode("produces").alias("artifact"), "capability").groupBy("artifact").agg(F.sort_array(F.collect_set("capability")).alias("makers"))
    needs = steps.where("capability = 'atomise'").select("step", F.explode("consumes").alias("artifact"))
    backward = needs.join(makers, "artifact").where(F.col("makers") == F.array(F.lit("compose")))
    return union(findings(steps.where("capability IS NULL"), gate, "UNTAGGED", document=None, locator="step"), findings(backward, gate, "BACKWARD_EDGE", document=None, locator="step", detail=F.col("artifact")))


# --- source against output ---------------------------------------------------------------------------------------


def documents_missing(source: DataFrame, output: DataFrame) -> DataFrame:
    return findings(source.select("document").distinct().join(output, "document", "left_anti"), "verify", "DOCUMENT_MISSING")


def texts(source: DataFrame, output: DataFrame, excluded: DataFrame) -> DataFrame:
    rows = joins.reconcile_text(source, output, ["document", "locator"], excluded)
    return findings(rows.where(F.col("status").isin("TEXT_MISSING", "TEXT_CHANGED", "TEXT_PARTIAL")), "verify", F.col("status"), locator="locator")


def order_inverted(rows: DataFrame) -> DataFrame:
    found = attribution.inversions(rows, "document", order="output_index", position="source_position").where("n_inversions > 0")
    return findings(found, "verify", "ORDER_INVERTED", detail=F.col("n_inversions"))


def figures_lost(wanted: DataFrame, got: DataFrame, declared: DataFrame) -> DataFrame:
    """Fewer figures at a locator than the source has, declared ones counted in."""
    keys, names = ["document", "locator"], ("wanted", "got", "declared")
    placed = F.col("document").isNotNull() & F.col("locator").isNotNull()  # what has no place is not found again
    side = lambda rows, name: rows.select(*keys, *(F.when(F.lit(n == "wanted") | placed, F.lit(int(n == name))).otherwise(0).alias(n) for n in names))
    rows = union(side(wanted, "wanted"), side(got, "got"), side(declared, "declared")).groupBy(*keys).agg(*(F.sum(n).alias(n) for n in names))
    return findings(rows.where("got + declared < wanted"), "verify", "FIGURE_LOST", locator="locator", detail=F.concat_ws(" ", *names))


def figures_different(source: DataFrame, output: DataFrame) -> DataFrame:
    """Source figures of which no output file has the stem, as it is or rendered."""
    stem = F.regexp_replace("file", r"(\.render)?\.[A-Za-z0-9]+$", "")
    rows = source.withColumn("stem", stem).join(output.select(stem.alias("stem")), "stem", "left_anti")
    return findings(rows, "verify", "FIGURE_DIFFERENT_ASSET", locator="locator", detail=F.col("file"))


def figure_widths(rows: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Widths in the output against the source's, scaled by the font sizes: emu, body_pt, source_pt, width_mm."""
    expected = F.col("emu") / 36000 * F.col("body_pt") / F.col("source_pt")
    code = F.when(F.col("width_mm").isNull(), "FIGURE_WIDTH_MISSING").when(F.abs(F.col("width_mm") - expected) > tolerance, "FIGURE_WIDTH_DRIFT")
    return findings(rows.withColumn("code", code).where("code IS NOT NULL"), "verify", F.col("code"), locator="locator", detail=F.round(expected, 2))


def numbering_rendered(source: DataFrame, output: DataFrame, least: int = 8) -> DataFrame:
    """Texts of one place on each side whose printed numbers differ; texts that come twice are left out."""
    once = lambda rows, name: rows.where(F.length("text") >= least).groupBy("text").agg(F.count("*").alias("k"), F.first("ordinal").alias(name)).where("k = 1").drop("k")
    rows = once(source, "wanted").join(once(output, "got"), "text").where("wanted <> got")
    return findings(rows, "verify", "NUMBER_DIFFERS", document=None, locator=F.substring("text", 1, 30), detail=F.concat_ws(" ", "wanted", "got"))
