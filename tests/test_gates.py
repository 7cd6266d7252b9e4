"""Each gate with a red and a green input."""

import pytest
from pyspark.sql import functions as F

from quillframe.operators import gates, persist


def codes(found):
    return sorted(r["code"] for r in found.collect())


def frame(spark, schema, *rows):
    return spark.createDataFrame([*rows], schema)


def test_banners(spark):
    declared = frame(spark, "document int, banner string", (1, "x"), (1, "x"))
    documents = frame(spark, "document int, class string, number int", (1, "a", 1), (2, "a", 2))
    wanted = frame(spark, "document int", (1,))
    assert codes(gates.split_and_banners(declared, declared, wanted, documents)) == []
    red = documents.unionByName(frame(spark, "document int, class string, number int", (4, "a", 2)))
    assert codes(gates.split_and_banners(declared.limit(1), declared, frame(spark, "document int", (9,)), red)) == ["BANNER_COUNT", "DOCUMENT_MISSING", "DUPLICATE_KEY"]


def test_exercise_items(spark):
    schema = "document int, locator string, kind string, field string"
    before = frame(spark, schema, (1, "a", "note", "drill"), (1, "b", "note", "text"))
    scope = F.col("field") == "drill"
    good = before.withColumn("kind", F.when(scope, "item").otherwise(F.col("kind")))
    assert codes(gates.exercise_items(before, good, scope, "note", "item")) == []
    assert codes(gates.exercise_items(before, before.withColumn("kind", F.when(~scope, "item").otherwise(F.col("kind"))), scope, "note", "item")) == ["RESTORED_OUTSIDE", "UNRESTORED"]


def test_predicates_need_evidence(spark):
    hits = frame(spark, "predicate string, hits long", ("a", 3), ("zero", 2), ("dead", 0))
    schema = "predicate string, evidence string, alternatives int, unique_reason string, expected_zero boolean"
    declared = frame(spark, schema, ("a", "seen", 1, None, False), ("zero", "seen", 1, None, True), ("dead", "seen", 1, None, False), ("bare", "", 1, None, False), ("only", "seen", 0, "", False))
    assert codes(gates.predicate_evidence(hits, declared)) == ["EXPECTED_ZERO_BUT_HIT", "NEVER_MATCHES", "NO_EVIDENCE", "UNIQUE_WITHOUT_REASON"]


def test_schema_constraints(spark):
    span = "block string, char_start int, char_end int, unit string, role string"
    good = {"spans": frame(spark, span, ("b", 0, 3, "u", "stem"), ("b", 3, 5, "u", "stem")), "units": frame(spark, "unit string, kind string, max_choices int", ("u", "stem", 1)), "unit_kinds": frame(spark, "kind string", ("stem",)), "blocks": frame(spark, "source_id string, locator string", ("s", "p1"))}
    assert codes(gates.schema_constraints(good)) == []
    bad = good | {"spans": frame(spark, span, ("b", 0, 3, "u", "stem"), ("b", 2, 5, "nobody", "stem")), "units": frame(spark, "unit string, kind string, max_choices int", ("u", "odd", 0)), "blocks": good["blocks"].union(good["blocks"])}
    bad |= {"figures": frame(spark, "unit string, ordinal int, scale double, half_points int, anchoring string", ("u", 1, 0.0, 21, "inline")), "layout_facts": frame(spark, "source_id string, locator string, layer string, run_index int, key string", ("s", "p", "pPr", None, "jc"), ("s", "p", "pPr", None, "jc"))}
    assert codes(gates.schema_constraints(bad)) == ["BLOCKS_NOT_UNIQUE", "FIGURE_DOMAIN", "LAYOUT_FACTS_NOT_UNIQUE", "MAX_CHOICES", "SPAN_OVERLAP", "SPAN_WITHOUT_UNIT", "UNIT_KIND_UNKNOWN"]


def test_reconstructible(spark):
    schema = "document int, locator string, text string, properties map<string,string>, drawings int"
    blocks = frame(spark, schema, (1, "p1", "long enough text", {"jc": "center"}, 1), (1, "p2", "tail end", {}, 0))
    units = frame(spark, "document int, ordinal int, text string", (1, 1, "long enough"), (1, 2, "texttail end"))
    assert codes(gates.reconstructible(blocks, units, blocks)) == []
    layout = frame(spark, schema, (1, "p1", "", {"jc": "left"}, 0))
    short = units.where("ordinal = 1")
    assert codes(gates.reconstructible(blocks, short, layout)) == ["DRAWING_LOST", "LAYOUT_BLOCK_MISSING", "PPR_VALUE_DIFF", "TEXT_UNATTRIBUTED", "TEXT_UNATTRIBUTED"]
    assert codes(gates.reconstructible(blocks, short, blocks, weak=True)) == ["TEXT_UNATTRIBUTED"]
    assert codes(gates.reconstructible(blocks, units, layout.withColumn("document", F.lit(2)))) == ["DOCUMENT_LABEL_UNKNOWN"]


def test_declared_values(spark):
    pairs = lambda *x: frame(spark, "key string, value string", *x)
    assert codes(gates.doc_defaults(pairs(("a", "1")), pairs(("a", "1"), ("b", "2")))) == []
    assert codes(gates.doc_defaults(pairs(("a", "1"), ("c", "3")), pairs(("a", "2")))) == ["DEFAULT_DRIFTED", "DEFAULT_MISSING"]
    empty = frame(spark, "key string, value string").limit(0)
    assert codes(gates.effective_values(pairs(("a", "1")), empty, pairs(("a", "1")), pairs(("a", "9")))) == []
    assert codes(gates.effective_values(pairs(("a", "1"), ("z", "1")), empty, empty, pairs(("a", "9")))) == ["VALUE_DIFFERS", "VALUE_MISSING"]


def test_smaller_gates(spark):
    one = lambda name, *x: frame(spark, f"{name} string", *((v,) for v in x))
    assert codes(gates.fonts(one("font", "A", "B"), one("font", "A"))) == ["FONT_UNDECLARED"]
    assert codes(gates.acceptance(one("item", "A", "B"), one("item", "A"))) == ["ITEM_WITHOUT_CHECK"]
    assert codes(gates.substituted(one("object", "a", "b", "c"), one("object", "a"), one("object", "b"))) == ["NOT_SUBSTITUTED"]
    tables = frame(spark, "document int, locator string, style string, own_edges boolean, lays_out_options boolean", (1, "t1", "S", False, False), (1, "t2", "N", False, False), (1, "t3", "N", False, True))
    assert codes(gates.table_borders(tables, frame(spark, "style string, style_edges boolean", ("S", True)))) == ["TABLE_WITHOUT_EDGES"]
    values = frame(spark, "path string, key string, value double", ("a/w", "w", 0.0), ("b/w", "w", 5.0), ("c/w", "w", 99.0))
    assert codes(gates.unit_sanity(values, frame(spark, "key string, low double, high double", ("w", 1.0, 50.0)))) == ["UNIT_RANGE"]
    digests = frame(spark, "template string, digest string", ("a", "1"), ("b", "2"))
    assert codes(gates.template_binding(frame(spark, "template string, digest string", ("a", "0")), digests)) == ["TEMPLATE_HASH", "TEMPLATE_UNDECLARED"]
    assert codes(gates.templates_pushed(digests, frame(spark, "template string, digest string", ("a", "0")))) == ["TEMPLATE_ABSENT", "TEMPLATE_DIFFERS"]
    blocks = frame(spark, "document int, text string", (1, "aé‑…"))
    assert codes(gates.glyphs(blocks, [("‑", "-")], [(32, 126)], ["é"])) == ["GLYPH_UNCOVERED"]
    assert codes(gates.banners_hit(one("banner", "x", "x", "y"), one("banner", "x", "z"), 2)) == ["BANNER_HITS"]


def test_inert_versions(spark):
    pending = frame(spark, "path string, inert string, proposed string", ("a", "1", "2"), ("b", "1", "2"), (None, "1", "2"), ("gone", "1", "2"), ("odd", "1", "2"))
    values = frame(spark, "path string, value string", ("a", "1"), ("b", "2"), ("odd", "3"))
    assert gates.inert_version("2.0", pending, values) is None
    assert codes(gates.inert_version("2.0-inert", pending, values)) == ["ALREADY_APPLIED", "PATH_MISSING", "UNVERIFIABLE", "VALUE_DIFFERS"]


def test_admission(spark):
    candidates = frame(spark, "candidate string, rule string, status string, gate_file string, from_runs array<string>", ("ok", "r", "provisional", "g", ["1"]), ("bad", "", "accepted", "none", ["2", "3"]))
    found = gates.admission(candidates, frame(spark, "gate_file string", ("g",)), frame(spark, "run string, filled boolean", ("1", True), ("2", False)))
    assert codes(found) == ["FIELD_MISSING", "GATE_UNKNOWN", "RUN_NOT_FILLED", "RUN_UNKNOWN", "STATUS"]


def test_verification(spark):
    figure = lambda *x: frame(spark, "document int, locator string, file string", *x)
    wanted = figure((1, "p1", "a.wmf"), (1, "p1", "b.png"))
    assert codes(gates.figures_lost(wanted, wanted, wanted.limit(0))) == []
    assert codes(gates.figures_lost(wanted, wanted.limit(1), wanted.limit(0))) == ["FIGURE_LOST"]
    assert codes(gates.figures_different(wanted, figure((1, "p1", "a.render.png")))) == ["FIGURE_DIFFERENT_ASSET"]
    widths = frame(spark, "document int, locator string, emu long, body_pt double, source_pt double, width_mm double", (1, "a", 360000, 10.0, 12.0, 8.33), (1, "b", 360000, 10.0, 12.0, 9.0), (1, "c", 360000, 10.0, 12.0, None))
    assert codes(gates.figure_widths(widths)) == ["FIGURE_WIDTH_DRIFT", "FIGURE_WIDTH_MISSING"]
    assert codes(gates.documents_missing(wanted, wanted.where("document = 2"))) == ["DOCUMENT_MISSING"]


def test_status_has_three_values(spark):
    found = gates.fonts(frame(spark, "font string", ("B",)), frame(spark, "font string", ("A",)))
    assert {r["gate"]: r["status"] for r in gates.status(found, ["fonts", "glyphs", "volume"], ("volume",)).collect()} == {"fonts": "fail", "glyphs": "pass", "volume": "not-applicable"}


def test_persist_is_all_or_nothing(spark, tmp_path):
    units = lambda s, n: frame(spark, "source_id string, unit string", *((s, f"u{k}") for k in range(n)))
    fine = lambda tables: gates.fonts(frame(spark, "font string", ("A",)), frame(spark, "font string", ("A",)))
    bad = lambda tables: gates.fonts(frame(spark, "font string", ("B",)), frame(spark, "font string", ("A",)))
    ledger = frame(spark, "run_id int", (1,))
    persist.persist(spark, {"units": units("a", 2), "runs": ledger}, str(tmp_path), fine)
    persist.persist(spark, {"units": units("b", 3), "runs": ledger}, str(tmp_path), fine)
    with pytest.raises(persist.GateFailed):
        persist.persist(spark, {"units": units("a", 9)}, str(tmp_path), bad)
    out = persist.persist(spark, {"units": units("a", 1), "runs": ledger}, str(tmp_path), fine)
    assert {r["source_id"]: r["count"] for r in out["units"].groupBy("source_id").count().collect()} == {"a": 1, "b": 3}
    assert out["runs"].count() == 3


def test_reconstructible_in_small_partitions(spark):
    """What is found where places and documents repeat or are missing; and no exchange that Spark merges up to 64 MB as written."""
    maps = lambda **m: m
    kind = "document int, locator string, text string, properties map<string,string>, drawings int"
    blocks = spark.createDataFrame([(1, "a", "one", maps(x="1", y="2"), 1), (1, "b", "two", None, 0), (2, "a", " ", maps(x="1"), 2), (3, "a", "gone", maps(), 0), (3, "b", "gone", maps(), 0), (None, "a", "none", maps(), 0)], kind)
    layout = spark.createDataFrame([(1, "a", maps(x="1"), 1), (1, "a", maps(x="3", y="2"), 0), (2, "a", None, 2)], "document int, locator string, properties map<string,string>, drawings int")
    units = spark.createDataFrame([(1, 2, "tw"), (1, 1, "on e"), (2, 1, "?")], "document int, ordinal int, text string")
    found = gates.reconstructible(blocks, units, layout)
    assert sorted(((r["code"], r["document"], r["locator"], r["detail"]) for r in found.collect()), key=str) == sorted(
        [
            ("DOCUMENT_LABEL_UNKNOWN", "3", None, None),
            ("DOCUMENT_LABEL_UNKNOWN", None, None, None),
            ("LAYOUT_BLOCK_MISSING", "1", "b", None),
            ("LAYOUT_BLOCK_MISSING", None, "a", None),
            ("PPR_KEY_LOST", "1", "a", "y"),
            ("PPR_VALUE_DIFF", "1", "a", "x"),
            ("DRAWING_LOST", "1", "a", None),
            ("PPR_KEY_LOST", "2", "a", "x"),
            ("TEXT_UNATTRIBUTED", "1", "b", None),
            ("TEXT_UNATTRIBUTED", None, "a", None),
        ],
        key=str,
    )
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
