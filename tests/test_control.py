"""The control plane, plans of output and streams."""

import pytest
from pyspark.sql import functions as F

from quillframe.operators import blueprint, control, sequence
from quillframe.sources.html_blocks import read_page
from quillframe.streaming import ledger


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_order_of_steps():
    steps = {"b": (["x"], ["y"]), "a": ([], ["x"]), "c": (["x", "y", "ext"], ["z"])}
    assert control.order(steps, ["ext"]) == ["a", "b", "c"]
    with pytest.raises(control.BadGraph, match="c"):
        control.order(steps)


def test_dangling_and_health(spark):
    edges = spark.createDataFrame([("s", "x", 0, "in"), ("s", "y", 0, "out"), ("t", "y", 1, "in")], "step string, artifact string, generation int, direction string")
    external = spark.createDataFrame([("x", 0)], "artifact string, generation int")
    assert rows(control.dangling(edges, external), "step", "artifact", "generation") == [("t", "y", 1)]
    declared = spark.createDataFrame([("a", False, "p", "s1"), ("b", False, "p", "s2"), ("c", True, None, None), ("d", True, "p", None), ("e", False, "p", "s3")], "artifact string, external boolean, path string, producer string")
    present = spark.createDataFrame([("a", "1"), ("e", "2")], "artifact string, digest string")
    prior = spark.createDataFrame([("a", "1"), ("e", "1")], "artifact string, digest string")
    assert rows(control.chain_health(declared, present, prior), "artifact", "status") == [("a", "present"), ("b", "missing"), ("c", "unbound"), ("d", "absent"), ("e", "drifted")]


def test_step_status(spark):
    steps = spark.createDataFrame([("a", "py"), ("b", "py"), ("c", None), ("d", "py")], "step string, runner string")
    inputs = spark.createDataFrame([("a", "x", "1", "1"), ("b", "x", "1", "2"), ("d", "y", "1", None)], "step string, artifact string, ran_with string, now string")
    assert rows(control.step_status(steps, inputs), "step", "status") == [("a", "ok"), ("b", "HOLD_INPUT_DRIFT"), ("c", "no-runner"), ("d", "blocked")]


def test_decisions(spark):
    schema = "item string, at int, event string, choice string, reason string, options array<string>"
    log = spark.createDataFrame([("q", 1, "open", None, None, ["y", "n"]), ("q", 2, "decide", "y", "seen", None), ("q", 3, "open", None, None, ["y", "n"]), ("r", 1, "open", None, None, ["y"]), ("r", 2, "decide", "z", "odd", None), ("r", 3, "decide", "y", " ", None)], schema)
    assert rows(control.decisions(log), "item", "state", "choice") == [("q", "decided", "y"), ("r", "pending", None)]


def test_configuration():
    assert control.canonical({"b": 1, "a": "é"}) == '{"a":"é","b":1}'
    assert control.merge_mapping({"run": {"k": 1}}, {"shared": {"a": 1}, "run": {"k": 0, "z": 2, "no": 3}}, ["shared"], ["k", "z"]) == {"shared": {"a": 1}, "run": {"k": 1, "z": 2}}
    made = control.styles({"r": {"a": 1}}, {"p": {"b": 2}, "q": {"a": 3}}, {"a": 0, "c": 0})
    assert [m["values"] for m in made] == [{"a": 1, "b": 2, "c": 0}, {"a": 3, "c": 0}] and len({m["combined_sha256"] for m in made}) == 2
    assert control.flatten("", {"a": [1, {"w": 2}]}) == [("/a[0]", "a", 1), ("/a[1]/w", "w", 2)]


def test_projection(spark):
    pairs = lambda *x: spark.createDataFrame([*x], "key string, value string")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "key string")
    found = control.project(keys, pairs(("a", "1")), pairs(("a", "0"), ("b", "2")), pairs(("c", "3")))
    assert rows(found, "key", "value", "origin", "gap") == [("a", "1", "style", False), ("b", "2", "root", False), ("c", "3", "default", True), ("d", None, "none", True)]


def test_claims(spark):
    objects = spark.createDataFrame([("s", "o1"), ("s", "o2")], "source string, object string")
    wanted = spark.createDataFrame([("s", "o1", "b1", 1, 5), ("s", "o1", "b2", 0, 9), ("s", "gone", "b3", 0, 1)], "source string, object string, block string, precedence int, ordinal int")
    assert rows(blueprint.claims(wanted, objects), "block", "status") == [("b1", "ignored"), ("b2", "owned"), ("b3", "unbound")]


def test_reactions(spark):
    texts = ["A + B → C", "A --> B+C", "see → there", "A + B ——> C + D", "none"]
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "document int, ordinal int, text string")
    decided = spark.createDataFrame([(1, 3, "exchange")], "document int, ordinal int, kind string")
    assert rows(blueprint.reactions(lines, decided), "ordinal", "status", "kind", "basis", "reaction") == [(0, "reaction", "combination", "counts", 1), (1, "reaction", "decomposition", "counts", 2), (2, "skipped", "neither", "counts", None), (3, "reaction", "exchange", "adjudicated", 3)]


def test_segments_and_rows(spark):
    streams = spark.createDataFrame([(1, 1, 0, "text", "a", None), (1, 1, 1, "picture", "", "f"), (1, 1, 2, "picture", "", "f")], "document int, block int, pos int, kind string, text string, file string")
    figures = spark.createDataFrame([(1, 1, "f", "g1"), (1, 1, "f", "g2"), (1, 1, "f", "g3")], "document int, block int, file string, figure string")
    assert rows(blueprint.segments(streams, figures), "pos", "figure") == [(0, None), (1, "g1"), (1073741824, "g3"), (2, "g2")]
    options = spark.createDataFrame([(1, 1, i, t, 1 + i // 3, 2) for i, t in enumerate("ABCD")], "document int, question int, ordinal int, text string, source_row int, columns int")
    assert rows(blueprint.option_rows(options), "row_no", "cells", "source_rows") == [(0, ["A", "B"], [1]), (1, ["C", "D"], [1, 2])]


def test_smaller_plan_steps(spark):
    cells = spark.createDataFrame([("t", 1, {"top": "x", "tl2br": "d"}), ("t", 2, {"top": "x"}), ("t", 3, {"top": "y"})], "table string, cell int, edges map<string,string>")
    assert rows(blueprint.own_edges(cells), "cell", "edge") == [(1, "tl2br"), (3, "top")]
    blocks = spark.createDataFrame([(1, 2, "p2", "title", "late"), (1, 1, "p1", "title", "first")], "document int, ordinal int, locator string, kind string, text string")
    assert blueprint.titles(blocks).first()["title"] == "first"
    themes = spark.createDataFrame([(1, i, t) for i, t in enumerate(["a/b", "a/b", "c"])], "volume int, ordinal int, theme string")
    assert rows(blueprint.theme_chapters(themes), "ordinal", "levels") == [(0, ["a", "b"]), (2, ["c"])]
    assert spark.range(1).select(blueprint.figure_width(F.lit(360000), F.lit(10), F.lit(None).cast("int"), F.lit(None).cast("int"))).first()[0] == 8.33


def test_pages_as_blocks():
    found = read_page("<nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>T</h1><p>a <b>b</b><p>c<script>no</script></article>tail")
    assert [(r[1], r[5]) for r in found] == [("nav[1]/ul[1]/li[1]", "Home"), ("article[1]/h1[1]", "T"), ("article[1]/p[1]", "a b"), ("article[1]/p[2]", "c"), ("text[1]", "tail")]


def test_streams_agree_with_batches(spark, tmp_path):
    kinds = ["body", "stem", "header", "body", "section", "body", "stem"]
    blocks = spark.createDataFrame([(d, i, k) for d in (1, 2) for i, k in enumerate(kinds)], "document long, ordinal long, kind string")
    (tmp_path / "in").mkdir()
    for part in range(3):  # in order, as a log would come
        blocks.where(F.floor(F.col("ordinal") / 3) == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"part{part}"))
    batch = rows(sequence.question_runs(blocks), "document", "ordinal", "question", "is_stem")
    stream = spark.readStream.schema(blocks.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    out = rows(ledger.drained(ledger.question_machine(stream), "machine", str(tmp_path / "check")), "document", "ordinal", "question", "is_stem")
    assert out == batch


def test_windows_over_a_stream(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{folder}/events.parquet")
    want = rows(ledger.tumbling(events), "start", "event_type", "n")
    stream = ledger.tumbling(ledger.read_stream(spark, folder, "events"), late="1000 days")
    assert rows(ledger.drained(stream, "windows", str(tmp_path / "w"), "complete"), "start", "event_type", "n") == want
    again = ledger.once(ledger.read_stream(spark, folder, "events"), "event_id", late="1000 days")
    assert ledger.drained(again.select("event_id"), "distinct_events", str(tmp_path / "d")).count() == events.select("event_id").distinct().count()
