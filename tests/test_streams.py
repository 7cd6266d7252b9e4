"""Streams inside blocks, and tables in text documents."""

import pytest

from quillframe.operators import streams
from quillframe.sources import markdown


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_widest_gaps_first():
    assert streams.filled("label:  H2O      H2 + O2", ["→"], 1) == ("label:  H2O→H2 + O2", 1)
    assert streams.filled("a  b  c", ["1", "2", "3"], 2) == ("a1b2c", 2)
    assert streams.filled("no gap", ["→"], 1) == ("no gap", 0)


def test_arrows_wait_for_a_later_line(spark):
    data = [(1, 0, "title", ["→"]), (1, 1, "A  B", []), (1, 2, "C    D  E", ["x", "y"]), (2, 0, "none", ["lost"]), (2, 1, "none", []), (2, 2, "none", []), (2, 3, "A  B", [])]
    found = streams.place_arrows(spark.createDataFrame(data, "document long, ordinal long, text string, arrows array<string>"))
    assert rows(found, "document", "ordinal", "text") == [(1, 0, "title"), (1, 1, "A→B"), (1, 2, "CxDyE"), (2, 0, "none"), (2, 1, "none"), (2, 2, "none"), (2, 3, "A  B")]
    assert rows(found.where("size(unplaced) > 0"), "ordinal", "unplaced") == [(2, ["lost"])]


def test_figures_cut_runs(spark):
    runs = spark.createDataFrame([(1, 1, 0, "abcd"), (1, 1, 1, "ef"), (1, 2, 0, "plain")], "document int, block int, pos int, text string")
    figures = spark.createDataFrame([(1, 1, "g", 2), (1, 1, "h", 4), (1, 1, "i", 9), (1, 1, "j", None)], "document int, block int, figure string, offset int")
    found = streams.merged(runs, figures).where("block = 1").orderBy("begin", "kind").collect()
    assert [(r["begin"], r["text"] or r["figure"]) for r in found] == [(0, "ab"), (2, "g"), (2, "cd"), (4, "h"), (4, "ef"), (9, "i")]


def test_transcriptions_and_substitutes(spark):
    blocks = spark.createDataFrame([(1, 1, "ab"), (1, 2, "x")], "document int, ordinal int, text string")
    refs = spark.createDataFrame([(1, 1, "m", 1), (1, 1, "n", 2), (1, 2, "unknown", 0)], "document int, ordinal int, media_id string, offset int")
    texts = spark.createDataFrame([("m", "M"), ("n", "N")], "media_id string, text string")
    assert rows(streams.transcribed(blocks, refs, texts), "ordinal", "text") == [(1, "aMbN"), (2, "x")]
    rasters = spark.createDataFrame([("m", "m2")], "media_id string, raster_id string")
    assert rows(streams.rendered(refs, rasters), "media_id", "shown_id") == [("m", "m2"), ("n", "n"), ("unknown", "unknown")]


def test_banners(spark):
    figures = spark.createDataFrame([(1, 1, 2, "bbbbbbbbbbbb9999"), (1, 1, 1, "aaaaaaaaaaaa0000"), (1, 2, 1, "cccccccccccc0000")], "document int, ordinal int, figure_no int, media_id string")
    known = spark.createDataFrame([("aaaaaaaaaaaa", "A", "first"), ("bbbbbbbbbbbb", "B", "second")], "banner_id string, label string, caption string")
    assert rows(streams.image_banners(figures, known), "ordinal", "label", "caption") == [(1, "A", "first")]
    blocks = spark.createDataFrame([(1, 1, "host"), (1, 2, "plain")], "document int, ordinal int, text string")
    boxes = spark.createDataFrame([(1, 1, 1, " Banner "), (1, 2, 1, "odd")], "document int, ordinal int, box int, text string")
    out, undeclared = streams.banner_paragraphs(blocks, boxes, spark.createDataFrame([("Banner",)], "banner string"))
    assert rows(out, "ordinal", "text", "is_banner") == [(1, "Banner", True), (2, "plain", False)]
    assert rows(undeclared, "text") == [("odd",)]


def test_slices_and_catalogue(spark):
    blocks = spark.createDataFrame([("s", i) for i in range(5)], "source_id string, ordinal int")
    spans = spark.createDataFrame([("s", 1, 3, "d1"), ("s", 4, 9, "d2"), ("t", 0, 9, "d3")], "source_id string, start int, end int, document string")
    assert rows(streams.sliced(blocks, spans), "ordinal", "document") == [(1, "d1"), (2, "d1"), (4, "d2")]
    figures = spark.createDataFrame([("m", 2, 1, 1, 360000, 720000), ("m", 1, 5, 1, 180000, 90000)], "media_id string, document int, ordinal int, figure_no int, cx_emu long, cy_emu long")
    assert rows(streams.figure_catalogue(figures), "document", "display_cm", "n_uses") == [(1, "0.5x0.3", 2)]


@pytest.mark.parametrize("digest", ["a" * 64])
def test_tables_in_text(spark, digest):
    text = f"# Files\n| vendored | upstream | sha |\n|---|:-:|---|\n| `x.py` | see `src/x.py` | 11 |\n## Ported as modules\n| y | `y.json` | 22 |\n## Decisions\n| `src/x.py` | `{digest}` | keep | since it is so |\n| a | b | c | d |"
    rows_ = markdown.table_rows(spark.createDataFrame([("p", text)], "path string, value string"))
    files, decided = markdown.provenance(rows_, "Ported", "Decisions")
    assert rows(files, "path", "digest", "kind") == [("src/x.py", "11", "copied"), ("y.json", "22", "ported")]
    assert rows(decided, "path", "verdict", "why") == [("src/x.py", "keep", "since it is so")]


def test_slices_overlap_and_reach_beyond_their_source(spark):
    blocks = [("s", 3 * i) for i in range(2000)] + [("t", i) for i in range(700)] + [("t", 10**9), ("u", 5)]
    spans = [("s", 0, 10**12, "all"), ("s", 40, 700, "some"), ("s", 600, 4100, "more"), ("s", 9, 9, "empty"), ("t", -50, 1, "front"), ("t", 699, 10**9 + 1, "gap"), ("u", 6, 99, "behind"), ("v", 0, 9, "none")]
    got = streams.sliced(spark.createDataFrame(blocks, "source_id string, ordinal long"), spark.createDataFrame(spans, "source_id string, start long, end long, document string"))
    assert rows(got, "source_id", "ordinal", "document") == sorted(((b, o, d) for b, o in blocks for s, i, j, d in spans if s == b and i <= o < j), key=str)


def test_slices_compare_few_rows(spark):
    n = 40_000
    blocks = spark.range(n).selectExpr("0 AS source_id", "id AS ordinal")
    spans = spark.range(0, n, 2).selectExpr("0 AS source_id", "id AS start", "id + 2 AS end", "id AS document")
    out = streams.sliced(blocks, spans)
    assert out.count() == n
    join = out._jdf.queryExecution().optimizedPlan().toString().split("Join")[1].splitlines()[0]
    assert "__stretch" in join
