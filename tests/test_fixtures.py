"""Small inputs whose results can be worked out by hand."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillframe.functions import dialect, text as T
from quillframe.functions.formulas import omml_latex
from quillframe.functions.udfs import nfkc, option_row, regex_spans
from quillframe.operators import aggregates, attribution, control, gates, joins, sequence
from quillframe.sources.docx import css_emu


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def labels(text):
    return [(o["label"], o["text"]) for o in option_row(text)]


def test_run_together_options():
    assert labels("A．月亮  B．钻石C．太阳  D．玻璃") == [("A", "月亮"), ("B", "钻石"), ("C", "太阳"), ("D", "玻璃")]


def test_lone_letters_as_bodies():
    assert [x for x, _ in labels("A．A B．B C．C D．D")] == ["A", "B", "C", "D"]


def test_a_marker_inside_a_word_is_none():
    assert labels("A．COB．CO2") == [("A", "COB．CO2")]


def test_missing_first_label():
    found = option_row("①②  B．②③  C．全部  D．①②④")
    assert (found[0]["label"], found[0]["text"], found[0]["recovered"]) == ("A", "①②", True)
    assert len(found) == 4


def test_label_without_separator():
    assert labels("A温度 B．反应物的浓度")[0] == ("A", "温度")


def test_options_are_ordered_and_disjoint():
    random.seed(3)
    for _ in range(300):
        found = option_row("".join(random.choice("ABCD．. 甲xO2") for _ in range(40)))
        assert all(a["end"] <= b["start"] for a, b in zip(found, found[1:]))
        assert [o["label"] for o in found] == sorted(o["label"] for o in found)


def test_figures_by_offset(spark):
    windows = spark.createDataFrame([(1, "A", 0), (1, "B", 10)], "row int, label string, start int")
    points = spark.createDataFrame([(1, 1), (1, 5), (1, 11), (1, 12), (1, 900)], "row int, offset int")
    assert rows(attribution.interval_assign(points, windows, "row", "offset"), "offset", "label") == [(1, "lead"), (5, "A"), (11, "A"), (12, "B"), (900, "B")]


def test_option_groups(spark):
    data = [(q, i, c) for q, s in ((1, "ABCDABCD"), (2, "ABDABCD")) for i, c in enumerate(s)]
    found = sequence.option_groups(spark.createDataFrame(data, "question int, ordinal int, label string"), "question")
    assert rows(found, "question", "labels", "complete", "gap") == [(1, "ABCD", True, False), (1, "ABCD", True, False), (2, "ABCD", True, False), (2, "ABD", False, True)]


def test_combined_answers(spark):
    data = spark.createDataFrame([(1, "1．A  2．B  3．C"), (2, "0.1  2.3  10.0cm")], "id int, text string")
    assert rows(joins.combined_answers(data), "id", "number", "part") == [(1, 1, "A"), (1, 2, "B"), (1, 3, "C")]


def test_shared_sub_answers(spark):
    data = spark.createDataFrame([(1, "(1)甲(2)(3)乙"), (2, "(1)only")], "id int, text string")
    assert rows(joins.sub_answers(data), "id", "label", "shared_body", "answer_shared") == [(1, "1", "甲", False), (1, "2", "乙", True), (1, "3", "乙", False)]


def test_answer_keys(spark):
    questions = spark.createDataFrame([(1, "s", None, "a stem of more than eighteen characters", 4), (2, "s", None, "another", 7), (3, None, "n", "x", 9)], "ordinal int, section string, node string, stem string, number int")
    answers = spark.createDataFrame([(1, "s", None, "a stem of more than eighteen letters", None, "first"), (2, "s", None, "a stem of more than eighteen", None, "last"), (3, "s", None, "?", 7, "by number"), (4, "s", "n", "x", 9, "elsewhere")], "ordinal int, section string, node string, stem string, number int, answer string")
    found = joins.answer_join(questions, answers, ["section", "node"])
    assert rows(found, "ordinal", "answer", "matched_by") == [(1, "last", "stem"), (2, "by number", "number"), (3, None, None)]


def test_heading_boundaries(spark):
    lines = ["1 A", "1 B", "text", "1 B", "text", "2 C", "2 C", "end"]
    blocks = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "document int, ordinal int, raw_text string")
    found = sequence.heading_boundaries(blocks, F.col("raw_text").rlike("^[12] "), F.substring("raw_text", 3, 1))
    assert rows(found, "ordinal", "key") == [(1, "B"), (5, "C")]  # a contents row, a repeat and a second copy go


def test_spans_end_at_any_class(spark):
    bounds = spark.createDataFrame([(1, 0, "a", "x"), (1, 4, "b", "y"), (1, 9, "a", "z")], "document int, ordinal int, class string, key string")
    ends = spark.createDataFrame([(1, 12)], "document int, stop int")
    assert rows(sequence.boundary_spans(bounds, ends).where("class = 'a'"), "start", "end") == [(0, 4), (9, 12)]


def test_section_resets(spark):
    kinds = [("section-banner", "S"), ("sub-module", "M"), ("section", "N"), ("stem", "q"), ("sub-module", "M2"), ("stem", "q2"), ("section-banner", "T"), ("stem", "q3")]
    blocks = spark.createDataFrame([(1, i, k, t) for i, (k, t) in enumerate(kinds)], "document int, ordinal int, kind string, text string")
    found = {r["ordinal"]: (r["section"], r["subsection"], r["node"]) for r in sequence.section_carry(blocks).collect()}
    assert found[5] == ("S", "M2", "N") and found[7] == ("T", None, None)


def test_text_before_any_stem_is_in_no_question(spark):
    kinds = ["body", "stem", "header", "body", "section", "body"]
    blocks = spark.createDataFrame([(1, i, k) for i, k in enumerate(kinds)], "document int, ordinal int, kind string")
    found = {r["ordinal"]: r["question"] for r in sequence.question_runs(blocks).collect()}
    assert found == {0: None, 1: 1, 3: 1, 4: None, 5: None}


def test_zero_width_at_line_start(spark):
    data = spark.createDataFrame([("‌1．题",)], "text string")
    rule = [dialect.Rule(1, "numbered", "stem", r"\d{1,2}\s*[．.、]\s*\S")]
    before = data.select(dialect.first_match(rule, F.col("text"), "-")).first()[0]
    after = data.select(dialect.first_match(rule, T.strip_format(F.col("text")), "-")).first()[0]
    assert (before, after) == ("-", "numbered")
    assert gates.no_zero_width(data.select(F.lit(1).alias("document"), F.lit("p").alias("locator"), F.col("text").alias("raw_text"))).count() == 1


def test_filled_spans_tile_the_block(spark):
    blocks = spark.createDataFrame([("b", 20), ("empty", 0), ("alone", 3)], "block string, n_chars int")
    spans = spark.createDataFrame([("b", 3, 7, "u", "stem"), ("b", 10, 12, "v", "option")], "block string, char_start int, char_end int, unit string, role string")
    found = attribution.filled(spans, blocks)
    assert rows(found.where("role = 'residual'"), "block", "char_start", "char_end", "unit") == [("alone", 0, 3, "alone#residual"), ("b", 0, 3, "u"), ("b", 7, 10, "u"), ("b", 12, 20, "u")]
    assert found.where("block = 'b'").agg(F.sum(F.col("char_end") - F.col("char_start"))).first()[0] == 20


def test_overlaps_red_and_adjacent_green(spark):
    spans = lambda *x: spark.createDataFrame([("b", a, e, "u", "r") for a, e in x], "block string, char_start int, char_end int, unit string, role string")
    assert rows(attribution.overlaps(spans((0, 14), (10, 24), (30, 30))), "code") == [("SPAN_EMPTY",), ("SPAN_OVERLAP",)]
    assert attribution.overlaps(spans((0, 14), (14, 24))).isEmpty()


def test_scale_and_lengths(spark):
    one = spark.range(1)
    assert one.select(T.figure_scale(F.lit(304800), F.lit(21))).first()[0] == 2.2857
    assert css_emu("width:18.95pt;height:26.75pt") == (240665, 339725)
    assert css_emu("width:10;height:5pt") == (None, None)
    assert one.select(T.css_emu(F.lit("2cm")), T.css_emu(F.lit("3em"))).first()[:] == (720000, None)


def test_numbering_and_lists(spark):
    printed = spark.createDataFrame([(1, i, n) for i, n in enumerate([1, 2, 3, 1, 2, None, 5, 6])], "document int, ordinal int, printed int")
    assert [r[1] for r in rows(sequence.numbering_islands(printed, "document"), "ordinal", "run")] == [1, 1, 1, 2, 2, 2, 3, 3]
    levels = spark.createDataFrame([(1, 7, level, i) for i, level in enumerate([0, 1, 1, 0, 1])], "document int, num int, level int, ordinal int")
    assert [r[1] for r in rows(sequence.list_numbers(levels, "num", "level"), "ordinal", "shown")] == [1, 1, 2, 2, 3]


def test_marks_add_up(spark):
    parts = spark.createDataFrame([(1, 38.0), (1, 32.0), (2, 38.0), (2, 30.0), (3, 5.0)], "paper int, marks double")
    totals = spark.createDataFrame([(1, 70.0), (2, 70.0), (4, 9.0)], "paper int, total double")
    assert rows(aggregates.sum_identity(parts, totals, "paper", "marks", "total"), "paper", "verdict") == [(1, "ok"), (2, "MISMATCH"), (3, "no-total"), (4, "no-sections")]


def test_blanks(spark):
    blocks = spark.createDataFrame([("b", "甲__乙＿＿＿丙_丁")], "block string, text string")
    spans = spark.createDataFrame([("b", 0, 11, "u")], "block string, char_start int, char_end int, unit string")
    assert rows(attribution.blanks(spans, blocks), "blank_no", "start", "end") == [(1, 1, 3), (2, 4, 7)]


def test_inversions(spark):
    data = spark.createDataFrame([(1, i, p) for i, p in enumerate([0, 2, 1, 3, 5, 4])], "document int, output_index int, source_position int")
    assert rows(gates.order_inverted(data), "code", "detail") == [("ORDER_INVERTED", "2")]


def test_disposition(spark):
    files = spark.createDataFrame([("a", None, None), ("b", "a", "same text"), ("c", "a", ""), ("d", "x", "seen"), ("e", None, None), ("f", None, None), ("g", None, None)], "file string, holder string, evidence string")
    consumed = spark.createDataFrame([("a",)], "file string")
    excluded = spark.createDataFrame([("e", "draft"), ("f", "")], "file string, reason string")
    assert rows(joins.disposition(files, consumed, excluded), "file", "status") == [("a", "consumed"), ("b", "containedIn"), ("c", "no-evidence"), ("d", "holder-not-consumed"), ("e", "excluded"), ("f", "no-reason"), ("g", "ORPHAN")]


def test_backward_edge(spark):
    steps = spark.createDataFrame([("s1", "atomise", ["x"], ["y"]), ("s2", "compose", ["y"], ["x"]), ("s3", None, [], [])], "step string, capability string, consumes array<string>, produces array<string>")
    assert rows(gates.capability_cut(steps), "code", "locator") == [("BACKWARD_EDGE", "s1"), ("UNTAGGED", "s3")]


def test_ratchet(spark):
    runs = spark.createDataFrame([("s", "h", 1, 0.98), ("s", "h", 2, 0.97), ("s", "other", 3, 0.5)], "source_id string, schema_hash string, started_at int, ratio double")
    assert rows(attribution.ratchet(runs, "source_id", "schema_hash", order="started_at", value="ratio").where("fell"), "started_at") == [(2,)]


def test_empty_scopes_are_refused(spark):
    nothing = spark.createDataFrame([], "document int, locator string, text string, kind string")
    with pytest.raises(Exception, match="no non-empty block"):
        aggregates.fingerprint(nothing, F.lit(True)).collect()
    with pytest.raises(gates.Refused):
        gates.exercise_items(nothing, nothing, F.lit(True), "a", "b")
    with pytest.raises(gates.Refused):
        gates.doc_defaults(spark.createDataFrame([], "key string, value string"), spark.createDataFrame([], "key string, value string"))
    with pytest.raises(dialect.BadRules):
        dialect.first_match([], F.lit("x"), "-")


def test_subscripts(spark):
    texts = ["MnO_2", "H_2O", "x^{n+1}", "CO_2.5"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.sentinel_split(T.expand_subscripts(F.col("t"))).alias("p"))
    assert [r["p"][1] for r in found.orderBy("i").collect()] == ["2", "2", "n+1", "2.5"]


def test_compose_and_split():
    base, deviation = {"a": 1, "b": 2}, {"b": 3, "c": 4}
    whole = control.compose(base, deviation, ["a"])
    assert whole == {"a": 1, "b": 3, "c": 4} and control.compose(base, control.split(whole, base)) == whole
    with pytest.raises(control.BadGraph, match="d"):
        control.compose(base, deviation, ["d"])


@pytest.mark.parametrize("pattern", [r"\d{1,2}\s*[．.、]\s*\S", r"\s+x", r"[^\s]\S", r"(?:a|\d)\s"])
def test_rules_agree_with_python(spark, pattern):
    texts = ["1．题", "　1 . x", " 　x", "１２、甲", "1．　", "a　", "..", "x\u0085y", " x", "9"]
    data = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in data.select("i", F.col("t").rlike(dialect.matching(pattern))).orderBy("i").collect()]
    assert got == [re.match(pattern, t) is not None for t in texts]


def test_positions_and_forms(spark):
    data = spark.createDataFrame([("a1bb22 ﬁ",)], "t string")
    assert [(m["start"], m["end"], m["text"]) for m in data.select(regex_spans(r"\d+")("t")).first()[0]] == [(1, 2, "1"), (4, 6, "22")]
    assert data.select(nfkc("t")).first()[0] == "a1bb22 fi"


def test_formulas():
    space = 'xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math"'
    run = lambda t, style="": f"<m:r>{f'<m:rPr><m:sty m:val={chr(34)}{style}{chr(34)}/></m:rPr>' if style else ''}<m:t>{t}</m:t></m:r>"
    tag = lambda name, inside, **properties: f"<m:{name}>" + (f"<m:{name}Pr>" + "".join(f'<m:{k} m:val="{v}"/>' for k, v in properties.items()) + f"</m:{name}Pr>" if properties else "") + inside + f"</m:{name}>"
    e = lambda t: tag("e", run(t))
    two = tag("num", run("a")) + tag("den", run("b"))
    cases = {
        tag("f", two): r"\frac{a}{b}",
        tag("f", two, type="lin"): "{a}/{b}",
        tag("f", two, type="skw"): "{}^{a}/_{b}",
        tag("f", two, type="noBar"): r"\binom{a}{b}",
        tag("rad", "<m:radPr/><m:deg/>" + e("x")) + run("≤"): r"\sqrt{x}\leq",
        tag("rad", tag("deg", run("3")) + e("x")): r"\sqrt[3]{x}",
        tag("rad", tag("deg", run("3")) + e("x"), degHide="1"): r"\sqrt{x}",
        tag("sSubSup", e("x") + tag("sub", run("1")) + tag("sup", run("2"))) + "<m:odd>" + run("y") + "</m:odd>": "x_{1}^{2}y",
        tag("nary", tag("sub", run("i")) + tag("sup", run("n")) + e("k"), chr="∑"): r"\sum_{i}^{n} k",
        tag("nary", tag("sub", run("i")) + tag("sup", run("n")) + e("k"), subHide="on", supHide="1"): r"\int k",
        tag("d", e("x") + e("y"), begChr="[", endChr="]"): r"\left[ x|y \right]",
        tag("d", tag("e", tag("eqArr", e("1, x") + e("0"))), begChr="{", endChr=""): r"\begin{cases} 1, & x \\ 0 \end{cases}",
        tag("func", tag("fName", run("sin", "p")) + e("x")): r"\sin x",
        tag("func", tag("fName", tag("limLow", e("lim") + tag("lim", run("x→0")))) + e("f")): r"\lim_{x\to 0} f",
        tag("borderBox", e("x")) + tag("phant", e("y")): r"\boxed{x}\phantom{y}",
        tag("acc", e("x"), chr="⃗") + tag("bar", e("y"), pos="top") + tag("groupChr", e("z"), chr="⏞"): r"\vec{x}\overline{y}\overbrace{z}",
        tag("m", tag("mr", e("a") + e("b")) + tag("mr", e("c") + e("d"))): r"\begin{matrix} a & b \\ c & d \end{matrix}",
        run("5% &amp; #$ {x}"): r"5\% \& \#\$ \{x\}",
        run("𝑥𝟐αΩλεφϕ速度km"): r"x2\alpha \Omega \lambda \varepsilon \varphi \phi \text{速度}km",
        run("km", "p") + run("α1", "p"): r"\mathrm{km}α1",
    }
    for source, want in cases.items():
        assert omml_latex(f"<m:oMath {space}>{source}</m:oMath>") == want, source
    assert omml_latex(f"<m:oMathPara {space}><m:oMath>{run('a')}</m:oMath><m:oMath>{run('b')}</m:oMath></m:oMathPara>") == r"a \\ b"


def test_modes(spark):
    runs = spark.createDataFrame([(1, 0, 20, 5), (1, 1, 24, 9), (1, 2, 20, 4)], "p int, place int, size int, chars int")
    assert aggregates.weighted_mode(runs, "p", size="size", weight="chars", place="place").first()["body_size"] == 20
    assert aggregates.dominant_run(runs, "p", size="size", chars="chars", place="place").first()["dominant_size"] == 24


def test_reconciliation_ladder(spark):
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(["", "ab", "ab", "ab", "abc", "abc", "abc"])], "locator int, text string")
    got = spark.createDataFrame([(1, "a b"), (3, "xaby"), (4, "bc"), (5, "cab"), (6, "zz")], "locator int, text string")
    found = joins.reconcile_text(wanted, got, ["locator"], spark.createDataFrame([], "locator int"))
    assert rows(found, "locator", "status") == [(0, "blank"), (1, "ok"), (2, "TEXT_MISSING"), (3, "transcription"), (4, "TEXT_PARTIAL"), (5, "letters_only"), (6, "TEXT_CHANGED")]
