"""From a word-processor file to tables and back: the whole chain on small volumes, and the parts it is made of."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quillframe.functions import dialect
from quillframe.functions.dialect import Rule
from quillframe.functions.text import collapse_ws
from quillframe.operators import attribution, carve, classify, control, gates, joins, persist, sequence, streams
from quillframe.sources import docx, docx_build as build

RULES = [
    Rule(10, "title", "header", "Lesson"),
    Rule(20, "banner", "section-banner", "Part "),
    Rule(30, "point", "section", "Point"),
    Rule(40, "question", "stem", dialect.filled(r"\d{1,2}{stops}", {"stops": ".．、"})),
    Rule(50, "row", "body", dialect.filled("{labels}[.．]", {"labels": "ABCDEFGH"})),
    Rule(60, "part", "body", r"[（(]\s*\d+\s*[)）]"),
    Rule(70, "explanation", "body", "【"),
]
LINES = [
    "1．First ____ and ＿＿ thing?",
    "A．one  B．two  C．three  D．four",
    "（1）a part ____",
    "【详解】because",
    "A．this is wrong as it says B．nothing",
    "Part two",
    "Lesson seven",
    "2．Second?",
    "B．x C．y",
    "Point of it",
    "free text about Point of it here",
    "　 ",
    "more prose",
]


def volume(spark):
    body = [build.paragraph(build.run(x)) for x in LINES] + [build.table([["cell one", "cell two"]])]
    files = spark.createDataFrame([("src", build.build(body))], "source_id string, content binary")
    read = docx.docx_tables(files)["blocks"].where("is_text_carrier").withColumnRenamed("source_id", "document")
    rows = read.withColumn("text", collapse_ws(F.col("raw_text")))
    rows = rows.withColumn("role", dialect.first_match(RULES, F.col("text"), "prose")).withColumn("kind", dialect.kind_of(RULES, F.col("role")))
    return rows.select("document", "ordinal", "locator", "kind", "role", "text", "raw_text")


def marks():
    return carve.Marks(F.col("role") == "row", F.col("role") == "part", F.col("role") == "explanation")


@pytest.fixture(scope="module")
def atoms(spark):
    answers = spark.createDataFrame([("src", 1, "x、y", "since"), ("src", 9, "none", None)], "document string, question long, answer string, explanation string")
    return {k: v.collect() if k not in ("stream", "blocks") else v for k, v in carve.atoms(volume(spark), marks(), answers).items()}


def test_questions_and_options(atoms):
    first, second = sorted(atoms["questions"], key=lambda r: r["question"])
    assert (first["unit"], first["option_groups"], first["complete"], first["n_blocks"], first["section"]) == ("src/body/p[1]", ["ABCD"], True, 5, None)
    assert (second["option_groups"], second["complete"], second["option_gaps"], second["section"]) == (["BC"], False, ["BC"], "Part two")
    assert [(o["question"], o["label"], o["text"]) for o in sorted(atoms["options"], key=lambda o: (o["question"], o["option_no"]))] == [(1, "A", "one"), (1, "B", "two"), (1, "C", "three"), (1, "D", "four"), (2, "B", "x"), (2, "C", "y")]
    assert [(s["label"], s["sub_no"]) for s in atoms["sub_questions"]] == [("(1)", 1)]


def test_headers_come_first(atoms):
    nodes = sorted(atoms["tree"], key=lambda r: r["place"])
    assert [(n["level"], n["label"]) for n in nodes[:3]] == [("header", "Lesson seven"), ("section", "Part two"), ("node", "Point of it")]


def test_units(atoms):
    units = {u["unit"]: u for u in atoms["units"]}
    assert units["src/body/p[1]"]["max_choices"] == 1 and units["src/body/p[8]"]["path"] == "Part two"
    assert units["src/body/p[1]#opt4"]["text"] == "four" and units["src/body/p[1]#sub1"]["parent"] == "src/body/p[1]"
    assert (units["src/body/p[1]#answer"]["text"], units["src/body/p[1]#explanation"]["text"]) == ("x、y", "since")
    kinds = {k.split("#")[0]: u["kind"] for k, u in units.items() if k.endswith("#unclaimed")}
    assert kinds["src/body/p[11]"] == kinds["src/body/p[10]"] == "heading" and kinds["src/body/p[13]"] == "prose" and "src/body/p[12]" not in kinds
    assert kinds["src/body/tbl[1]/tr[1]/tc[2]/p[1]"] == "prose"


def test_every_character_belongs_to_a_unit(spark, atoms):
    covered = {}
    for s in atoms["spans"]:
        covered.setdefault(s["block"], []).append((s["char_start"], s["char_end"], s["role"]))
    for k, line in enumerate(LINES):
        found = sorted(covered[f"src/body/p[{k + 1}]"])
        assert found[0][0] == 0 and found[-1][1] == len(line) and all(a[1] == b[0] for a, b in zip(found, found[1:])), line
    assert [x[2] for x in sorted(covered["src/body/p[2]"])] == ["option"] * 4 and [x[2] for x in covered["src/body/p[5]"]] == ["body"]
    assert [x[2] for x in covered["src/body/p[12]"]] == ["residual"]
    runs = spark.createDataFrame([("src", "h", 1, 0.5)], "source_id string, schema_hash string, started_at int, ratio double")
    assert gates.persisted_stream(atoms["stream"], runs).isEmpty()
    lost = atoms["stream"].where("NOT (block = 'src/body/p[13]' AND role IS NOT NULL)")
    assert [r["code"] for r in gates.persisted_stream(lost, runs).collect()] == ["ORPHAN_BLOCK"]


def test_answers_and_blanks(spark):
    answers = spark.createDataFrame([("src", 1, "x、y，z")], "document string, question long, answer string")
    tables = carve.atoms(volume(spark), marks(), answers)
    pairs = carve.answer_pairs(tables["units"], tables["blanks"]).collect()
    assert [(p["n_blanks"], p["n_segments"], p["pairable"]) for p in pairs] == [(3, 3, True)]


def test_empty_volume(spark):
    nothing = volume(spark).limit(0)
    assert all(t.isEmpty() for t in carve.atoms(nothing, marks()).values())


def test_fill_agrees_with_loops(spark):
    import random

    r = random.Random(3)
    spans, blocks = [], []
    for b in range(60):
        n = r.randint(0, 30)
        blocks.append((f"b{b}", n))
        spans += [(f"b{b}", a, min(n, a + r.randint(1, 9)), f"u{r.randint(0, 2)}", "stem") for a in sorted(r.sample(range(max(1, n)), min(n, r.randint(0, 4)))) if n]
    got = attribution.filled(spark.createDataFrame(spans, "block string, char_start long, char_end long, unit string, role string"), spark.createDataFrame(blocks, "block string, n_chars long")).collect()
    want = [tuple(s) for s in spans]
    for b, n in blocks:
        mine, at = sorted((s[1], s[2], s[3]) for s in spans if s[0] == b), 0
        owner = min(((a, u) for a, _, u in mine), default=(0, f"{b}#residual"))[1]
        for start, end, _ in [*mine, (n, n, "")]:
            if start > at:
                want.append((b, at, start, owner, "residual"))
            at = max(at, end)
    assert sorted(map(tuple, got)) == sorted(want)


def test_long_chains_and_circles_are_inherited(spark):
    rows = [(k, k - 1 if k else None, 7 if k == 0 else None) for k in range(300)] + [(1000, 1001, None), (1001, 1000, None), (1002, 1001, None), (2000, 5555, None)]
    got = dict(sequence.inherited(spark.createDataFrame(rows, "id long, based_on long, value int"), F.lit(24)).collect())
    assert all(got[k] == 7 for k in range(300)) and all(got[k] == 24 for k in (1000, 1001, 1002, 2000)) and len(got) == len(rows)


def test_places(spark):
    rows = [(k % 3, None if k % 5 == 0 else k * 37 % 50, k) for k in range(200)] + [(None, 1, 999), (None, None, 998)]
    value = F.coalesce("v", F.lit(-1))
    got = {r["k"]: r["place"] for r in sequence.places(spark.createDataFrame(rows, "g int, v int, k int"), ["g"], [F.floor(value / 10)], [value, "k"]).collect()}
    for g in (0, 1, 2, None):
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (-1 if r[1] is None else r[1], r[2]))
        assert [got[r[2]] for r in order] == list(range(1, len(order) + 1))


def no_findings(spark):
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in gates.FINDING))


def test_a_source_without_rows_loses_its_old_ones(spark, tmp_path):
    folder = str(tmp_path / "db")
    units = lambda *rows: spark.createDataFrame(list(rows), "source_id string, unit string")
    named = lambda *ids: spark.createDataFrame([(i,) for i in ids], "source_id string")
    kinds = lambda n: spark.createDataFrame([(f"k{n}",)], "kind string")
    write = lambda rows, ids, n, **more: persist.persist(spark, {"units": rows, "sources": named(*ids), "unit_kinds": kinds(n), "runs": kinds(n)}, folder, lambda t: no_findings(spark), **more)
    persist.initialise(spark, folder)
    with pytest.raises(persist.Present):
        persist.initialise(spark, folder)
    write(units(("a", "1"), ("a", "2"), ("b", "3")), "ab", 1)
    out = write(units(("b", "4")).where("false"), "b", 2)
    assert sorted(map(tuple, out["units"].collect())) == [("a", "1"), ("a", "2")]
    assert [r[0] for r in out["unit_kinds"].collect()] == ["k2"] and out["runs"].count() == 2
    dry = write(units(("a", "9")), "a", 3, dry_run=True)
    assert sorted(map(tuple, dry["units"].collect())) == [("a", "1"), ("a", "2")]
    bad = lambda t: gates.findings(t["units"], "g", "BAD", document="source_id", locator="unit")
    with pytest.raises(persist.GateFailed) as refused:
        persist.persist(spark, {"units": units(*(("a", str(k)) for k in range(150)))}, folder, bad)
    assert refused.value.n == 150 and len(refused.value.findings) == persist.SHOWN
    assert persist.read(spark, folder, "units").count() == 2


def test_archives_depend_on_content_alone():
    one, two = control.archive({"b": b"2", "a": b"1"}), control.archive({"a": b"1", "b": b"2"})
    assert one == two and zipfile.ZipFile(io.BytesIO(one)).namelist() == ["a", "b"] and one != control.archive({"a": b"1"})


def test_placeholders_and_unmapped_roles(spark):
    assert dialect.filled(r"^[{chars}]\d{2}{more}", {"more": "a-]"}) == r"^[{chars}]\d{2}[a\-\]]"
    rows = spark.createDataFrame([("known",), ("new",)], "role string")
    assert classify.refuse_unmapped(rows.limit(1), rows).count() == 1
    with pytest.raises(dialect.BadRules, match="new"):
        classify.refuse_unmapped(rows, rows.where("role = 'known'"))


def test_all_statuses(spark):
    steps = spark.createDataFrame([("a", "human", None, None, None), ("b", "human", None, None, None), ("c", None, None, "flow", None), ("d", None, None, None, None), ("e", None, "x", None, 0), ("f", None, "x", None, 2), ("g", None, "x", None, 0), ("h", None, "x", None, 0)], "step string, runner string, command string, external_entry string, return_code int")
    inputs = spark.createDataFrame([("g", "i", "1", None, False), ("h", "i", "1", "2", False), ("e", "j", None, None, True)], "step string, artifact string, ran_with string, now string, optional boolean")
    outputs = spark.createDataFrame([("a", "o", True), ("b", "o", False)], "step string, artifact string, there boolean")
    status = lambda dry: {r["step"]: r["status"] for r in control.step_status(steps, inputs, outputs, dry).collect()}
    got = status(False)
    assert got == {"a": "satisfied", "b": "awaiting-human", "c": "external-runner", "d": "no-runner", "e": "ok", "f": "failed", "g": "blocked", "h": "HOLD_INPUT_DRIFT"}
    assert status(True)["e"] == "dry-run" and set(got.values()) | {"dry-run"} == set(control.STATUSES)


def test_consumers_without_provenance(spark):
    rows = spark.createDataFrame([(None, None), ("empty", None), ("x", "1")], "path string, digest string")
    upstream = spark.createDataFrame([("x", "1")], "path string, digest string")
    got = joins.adjudicated_drift(rows, upstream, upstream.limit(0)).collect()
    assert sorted(r["status"] for r in got) == ["NO_ROWS", "PROVENANCE_MISSING", "in-sync"]


def test_edits_are_replayed_on_runs():
    text = "a     b   c"
    made = streams.edits(text, ["→", "⇒"], 2)
    runs = [{"text": "a  ", "bold": True}, {"text": "   b "}, {"text": ""}, {"text": "  c"}]
    got = streams.replayed(runs, made)
    assert "".join(r["text"] for r in got) == streams.filled(text, ["→", "⇒"], 2)[0] == "a→b⇒c"
    assert [r["text"] for r in got] == ["a→", "b⇒", "", "c"] and got[0]["bold"]


def test_null_text_is_prose(spark):
    rows = spark.createDataFrame([(1, 1, "section", "Head", "Head"), (1, 2, "body", None, None), (1, 3, "body", "a Head b", "a Head b"), (None, 1, "body", "Head", "Head")], "document int, ordinal int, kind string, text string, raw_text string")
    got = joins.unclaimed(rows, F.lit(False), F.when(F.col("kind") == "section", F.col("text"))).collect()
    assert sorted(((r["document"] or 0), r["ordinal"], r["unit_kind"]) for r in got) == [(0, 1, "prose"), (1, 1, "heading"), (1, 2, "prose"), (1, 3, "heading")]


def test_one_file_or_none(spark, tmp_path):
    from quillframe.sources.tables import NotOne, only, resolved

    for name in ("b.docx", "a.docx", "c.txt"):
        (tmp_path / name).write_text("x")
    assert [p.rpartition("/")[2] for p in resolved(spark, f"{tmp_path}/*.docx")] == ["a.docx", "b.docx"]
    assert only(spark, f"{tmp_path}/*.txt").endswith("c.txt") and resolved(spark, f"{tmp_path}/*.pdf") == []
    for pattern in ("*.docx", "*.pdf"):
        with pytest.raises(NotOne):
            only(spark, f"{tmp_path}/{pattern}")


def test_the_package_ships_itself(spark):
    from quillframe.sources import shared

    names = zipfile.ZipFile(io.BytesIO(shared.packed())).namelist()
    assert "quillframe/operators/carve.py" in names and shared.packed() == shared.packed()
    place = shared.ship_package(spark)
    assert spark.read.format("binaryFile").load(place).count() == 1


def test_missing_parts_are_left_out_and_faults_are_not_hidden(monkeypatch):
    import importlib

    import __spark_entry__ as entry

    def failing(name):
        def run(asked):
            raise ModuleNotFoundError(name=name)

        return run

    for gone in ("quillframe.llm", "quillframe.llm.queries"):
        monkeypatch.setattr(importlib, "import_module", failing(gone))
        assert entry._additions() == ({}, {})
    monkeypatch.setattr(importlib, "import_module", failing("quillframe.sources.lost"))
    with pytest.raises(ImportError):
        entry._additions()
    monkeypatch.setattr(importlib, "import_module", failing("tokenizers"))
    with pytest.warns(UserWarning, match="tokenizers"):
        assert entry._additions() == ({}, {})
