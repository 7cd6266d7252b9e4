"""Queries against their SQL on small tables of odd content, which the supplied ones have only at size."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

import __spark_entry__ as entry
from quillframe.functions import dialect, udfs
from quillframe.operators import carve, gates
from tests.test_oracle import table


def same(spark, folder, name, **tables):
    """Asserts that query and SQL agree on tables given as SQL; returns the rows."""
    connection = duckdb.connect()
    for t, sql in tables.items():
        connection.execute(f"COPY ({sql}) TO '{folder}/{t}.parquet'")
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    frame = entry.queries()[name](spark, str(folder))
    got = table(frame.columns, frame.collect())
    cursor = connection.execute(entry.oracle_sql()[name])
    assert got == table([d[0] for d in cursor.description], cursor.fetchall())
    return got[1]


def test_references_cut_before_their_semicolon(spark, tmp_path):
    page = "<html><head><title>t</title></head><body><nav><ul><li><a href=\"/?a=1&copy=2\">one</a></li></ul></nav><div class=\"ad\">&nbsp;&middot</div><article><h1>token = {}</h1><p>a &lt; b &quot;c&quot; &amp;quot</p></article><footer>&copy; x</footer></body></html>"
    pages = " UNION ALL ".join(f"SELECT {k}::BIGINT AS page_id, 'u' AS url, '{page.format(cut)}' AS html" for k, cut in enumerate(["&quot", "&amp", "&quot;", "&#39", "&lt", "&qu"]))
    rows = same(spark, tmp_path, "blocks_from_html", pages=pages)
    assert {r[-1] for r in rows if "h1" in r} == {'token = &quot', "token = &", 'token = "', "token = &#39", "token = &lt", "token = &qu"}


def test_dominant_run_where_order_keys_outweigh_prices(spark, tmp_path):
    lines = "SELECT * FROM (VALUES (1::BIGINT, 7::BIGINT, 1::INTEGER, 100.0::DOUBLE), (20001, 7, 2, 100.01), (5, 8, 3, 50.0), (9000000, 8, 4, 60.0), (9, 9, 5, 1.0)) AS t(l_orderkey, l_suppkey, l_linenumber, l_extendedprice)"
    assert {tuple(r) for r in same(spark, tmp_path, "dominant_run", lineitem=lines)} == {(1, 7), (4, 8), (5, 9)}


PATTERNS = {r".*\b(Licen[sc]e|Copyright)\b": ["Licen", "Copyright"], r".*\S@\S": ["@"], r"\S+ \| \S": [" | "], r".*\d": [], r"(?i)abc": [], r"(?i:abc)de": ["de"], r"ab|": [], r"x(ab){2}": ["ab"], r"(ab){0,2}c": ["c"], r"[a]b?\.z": [".z"], r"(?!abc)x": ["x"]}


def test_texts_that_a_pattern_needs(spark):
    texts = ["", None, "a@b", "a @ b", "no sign", "the Licence", "Licenses", "Copyright x", "xabab", "xab", "ab", "abc", "ABC", "ABCde", "abde", "ababc", "c", "a.z", "ab.z", "a | b", "| b", "7", "x", "long " * 5000]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for pattern, needs in PATTERNS.items():
        assert dialect.needed(pattern) == needs
        got = [r[1] for r in rows.select("i", F.coalesce(dialect.matches(pattern, F.col("t")), F.lit(False))).orderBy("i").collect()]
        assert got == [t is not None and re.match(pattern, t) is not None for t in texts], pattern


@pytest.mark.parametrize("name", ["before_after_counts", "carve_report"])
def test_lines_are_classified_once(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode") == 1


def test_places_of_blocks_need_one_order(spark):
    plan = entry.queries()["carve_placed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Sort \[", plan)) == 1


def test_places_where_texts_and_tags_are_missing(spark):
    kinds = "section-banner sub-module section stem body body section stem stem body sub-module section-banner body stem header body section body".split()
    rows = [(d, i, f"p{i}", k, "r", None if (i + d) % 5 == 0 else f"{k}{i}", "x") for d in (1, 2, 3) for i, k in enumerate(kinds)]
    blocks = spark.createDataFrame(rows, "document int, ordinal int, locator string, kind string, role string, text string, raw_text string")
    marks = carve.Marks(F.col("ordinal") % 2 == 1, F.col("ordinal") % 3 == 0, F.when(F.col("document") > 1, F.col("ordinal") % 4 == 0))
    got = {(r["document"], r["ordinal"]): (r["section"], r["subsection"], r["node"], r["question"], r["unit"], r["part"]) for r in carve.placed(blocks, marks).collect()}
    for d in (1, 2, 3):
        section = subsection = node = question = unit = None
        number, tag = 0, False
        for _, i, locator, kind, _, text, _ in (r for r in rows if r[0] == d):
            if kind == "section-banner":
                section, subsection, node = text or section, None, None
            elif kind == "sub-module":
                subsection = text or subsection
            elif kind == "section":
                node = text or node
            if kind == "stem":
                number, tag = number + 1, False
                question, unit = number, f"{d}/{locator}"
            elif kind in ("section-banner", "sub-module", "section"):
                question = None
            asked = question is not None and kind != "header"
            tag = tag or asked and kind != "stem" and d > 1 and i % 4 == 0
            if asked:
                part = "stem" if kind == "stem" else "option" if i % 2 == 1 and not tag else "sub_question" if i % 3 == 0 else "body"
            else:
                part = {"section-banner": "section", "sub-module": "subsection", "section": "node", "header": "header"}.get(kind, "content")
            assert got[d, i] == (section, subsection, node, question if asked else None, unit if asked else None, part), (d, i)


def test_answer_pairs_place_the_lines_once(spark):
    plan = entry.queries()["answer_pairs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan  # all of it is read from the blocks as they were written


def test_figures_are_counted_without_a_join(spark):
    some = lambda *rows: spark.createDataFrame(list(rows), "document int, locator string")
    wanted = some((1, "a"), (1, "a"), (1, "b"), (2, None), (2, "c"), (3, "d"), (3, "d"))
    found = gates.figures_lost(wanted, some((1, "a"), (1, "b"), (2, None), (3, "d"), (9, "z")), some((3, "d"), (8, "y")))
    assert sorted((tuple(r) for r in found.select("document", "locator", "detail").collect()), key=str) == [("1", "a", "2 1 0"), ("2", "c", "1 0 0"), ("2", None, "1 0 0")]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_formulas_use_all_cores(spark):
    frame = entry.queries()["formula_latex"](spark, "/root/testdata/sf0.001")
    assert frame.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_spans_of_odd_texts(spark):
    texts = ["", None, "ABC", "x ABC DEFG y", "é ABCD", "no", "AB"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for pattern in ("([A-Z])([A-Z]{2,})", "[A-Z]{2,}", "(é)?[A-Z]{3}"):
        got = [r[1] for r in rows.select("i", udfs.regex_spans(pattern)("t")).orderBy("i").collect()]
        wanted = [None if t is None else [(i, m.start(), m.end(), m[0], list(m.groups())) for i, m in enumerate(re.finditer(pattern, t))] for t in texts]
        assert [r if r is None else [tuple(x) for x in r] for r in got] == wanted, pattern
    plan = rows.select(udfs.regex_spans("a")("t"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and udfs.regex_spans("a").evalType == PythonEvalType.SQL_SCALAR_ARROW_UDF


def test_lengths_of_bodies_without_their_texts(spark):
    plan = entry.queries()["question_body"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [" in line)
    assert "text" not in plan.split(window)[1].splitlines()[1]
