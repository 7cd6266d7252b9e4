"""Queries: scalar functions on the supplied texts and numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.functions import text as T, udfs
from quillframe.functions.dialect import portable
from quillframe.operators import gates, sequence
from quillframe.plans.corpus import bare_lines, turns, with_blocks, with_turns
from quillframe.plans.registry import query
from quillframe.sources.lines import marker_lines as scan_markers
from quillframe.sources.tables import spread, table

_SPICED = "spiced AS (SELECT doc_id, replace(replace(text, ' the ', ' ' || chr(8203) || 'the' || chr(173) || ' '), 'tion', 'tion' || chr(65279)) AS text FROM documents)"


@query(f"WITH {_SPICED} SELECT doc_id, regexp_replace(text, '\\p{{Cf}}', '', 'g') AS clean, (length(text) - length(regexp_replace(text, '\\p{{Cf}}', '', 'g')))::INTEGER AS n_removed FROM spiced")
def strip_format_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-width signs, put into the texts first, go again."""
    spiced = F.replace(F.replace("text", F.lit(" the "), F.lit(" ​the­ ")), F.lit("tion"), F.lit("tion﻿"))
    rows = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", spiced.alias("text"))
    return rows.select("doc_id", T.strip_format(F.col("text")).alias("clean"), F.size(T.format_chars(F.col("text"))).alias("n_removed"))


# The supplied texts hold no compatibility characters, for which SQL has no function; fixtures test those.
_HEAD = portable(r"^\s*(?:[0-9]{1,4}|[A-H])\s*[.．、)）]\s*")


@query(f"WITH n AS (SELECT doc_id, nfc_normalize(text) AS t FROM documents) SELECT doc_id, regexp_replace(CASE WHEN length(regexp_extract(t, '({_HEAD})', 1)) <= 12 THEN regexp_replace(t, '{_HEAD}', '') ELSE t END, '{portable(chr(92) + 's+')}', '', 'g') AS normal FROM n")
def normal_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compatibility form without marks, number marker and white space: what texts are compared by."""
    rows = spread(table(spark, sf_dir, "documents", "doc_id", "text"))
    plain = T.strip_marker(F.regexp_replace(udfs.nfkc(F.col("text")), f"[{T.SUB_OPEN}{T.SUB_CLOSE}]", ""))
    return rows.select("doc_id", F.regexp_replace(plain, portable(r"\s+"), "").alias("normal"))


_FORMULAS = "f AS (SELECT p_partkey, 'H_' || p_size || 'O^{' || p_brand || '} x_' || substr(p_name, 1, 1) AS text FROM part)"


def _formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("H_"), F.col("p_size").cast("string"), F.lit("O^{"), "p_brand", F.lit("} x_"), F.substring("p_name", 1, 1))
    return table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size").select("p_partkey", text.alias("text"))


_EXPANDED = r"regexp_replace(text, '[_^](?:\{([^}]*)\}|(\p{Nd}[\p{Nd}.]*)|([^\n]))', chr(57344) || '\1\2\3' || chr(57345), 'g')"


@query(f"WITH {_FORMULAS} SELECT p_partkey, {_EXPANDED} AS expanded FROM f")
def expand_subscripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _formulas(spark, sf_dir).select("p_partkey", T.expand_subscripts(F.col("text")).alias("expanded"))


@query(f"WITH {_FORMULAS}, e AS (SELECT p_partkey, regexp_split_to_array({_EXPANDED}, '[' || chr(57344) || chr(57345) || ']') AS parts FROM f) SELECT p_partkey, (i - 1)::INTEGER AS pos, parts[i] AS part, (i - 1) % 2 = 1 AS marked FROM (SELECT p_partkey, parts, generate_subscripts(parts, 1) AS i FROM e)")
def sentinel_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _formulas(spark, sf_dir).select("p_partkey", F.posexplode(T.sentinel_split(T.expand_subscripts(F.col("text")))).alias("pos", "part"))
    return parts.withColumn("marked", F.col("pos") % 2 == 1)


_LINED = "l AS (SELECT p_partkey, p_size, p_brand, 'H_2 + ' || p_brand || CASE p_partkey % 3 WHEN 0 THEN '——heat→' WHEN 1 THEN '→' ELSE ' and ' END || 'x^' || p_size AS t FROM part)"


@query(f"WITH {_LINED}, s AS (SELECT p_partkey, unnest(CASE WHEN p_partkey % 3 = 2 THEN ['plain', 'marked', 'plain', 'marked'] ELSE ['plain', 'marked', 'plain', 'arrow', 'plain', 'marked'] END) AS kind, unnest(CASE p_partkey % 3 WHEN 0 THEN ['H', '2', ' + ' || p_brand, '——heat→', 'x', p_size::VARCHAR] WHEN 1 THEN ['H', '2', ' + ' || p_brand, '→', 'x', p_size::VARCHAR] ELSE ['H', '2', ' + ' || p_brand || ' and x', p_size::VARCHAR] END) AS text, unnest(range(0, CASE WHEN p_partkey % 3 = 2 THEN 4 ELSE 6 END)) AS pos FROM l) SELECT p_partkey, pos::INTEGER AS pos, kind, text FROM s")
def typed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with an arrow and marked parts, in pieces by kind."""
    p, size = F.col("p_partkey"), F.col("p_size").cast("string")
    arrow = F.when(p % 3 == 0, "——heat→").when(p % 3 == 1, "→").otherwise(" and ")
    text = T.expand_subscripts(F.concat(F.lit("H_2 + "), "p_brand", arrow, F.lit("x^"), size))
    rows = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size").select("p_partkey", F.posexplode(T.typed_segments(text)).alias("pos", "s"))
    return rows.select("p_partkey", "pos", "s.kind", "s.text")


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'b:x' WHEN 1 THEN 'a:12|b:x' ELSE 'a:1|b:_. x' END || o_orderpriority AS runs FROM orders")
def strip_marker_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers that lie across two runs go; a number without a stop, or before a blank to fill in, stays."""
    k = F.col("o_orderkey") % 3
    run = lambda text, mark: F.struct(text.alias("text"), F.lit(mark).alias("mark"))
    first = F.when(k == 0, "1").when(k == 1, "12").otherwise("1")
    second = F.when(k == 0, "2. x").when(k == 1, "x").otherwise("_. x")
    runs = F.array(run(first, "a"), run(F.concat(second, "o_orderpriority"), "b"))
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority").select("o_orderkey", T.strip_marker_runs(runs).alias("runs"))
    return rows.select("o_orderkey", F.array_join(F.transform("runs", lambda r: F.concat(r["mark"], F.lit(":"), r["text"])), "|").alias("runs"))


@query("SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN '【1·URGENT】' WHEN o_orderpriority = '5-LOW' THEN 'least' ELSE o_orderpriority END AS title FROM orders")
def whole_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a rule matches as a whole; those that hold more than it stay."""
    title = T.whole_line(F.col("o_orderpriority"), [(r"(\d)-(URGENT)", "【$1·$2】"), ("5-LOW", "least"), ("MEDIUM", "never")])
    return table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority").select("o_orderkey", title.alias("title"))


@query(with_blocks(f", m AS (SELECT document, ordinal, regexp_extract(raw_text, '^{portable(chr(92) + 's')}*([0-9]{{1,4}}){portable(chr(92) + 's')}*[.．、)）]', 1) AS d, regexp_extract(raw_text, '^{portable(chr(92) + 's')}*([A-H]){portable(chr(92) + 's')}*[.．、)）]', 1) AS l FROM lines) SELECT document, ordinal, CASE WHEN d <> '' THEN d::INTEGER ELSE ascii(l) - 64 END AS printed FROM m WHERE d <> '' OR l <> ''"))
def marker_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that begin with a printed number."""
    return scan_markers(bare_lines(spark, sf_dir)).select("document", "ordinal", "printed")


@query("SELECT 'COUNT_DIFFERS' AS code, count(*) || ' 5' AS detail FROM orders WHERE o_orderstatus = 'P' HAVING count(*) <> 5")
def registered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders as repairs, of which five are registered."""
    rows = table(spark, sf_dir, "orders", "o_orderstatus").where("o_orderstatus = 'P'")
    return gates.registered_count(rows, 5).select("code", "detail")


_NUMBERED = "n AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN (o_orderkey % 100) || '. ' WHEN 1 THEN '(' WHEN 2 THEN chr((65 + o_orderkey % 10)::INT) || '、' WHEN 3 THEN chr((9312 + o_orderkey % 25)::INT) WHEN 4 THEN '  7． ' ELSE '' END || o_orderpriority AS text FROM orders)"


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    marker = (
        F.when(key % 6 == 0, F.concat((key % 100).cast("string"), F.lit(". ")))
        .when(key % 6 == 1, "(")
        .when(key % 6 == 2, F.concat(F.char(65 + key % 10), F.lit("、")))
        .when(key % 6 == 3, F.get(F.split(F.lit("".join(map(chr, range(9312, 9337)))), ""), (key % 25).cast("int")))
        .when(key % 6 == 4, "  7． ")
        .otherwise("")
    )
    return table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority").select("o_orderkey", F.concat(marker, "o_orderpriority").alias("text"))


_S = portable(r"\s")


@query(f"WITH {_NUMBERED}, p AS (SELECT o_orderkey, regexp_extract(text, '^{_S}*([0-9]{{1,4}}){_S}*[.．、)）]', 1) AS d, regexp_extract(text, '^{_S}*([A-H]){_S}*[.．、)）]', 1) AS l, regexp_extract(text, '^{_S}*([①-⑳])', 1) AS c FROM n) SELECT o_orderkey, (CASE WHEN d <> '' THEN d::INT WHEN l <> '' THEN ascii(l) - 64 WHEN c <> '' THEN ascii(c) - 9311 END)::INTEGER AS ordinal FROM p")
def marker_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir).select("o_orderkey", T.marker_ordinal(F.col("text")).alias("ordinal"))


@query(f"WITH {_NUMBERED} SELECT o_orderkey, regexp_replace(text, '^{_S}*(?:[0-9]{{1,4}}|[A-H]){_S}*[.．、)）]{_S}*', '') AS stripped FROM n")
def strip_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir).select("o_orderkey", T.strip_marker(F.col("text")).alias("stripped"))


_LOCATORS = "l AS (SELECT l_orderkey, l_linenumber, l_partkey, 'source1:body/tbl[' || l_linenumber || ']/tr[' || l_partkey % 5 || ']/tc[2]/p[1]' || CASE l_partkey % 3 WHEN 0 THEN '#option2' WHEN 1 THEN '/drawing[1]/x' ELSE '' END AS locator FROM lineitem)"


@query(f"WITH {_LOCATORS}, p AS (SELECT *, regexp_replace(regexp_replace(locator, '^[a-z]+[0-9]*:', ''), '(#[^/]*|/(drawing|shape)\\[[0-9]+\\][^\\n]*)$', '') AS paragraph FROM l) SELECT l_orderkey, l_linenumber, l_partkey, paragraph, split_part(paragraph, '/tr[', 1) AS tbl FROM p")
def locator_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, p = F.col("l_linenumber").cast("string"), F.col("l_partkey")
    locator = F.concat(F.lit("source1:body/tbl["), n, F.lit("]/tr["), (p % 5).cast("string"), F.lit("]/tc[2]/p[1]"), F.when(p % 3 == 0, "#option2").when(p % 3 == 1, "/drawing[1]/x").otherwise(""))
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").withColumn("paragraph", T.locator_paragraph(locator))
    return rows.withColumn("tbl", T.locator_table(F.col("paragraph")))


@query("SELECT p_partkey, CASE WHEN p_type = 'STANDARD' THEN 'Plain' WHEN regexp_matches(p_name, '[aeiou]') THEN regexp_replace(p_name, '[aeiou]', '*') ELSE p_name END AS title FROM part")
def title_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides first; of a pattern only the first match is replaced."""
    rows = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    title = T.title_normalise(F.col("p_name"), {}, [("[aeiou]", "*")])
    return rows.select("p_partkey", F.when(F.col("p_type") == "STANDARD", "Plain").otherwise(title).alias("title"))


@query(with_turns("SELECT document, ordinal, regexp_extract(text, '^([A-Z][a-z]+)', 1) AS tag, substr(text, length(regexp_extract(text, '^([A-Z][a-z]+)', 1)) + 1) AS rest FROM turns WHERE regexp_matches(text, '^[A-Z][a-z]+')"))
def tag_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A leading tag becomes a segment of its own."""
    tag = F.regexp_extract("text", "^([A-Z][a-z]+)", 1)
    rows = turns(spark, sf_dir).where(F.col("text").rlike("^[A-Z][a-z]+"))
    return rows.select("document", "ordinal", tag.alias("tag"), F.substring("text", F.length(tag) + 1, F.length("text")).alias("rest"))


@query("SELECT c_custkey, concat_ws(' / ', CASE WHEN c_nationkey % 3 <> 0 THEN 'N' || c_nationkey END, nullif(c_mktsegment, 'BUILDING'), c_name) AS path FROM customer")
def hierarchy_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_name")
    nation = F.when(F.col("c_nationkey") % 3 != 0, F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    return rows.select("c_custkey", T.hierarchy_path(nation, segment, F.col("c_name")).alias("path"))


_UNITS = ("pt", "in", "cm", "mm", "pc", "px", "em", "")


@query("SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN p_size * 12700 WHEN 1 THEN p_size * 914400 WHEN 2 THEN p_size * 360000 WHEN 3 THEN p_size * 36000 WHEN 4 THEN p_size * 152400 WHEN 5 THEN p_size * 9525 END::BIGINT AS emu FROM part")
def css_length_emu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes with units; without a known unit there is no size."""
    unit = F.get(F.array(*map(F.lit, _UNITS)), (F.col("p_partkey") % 8).cast("int"))
    rows = table(spark, sf_dir, "part", "p_partkey", "p_size")
    return rows.select("p_partkey", T.css_emu(F.concat(F.col("p_size").cast("string"), unit)).alias("emu"))


@query("SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN round((p_retailprice * 1000 / 12700) / ((p_size % 7) / 2.0::DOUBLE), 4) END AS scale FROM part")
def figure_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    return rows.select("p_partkey", T.figure_scale(F.col("p_retailprice") * 1000, F.col("p_size") % 7).alias("scale"))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 11 = 0 THEN 'subscript' WHEN l_partkey % 13 = 0 THEN 'superscript' WHEN l_suppkey % 17 = 0 THEN 'source' WHEN l_quantity > 48 OR l_returnflag = 'R' AND l_linenumber = 1 THEN 'highlight' "
    "WHEN l_discount > 0.08 AND l_linenumber = 2 THEN 'blank' WHEN l_discount > 0.08 THEN 'underline' WHEN l_tax > 0.07 THEN 'emphasis' WHEN l_linestatus = 'O' AND l_suppkey % 5 = 0 THEN 'topic' WHEN l_linestatus = 'O' THEN 'bold' WHEN l_quantity < 5 THEN 'italic' ELSE 'plain' END AS run_type FROM lineitem"
)
def run_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_discount", "l_tax", "l_linestatus")
    c = F.col
    marks = {
        "vert": F.when(c("l_partkey") % 11 == 0, "subscript").when(c("l_partkey") % 13 == 0, "superscript").otherwise(""),
        "color": F.when(c("l_suppkey") % 17 == 0, "source").when(c("l_suppkey") % 5 == 0, "topic").otherwise(""),
        "highlight": c("l_quantity") > 48,
        "shading": F.when((c("l_returnflag") == "R") & (c("l_linenumber") == 1), "FFFF00").when(c("l_returnflag") == "A", "auto"),
        "underline": c("l_discount") > 0.08,
        "dot": c("l_tax") > 0.07,
        "bold": c("l_linestatus") == "O",
        "italic": c("l_quantity") < 5,
    }
    text = F.when(c("l_linenumber") == 2, "   ").otherwise("text")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", T.run_type(marks, text).alias("run_type"))


@query("SELECT n_nationkey, '{\"name\":\"' || n_name || '\",\"region\":' || n_regionkey || '}' AS meta FROM nation")
def meta_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A meta blob; fields that are null are left out."""
    meta = F.to_json(F.struct(F.col("n_name").alias("name"), F.lit(None).cast("string").alias("none"), F.col("n_regionkey").alias("region")))
    return table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey").select("n_nationkey", meta.alias("meta"))


@query("WITH p AS (SELECT p_partkey, list_filter(regexp_split_to_array(regexp_replace(p_brand || '²' || p_type || '₂x', '([²₂])', chr(57344) || '\\1' || chr(57344), 'g'), chr(57344)), lambda x: x <> '') AS parts FROM part) SELECT p_partkey, (i - 1)::INTEGER AS pos, parts[i] AS part FROM (SELECT p_partkey, parts, generate_subscripts(parts, 1) AS i FROM p)")
def literal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raised and lowered digits become pieces of their own."""
    text = F.concat("p_brand", F.lit("²"), "p_type", F.lit("₂x"))
    return table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type").select("p_partkey", F.posexplode(T.literal_split(text, "²₂")).alias("pos", "part"))


@query("WITH c AS (SELECT doc_id, unnest(string_split(replace(text, chr(10), ''), '')) AS ch FROM documents) SELECT ch, count(*) AS n, count(DISTINCT doc_id) AS n_documents FROM c WHERE ch <> '' AND ascii(ch) >= 127 AND ch NOT IN ('é', 'è') GROUP BY ch")
def uncovered_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters that no declared range covers, after the accepted exceptions; counted per document first."""
    ranges = spark.createDataFrame([(32, 126)], "first int, last int").collect()
    exceptions = ["é", "è", "\n"]
    char = F.explode(F.split("text", ""))
    rows = spread(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", char.alias("ch")).groupBy("doc_id", "ch").agg(F.count("*").alias("k"))
    covered = F.lit(False)
    for r in ranges:
        covered = covered | F.ascii("ch").between(r["first"], r["last"])
    return rows.where((F.col("ch") != "") & ~covered & ~F.col("ch").isin(*exceptions)).groupBy("ch").agg(F.sum("k").alias("n"), F.countDistinct("doc_id").alias("n_documents"))


@query("WITH r AS (SELECT p_partkey, list_filter(list_transform(string_split(p_brand || ' + ' || p_type || '+' || p_size, '+'), lambda x: trim(x)), lambda x: x <> '') AS t FROM part) SELECT p_partkey, len(t)::INTEGER AS n_terms, len(list_filter(t, lambda x: length(x) > 7 OR regexp_matches(x, '[^ ][ ]+[^ ]')))::INTEGER AS n_suspicious FROM r")
def reaction_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.concat("p_brand", F.lit(" + "), "p_type", F.lit("+"), F.col("p_size").cast("string"))
    found = T.terms(side)
    rows = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type", "p_size")
    return rows.select("p_partkey", F.size(found).alias("n_terms"), F.size(F.filter(found, T.suspicious_term)).alias("n_suspicious"))


@query("WITH o AS (SELECT l_orderkey, l_linenumber, l_partkey, unnest(['A', 'B', 'C']) AS label, unnest([l_returnflag, l_linestatus, l_partkey::VARCHAR]) AS text FROM lineitem) SELECT * FROM o")
def option_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option rows made from lines and taken apart again."""
    row = F.concat(F.lit("A."), "l_returnflag", F.lit("  B．"), "l_linestatus", F.lit(" C、"), F.col("l_partkey").cast("string"))
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    found = spread(rows).select("l_orderkey", "l_linenumber", "l_partkey", F.explode(udfs.split_options()(row)).alias("o"))
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "o.label", "o.text")


@query(
    with_blocks(
        ", m AS (SELECT document, ordinal, regexp_extract_all(raw_text, '[A-Z][A-Z]{2,}') AS found, regexp_split_to_array(raw_text, '[A-Z][A-Z]{2,}') AS apart FROM lines), "
        "p AS (SELECT document, ordinal, found, apart, unnest(range(1, len(found) + 1)) AS k FROM m WHERE len(found) > 0), "
        "s AS (SELECT document, ordinal, k, found[k] AS word, list_sum(list_transform(apart[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:k - 1], lambda x: length(x))), 0) AS start FROM p) "
        "SELECT document, ordinal, (k - 1)::INTEGER AS ix, word, start::INTEGER AS start, (start + length(word))::INTEGER AS stop, substr(word, 1, 1) AS first_group, substr(word, 2) AS second_group FROM s"
    )
)
def regex_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs of capitals of every line, with number, place and groups."""
    lines = bare_lines(spark, sf_dir).where(F.col("raw_text").rlike("[A-Z]{3}"))
    found = lines.select("document", "ordinal", F.inline(udfs.regex_spans("([A-Z])([A-Z]{2,})")(F.col("raw_text"))))
    return found.select("document", "ordinal", "ix", F.col("text").alias("word"), "start", F.col("end").alias("stop"), F.get("groups", F.lit(0)).alias("first_group"), F.get("groups", F.lit(1)).alias("second_group"))


@query("WITH w AS (SELECT l_orderkey, count(*) AS n, max(length(l_partkey::VARCHAR || l_returnflag || '各') + 1) AS widest FROM lineitem GROUP BY 1) SELECT l_orderkey, n, widest::BIGINT AS widest, (CASE WHEN n % 4 = 0 AND widest * 4 <= 32 THEN 4 WHEN n % 3 = 0 AND widest * 3 <= 32 THEN 3 WHEN n % 2 = 0 AND widest * 2 <= 32 THEN 2 ELSE 1 END)::INTEGER AS columns FROM w")
def fit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many options go in a row: the widest one decides, full-width characters count twice."""
    text = F.concat(F.col("l_partkey").cast("string"), "l_returnflag", F.lit("各"))
    width = F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: a + F.when(c == "", 0).otherwise(T.char_width(c)))
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_returnflag").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max(width).cast("long").alias("widest"))
    fits = lambda k: (F.col("n") % k == 0) & (F.col("widest") * k <= 32)
    return rows.withColumn("columns", F.when(fits(4), 4).when(fits(3), 3).when(fits(2), 2).otherwise(1))


@query("WITH RECURSIVE s AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 9 <> 0 THEN p_partkey // 2 WHEN p_partkey % 27 <> 0 THEN p_partkey - 1 END AS based_on, CASE WHEN p_size > 48 THEN p_size END AS size FROM part), c AS (SELECT id, based_on, size, 0 AS depth FROM s UNION ALL SELECT c.id, s.based_on, s.size, depth + 1 FROM c JOIN s ON s.id = c.based_on WHERE c.size IS NULL) SELECT id, coalesce(max(size), 24)::INTEGER AS size FROM c GROUP BY id")
def inherit_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A style's size: its own, else along the chain of styles it is based on, else the default."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_size")
    styles = parts.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 9 != 0, F.floor(F.col("p_partkey") / 2)).when(F.col("p_partkey") % 27 != 0, F.col("p_partkey") - 1).alias("based_on"), F.when(F.col("p_size") > 48, F.col("p_size")).alias("size"))
    return sequence.inherited(styles.withColumnRenamed("size", "value"), F.lit(24)).withColumnRenamed("value", "size")


@query("SELECT r_regionkey, coalesce(max(n_name) FILTER (WHERE n_name > 'NATION_2'), r_name) AS value, CASE WHEN max(n_name) FILTER (WHERE n_name > 'NATION_2') IS NULL THEN 'default' ELSE 'deviation' END AS origin FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name")
def schema_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults with deviations on top, and where each value comes from."""
    deviations = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey", "n_name").where("n_name > 'NATION_2'").groupBy("n_regionkey").agg(F.max("n_name").alias("own"))
    regions = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    rows = regions.join(deviations, regions["r_regionkey"] == deviations["n_regionkey"], "left")
    return rows.select("r_regionkey", F.coalesce("own", "r_name").alias("value"), F.when(F.col("own").isNull(), "default").otherwise("deviation").alias("origin"))
