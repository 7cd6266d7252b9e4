"""Queries: gates over the supplied tables. Declared and actual sides come from rules on columns, the same in the SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.operators import gates
from quillframe.plans.registry import query
from quillframe.plans.scalars import _SPICED
from quillframe.sources.tables import spread, table

_FOUND = ("code", "document", "locator", "detail")


def _shown(found: DataFrame) -> DataFrame:
    return found.select(*_FOUND)


def _c(name: str, as_: str) -> Column:
    return F.col(name).alias(as_)


@query(f"WITH {_SPICED}, n AS (SELECT doc_id, length(text) - length(regexp_replace(text, '\\p{{Cf}}', '', 'g')) AS n FROM spiced) SELECT 'FORMAT_CHARACTERS' AS code, doc_id::VARCHAR AS document, 'body' AS locator, n::VARCHAR AS detail FROM n WHERE n > 0")
def gate_no_zero_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that still hold format characters, put in first."""
    spiced = F.replace(F.replace("text", F.lit(" the "), F.lit(" ​the­ ")), F.lit("tion"), F.lit("tion﻿"))
    rows = spread(table(spark, sf_dir, "documents", "doc_id", "text"))
    return _shown(gates.no_zero_width(rows.select(_c("doc_id", "document"), F.lit("body").alias("locator"), spiced.alias("raw_text"))))


@query(
    "WITH a AS (SELECT o_custkey AS document, o_orderpriority AS banner, count(*) AS n FROM orders GROUP BY ALL), b AS (SELECT o_custkey AS document, o_orderpriority AS banner, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL), "
    "d AS (SELECT document, banner, coalesce(a.n, 0) AS x, coalesce(b.n, 0) AS y FROM a FULL JOIN b USING (document, banner)) "
    "SELECT 'BANNER_COUNT' AS code, document::VARCHAR AS document, NULL AS locator, banner || ' ' || x || ' ' || y AS detail FROM d WHERE x <> y "
    "UNION ALL SELECT 'DOCUMENT_MISSING', c_custkey::VARCHAR, NULL, NULL FROM customer WHERE c_acctbal <= 0 "
    "UNION ALL SELECT 'DUPLICATE_KEY', min(c_custkey)::VARCHAR, NULL, c_mktsegment || ' ' || c_nationkey FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment, c_nationkey HAVING count(*) > 1"
)
def gate_split_and_banners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as banners of customers; customers in debt are documents that were not made."""
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderpriority", "o_orderstatus")
    banners = lambda rows: rows.select(_c("o_custkey", "document"), _c("o_orderpriority", "banner"))
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    there = customers.where("c_acctbal > 0").select(_c("c_custkey", "document"), _c("c_mktsegment", "class"), _c("c_nationkey", "number"))
    return _shown(gates.split_and_banners(banners(orders), banners(orders.where("o_orderstatus <> 'P'")), customers.select(_c("c_custkey", "document")), there))


@query("SELECT CASE WHEN l_returnflag = 'R' THEN 'UNRESTORED' ELSE 'RESTORED_OUTSIDE' END AS code, l_orderkey::VARCHAR AS document, l_linenumber::VARCHAR AS locator, NULL AS detail FROM lineitem WHERE l_returnflag = 'R' AND l_quantity < 5 OR l_returnflag <> 'R' AND l_discount > 0.09")
def gate_exercise_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines are the scope; small ones were not restored, some others were."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_discount")
    before = rows.select(_c("l_orderkey", "document"), F.col("l_linenumber").cast("string").alias("locator"), "l_returnflag", F.lit("item").alias("kind"), "l_quantity", "l_discount")
    restored = ((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 5)) | ((F.col("l_returnflag") != "R") & (F.col("l_discount") > 0.09))
    after = before.withColumn("kind", F.when(restored, "exercise").otherwise("item"))
    return _shown(gates.exercise_items(before, after, F.col("l_returnflag") == "R", "item", "exercise"))


@query(
    "WITH h AS (SELECT p_brand AS predicate, count(*) FILTER (WHERE p_size > 45) AS hits FROM part GROUP BY 1), d AS (SELECT p_brand AS predicate, CASE WHEN min(p_partkey) % 7 <> 0 THEN 'seen' END AS evidence, min(p_partkey) % 3 AS alternatives, CASE WHEN min(p_partkey) % 2 = 0 THEN 'only one' END AS reason, max(p_size) % 2 = 0 AS zero FROM part GROUP BY 1), "
    "r AS (SELECT predicate, hits, CASE WHEN evidence IS NULL THEN 'NO_EVIDENCE' WHEN alternatives = 0 THEN CASE WHEN reason IS NULL THEN 'UNIQUE_WITHOUT_REASON' END WHEN zero AND hits > 0 THEN 'EXPECTED_ZERO_BUT_HIT' WHEN NOT zero AND hits = 0 THEN 'NEVER_MATCHES' END AS code FROM d JOIN h USING (predicate)) "
    "SELECT code, NULL AS document, predicate AS locator, hits::VARCHAR AS detail FROM r WHERE code IS NOT NULL"
)
def gate_predicate_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as patterns; what is declared of them comes from their parts."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size")
    hits = parts.groupBy(_c("p_brand", "predicate")).agg(F.count_if(F.col("p_size") > 45).alias("hits"))
    least = F.min("p_partkey")
    declared = parts.groupBy(_c("p_brand", "predicate")).agg(F.when(least % 7 != 0, "seen").alias("evidence"), (least % 3).alias("alternatives"), F.when(least % 2 == 0, "only one").alias("unique_reason"), (F.max("p_size") % 2 == 0).alias("expected_zero"))
    return _shown(gates.predicate_evidence(hits, declared))


@query("WITH r AS (SELECT n_nationkey, count(c_custkey) AS hits FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 8000 GROUP BY 1) SELECT 'BANNER_HITS' AS code, NULL AS document, n_nationkey::VARCHAR AS locator, hits::VARCHAR AS detail FROM r WHERE hits NOT BETWEEN 2 AND 10")
def gate_banners_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as banners that rich customers refer to, for five documents."""
    used = table(spark, sf_dir, "customer", "c_nationkey", "c_acctbal").where("c_acctbal > 8000").select(_c("c_nationkey", "banner"))
    return _shown(gates.banners_hit(used, table(spark, sf_dir, "nation", "n_nationkey").select(_c("n_nationkey", "banner")), 5))


@query(
    "WITH s AS (SELECT l_orderkey AS block, l_partkey % 60 AS a, l_partkey % 60 + l_suppkey % 9 AS z, l_linenumber, l_partkey FROM lineitem), r AS (SELECT *, max(z) OVER (PARTITION BY block ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM s), k AS (SELECT *, CASE WHEN z <= a THEN 'SPAN_EMPTY' WHEN a < reached THEN 'SPAN_OVERLAP' END AS code FROM r) "
    "SELECT code, count(*) AS n FROM (SELECT code FROM k WHERE code IS NOT NULL UNION ALL SELECT 'SOURCES_NOT_UNIQUE' FROM (SELECT c_mktsegment, c_nationkey FROM customer GROUP BY ALL HAVING count(*) > 1) UNION ALL SELECT 'UNIT_KIND_UNKNOWN' FROM part WHERE p_type <> 'STANDARD' UNION ALL SELECT 'MAX_CHOICES' FROM part WHERE p_size < 5 "
    "UNION ALL SELECT 'SPAN_WITHOUT_UNIT' FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT 'FIGURE_DOMAIN' FROM part WHERE p_size % 10 = 0 OR p_brand > 'Brand#4') GROUP BY code"
)
def gate_schema_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, references, domains and spans of tables made from customers, parts and lines, counted by code."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    start = F.col("l_partkey") % 60
    parts = table(spark, sf_dir, "part", "p_partkey", "p_type", "p_size", "p_brand")
    tables = {
        "sources": table(spark, sf_dir, "customer", "c_mktsegment", "c_nationkey").select(_c("c_mktsegment", "file_sha256"), _c("c_nationkey", "volume_key")),
        "spans": lines.select(_c("l_orderkey", "block"), start.alias("char_start"), (start + F.col("l_suppkey") % 9).alias("char_end"), _c("l_partkey", "unit")),
        "units": parts.select(_c("p_partkey", "unit"), _c("p_type", "kind"), F.when(F.col("p_size") < 5, 0).otherwise(1).alias("max_choices")),
        "unit_kinds": spark.createDataFrame([("STANDARD",)], "kind string"),
        "blocks": lines.select(_c("l_orderkey", "source_id"), F.concat_ws(":", "l_linenumber", "l_partkey", "l_suppkey").alias("locator")),
        "figures": parts.select(_c("p_partkey", "unit"), F.lit(1).alias("ordinal"), (F.col("p_size") % 10).cast("double").alias("scale"), F.lit(21).alias("half_points"), F.when(F.col("p_brand") > "Brand#4", "loose").otherwise("inline").alias("anchoring")),
    }
    found = gates.schema_constraints(tables).where("code <> 'BLOCKS_NOT_UNIQUE'")
    return found.groupBy("code").agg(F.count("*").alias("n"))


@query(
    "SELECT code, document, locator, detail FROM (SELECT 'DOCUMENT_LABEL_UNKNOWN' AS code, o_orderkey::VARCHAR AS document, NULL AS locator, NULL AS detail FROM orders WHERE o_orderkey % 50 = 0 "
    "UNION ALL SELECT 'LAYOUT_BLOCK_MISSING', o_orderkey::VARCHAR, o_orderpriority, NULL FROM orders WHERE o_orderkey % 50 = 1 "
    "UNION ALL SELECT 'PPR_KEY_LOST', o_orderkey::VARCHAR, o_orderpriority, 'jc' FROM orders WHERE o_orderkey % 50 = 2 "
    "UNION ALL SELECT 'PPR_VALUE_DIFF', o_orderkey::VARCHAR, o_orderpriority, 'ind' FROM orders WHERE o_orderkey % 50 = 3 "
    "UNION ALL SELECT 'DRAWING_LOST', o_orderkey::VARCHAR, o_orderpriority, NULL FROM orders WHERE o_orderkey % 50 = 4 "
    "UNION ALL SELECT 'TEXT_UNATTRIBUTED', o_orderkey::VARCHAR, o_orderpriority, NULL FROM orders WHERE o_orderkey % 50 = 5)"
)
def gate_reconstructible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents of one block; each number of fifty loses something else in the record."""
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority").select(_c("o_orderkey", "document"), _c("o_orderpriority", "locator"), F.concat(F.lit("text of "), F.col("o_orderkey").cast("string")).alias("text"), (F.col("o_orderkey") % 50).alias("k"))
    properties = F.create_map(F.lit("jc"), F.lit("left"), F.lit("ind"), F.lit("0"))
    blocks = rows.select("document", "locator", "text", properties.alias("properties"), F.lit(2).alias("drawings"))
    kept = F.when(F.col("k") == 2, F.create_map(F.lit("ind"), F.lit("0"))).when(F.col("k") == 3, F.create_map(F.lit("jc"), F.lit("left"), F.lit("ind"), F.lit("9"))).otherwise(properties)
    place = F.when(F.col("k") == 1, "elsewhere").otherwise(F.col("locator"))
    layout = rows.where("k <> 0").select("document", place.alias("locator"), kept.alias("properties"), F.when(F.col("k") == 4, 1).otherwise(2).alias("drawings"))
    half = F.array(F.struct(F.lit(1).alias("ordinal"), F.lit("text ").alias("text")), F.struct(F.lit(2).alias("ordinal"), F.concat(F.lit(" of"), F.when(F.col("k") == 5, "?").otherwise(F.col("document").cast("string"))).alias("text")))
    units = rows.where("k <> 0").select("document", F.inline(half))
    return _shown(gates.reconstructible(blocks, units, layout))


@query("SELECT CASE WHEN p_size % 10 = 0 THEN 'DEFAULT_MISSING' ELSE 'DEFAULT_DRIFTED' END AS code, NULL AS document, p_partkey::VARCHAR AS locator, CASE WHEN p_size % 10 <> 0 THEN p_size::VARCHAR END AS detail FROM part WHERE p_size % 10 = 0 OR p_size > 40")
def gate_doc_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as default keys; every tenth size is missing, large ones have drifted."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_size")
    declared = parts.select(_c("p_partkey", "key"), F.least("p_size", F.lit(40)).alias("value"))
    return _shown(gates.doc_defaults(declared, parts.where("p_size % 10 <> 0").select(_c("p_partkey", "key"), _c("p_size", "value"))))


_EFFECTIVE = "e AS (SELECT p_partkey AS key, p_size % 4 AS value, CASE WHEN p_partkey % 2 = 0 THEN p_size % 5 END AS own, CASE WHEN p_partkey % 3 = 0 THEN p_size % 6 END AS rooted, CASE WHEN p_partkey % 5 = 0 THEN p_size % 7 END AS given FROM part)"


def _levels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """Declared values of parts as keys, and those of a style, of its root and of the application."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_size")
    side = lambda k, n: parts.where(F.col("p_partkey") % k == 0).select(_c("p_partkey", "key"), (F.col("p_size") % n).alias("value"))
    return side(1, 4), side(2, 5), side(3, 6), side(5, 7)


@query(f"WITH {_EFFECTIVE} SELECT CASE WHEN coalesce(own, rooted, given) IS NULL THEN 'VALUE_MISSING' ELSE 'VALUE_DIFFERS' END AS code, NULL AS document, key::VARCHAR AS locator, concat_ws(' ', coalesce(own, rooted, given), CASE WHEN own IS NOT NULL THEN 'style' WHEN rooted IS NOT NULL THEN 'root' WHEN given IS NOT NULL THEN 'default' END) AS detail FROM e WHERE coalesce(own, rooted, given) IS NULL OR coalesce(own, rooted, given) <> value")
def gate_effective_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(gates.effective_values(*_levels(spark, sf_dir)))


@query(f"WITH {_EFFECTIVE} SELECT key, coalesce(own, rooted, given) AS value, CASE WHEN own IS NOT NULL THEN 'style' WHEN rooted IS NOT NULL THEN 'root' WHEN given IS NOT NULL THEN 'default' ELSE 'none' END AS origin, own IS NULL AND rooted IS NULL AS gap FROM e")
def style_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key's value and the level it is from; a default is a gap."""
    from quillframe.operators import control

    declared, style, root, defaults = _levels(spark, sf_dir)
    return control.project(declared.select("key"), style, root, defaults)


@query("SELECT 'FONT_UNDECLARED' AS code, NULL AS document, c_mktsegment AS locator, NULL AS detail FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY c_mktsegment")
def gate_fonts(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = spark.createDataFrame([("BUILDING",), ("MACHINERY",)], "font string")
    return _shown(gates.fonts(table(spark, sf_dir, "customer", "c_mktsegment").select(_c("c_mktsegment", "font")), declared))


@query("WITH c AS (SELECT doc_id, unnest(string_split(replace(replace(text, 'ß', 'ss'), chr(10), ''), '')) AS ch FROM documents) SELECT 'GLYPH_UNCOVERED' AS code, doc_id::VARCHAR AS document, NULL AS locator, ch || ' ' || count(*) AS detail FROM c WHERE ch <> '' AND NOT ascii(ch) BETWEEN 32 AND 126 AND ch NOT IN ('é', 'è') GROUP BY doc_id, ch")
def gate_glyphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters outside ASCII after substitutions; two are accepted."""
    rows = spread(table(spark, sf_dir, "documents", "doc_id", "text")).select(_c("doc_id", "document"), "text")
    return _shown(gates.glyphs(rows, [("ß", "ss"), ("\n", "")], [(32, 126)], ["é", "è"]))


@query("SELECT 'TABLE_WITHOUT_EDGES' AS code, l_orderkey::VARCHAR AS document, l_linenumber::VARCHAR AS locator, NULL AS detail FROM lineitem WHERE l_returnflag <> 'A' AND l_quantity < 25 AND l_partkey % 3 <> 0")
def gate_table_borders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as tables: flags lay out options, quantities have edges, parts are styles of which every third has."""
    tables = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity").select(_c("l_orderkey", "document"), _c("l_linenumber", "locator"), _c("l_partkey", "style"), (F.col("l_returnflag") == "A").alias("lays_out_options"), (F.col("l_quantity") >= 25).alias("own_edges"))
    styles = table(spark, sf_dir, "part", "p_partkey").select(_c("p_partkey", "style"), (F.col("p_partkey") % 3 == 0).alias("style_edges"))
    return _shown(gates.table_borders(tables, styles))


@query("SELECT 'UNIT_RANGE' AS code, NULL AS document, c_custkey::VARCHAR AS locator, round(c_acctbal)::BIGINT::VARCHAR AS detail FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') AND round(c_acctbal) <> 0 AND (round(c_acctbal) < CASE c_mktsegment WHEN 'BUILDING' THEN 0 ELSE 100 END OR round(c_acctbal) > 9000)")
def gate_unit_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances as values whose segment is the unit, with a range for two of them."""
    values = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_mktsegment").select(_c("c_custkey", "path"), _c("c_mktsegment", "key"), F.round("c_acctbal").cast("long").alias("value"))
    return _shown(gates.unit_sanity(values, spark.createDataFrame([("BUILDING", 0, 9000), ("FURNITURE", 100, 9000)], "key string, low int, high int")))


@query("WITH v AS (SELECT p_partkey AS path, p_size AS now, p_partkey % 50 AS proposed, p_partkey % 7 + 1 AS inert, p_partkey % 10 = 0 AS lost FROM part), c AS (SELECT *, CASE WHEN lost THEN 'PATH_MISSING' WHEN now = proposed THEN 'ALREADY_APPLIED' WHEN now <> inert THEN 'VALUE_DIFFERS' END AS code FROM v) SELECT code, NULL AS document, path::VARCHAR AS locator, CASE WHEN NOT lost THEN now::VARCHAR END AS detail FROM c WHERE code IS NOT NULL UNION ALL SELECT 'UNVERIFIABLE', NULL, NULL, NULL")
def gate_inert_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Improvements held back in a version that must not show them; one has no path."""
    parts, p = table(spark, sf_dir, "part", "p_partkey", "p_size"), F.col("p_partkey")
    pending = parts.select(p.alias("path"), (p % 50).alias("proposed"), (p % 7 + 1).alias("inert"))
    pending = pending.unionByName(spark.createDataFrame([(None, 1, 2)], "path long, proposed long, inert long"))
    return _shown(gates.inert_version("1.2-inert", pending, parts.where(p % 10 != 0).select(p.alias("path"), _c("p_size", "value"))))


@query("SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'TEMPLATE_UNDECLARED' ELSE 'TEMPLATE_HASH' END AS code, NULL AS document, s_suppkey::VARCHAR AS locator, NULL AS detail FROM supplier WHERE s_suppkey % 4 = 0 OR s_nationkey > 12")
def gate_template_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as templates: every fourth is not declared, those of later nations have changed."""
    rows = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    now = rows.select(_c("s_suppkey", "template"), F.sha2(F.col("s_suppkey").cast("string"), 256).alias("digest"))
    declared = rows.where("s_suppkey % 4 <> 0").select(_c("s_suppkey", "template"), F.sha2(F.when(F.col("s_nationkey") > 12, "other").otherwise(F.col("s_suppkey").cast("string")), 256).alias("digest"))
    return _shown(gates.template_binding(declared, now))


@query("SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'TEMPLATE_ABSENT' ELSE 'TEMPLATE_DIFFERS' END AS code, NULL AS document, s_suppkey::VARCHAR AS locator, NULL AS detail FROM supplier WHERE s_suppkey % 3 = 0 OR s_acctbal < 0")
def gate_templates_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as local templates against a remote side that lacks a third of them and holds some with other content."""
    rows = table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal")
    local = rows.select(_c("s_suppkey", "template"), F.md5(F.col("s_suppkey").cast("string")).alias("digest"))
    remote = rows.where("s_suppkey % 3 <> 0").select(_c("s_suppkey", "template"), F.when(F.col("s_acctbal") < 0, "old").otherwise(F.md5(F.col("s_suppkey").cast("string"))).alias("digest"))
    return _shown(gates.templates_pushed(local, remote))


@query("SELECT 'NOT_SUBSTITUTED' AS code, NULL AS document, p_partkey::VARCHAR AS locator, NULL AS detail FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40) AND p_size >= 10")
def gate_substituted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as registered substitutions, applied in large lines; small parts are held."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_size")
    applied = table(spark, sf_dir, "lineitem", "l_partkey", "l_quantity").where("l_quantity > 40").select(_c("l_partkey", "object"))
    return _shown(gates.substituted(parts.select(_c("p_partkey", "object")), applied, parts.where("p_size < 10").select(_c("p_partkey", "object"))))


@query("SELECT 'ITEM_WITHOUT_CHECK' AS code, NULL AS document, s_suppkey::VARCHAR AS locator, NULL AS detail FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_discount > 0.09 AND l_quantity > 45)")
def gate_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = table(spark, sf_dir, "lineitem", "l_suppkey", "l_discount", "l_quantity").where("l_discount > 0.09 AND l_quantity > 45").select(_c("l_suppkey", "item"))
    return _shown(gates.acceptance(table(spark, sf_dir, "supplier", "s_suppkey").select(_c("s_suppkey", "item")), checks))


@query(
    "WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS rule, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS gate_file, CASE WHEN c_acctbal > 9000 THEN 'final' ELSE 'provisional' END AS status FROM customer), "
    "r AS (SELECT c_custkey, unnest([c_custkey * 2, c_custkey * 3]) AS run FROM c), k AS (SELECT c_custkey, run, o_orderstatus FROM r LEFT JOIN orders ON o_orderkey = run) "
    "SELECT 'FIELD_MISSING' AS code, NULL AS document, c_custkey::VARCHAR AS locator, NULL AS detail FROM c WHERE rule IS NULL OR gate_file IS NULL UNION ALL SELECT 'STATUS', NULL, c_custkey::VARCHAR, NULL FROM c WHERE status <> 'provisional' "
    "UNION ALL SELECT 'GATE_UNKNOWN', NULL, c_custkey::VARCHAR, NULL FROM c WHERE gate_file > 20 UNION ALL SELECT CASE WHEN o_orderstatus IS NULL THEN 'RUN_UNKNOWN' ELSE 'RUN_NOT_FILLED' END, NULL, c_custkey::VARCHAR, run::VARCHAR FROM k WHERE o_orderstatus IS NULL OR o_orderstatus <> 'F'"
)
def gate_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as candidate rules, orders as the runs they come from, filled where finished."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    candidates = rows.select(k.alias("candidate"), F.when(k % 5 != 0, F.col("c_name")).alias("rule"), F.when(k % 7 != 0, F.col("c_nationkey")).alias("gate_file"), F.when(F.col("c_acctbal") > 9000, "final").otherwise("provisional").alias("status"), F.array(k * 2, k * 3).alias("from_runs"))
    there = table(spark, sf_dir, "nation", "n_nationkey").where("n_nationkey <= 20").select(_c("n_nationkey", "gate_file"))
    runs = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").select(_c("o_orderkey", "run"), (F.col("o_orderstatus") == "F").alias("filled"))
    return _shown(gates.admission(candidates, there, runs))


_STEPS = "s AS (SELECT n_nationkey AS step, CASE n_nationkey % 4 WHEN 0 THEN 'compose' WHEN 1 THEN NULL ELSE 'atomise' END AS capability, n_nationkey % 9 AS needs, n_nationkey % 6 AS makes FROM nation)"


@query(f"WITH {_STEPS}, m AS (SELECT makes, bool_and(capability = 'compose') AND count(capability) > 0 AS late FROM s WHERE capability IS NOT NULL GROUP BY makes) SELECT 'UNTAGGED' AS code, NULL AS document, step::VARCHAR AS locator, NULL AS detail FROM s WHERE capability IS NULL UNION ALL SELECT 'BACKWARD_EDGE', NULL, step::VARCHAR, 'a' || needs FROM s JOIN m ON m.makes = needs AND late WHERE capability = 'atomise'")
def gate_capability_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as steps; some artifacts come only from steps of the later capability."""
    n = F.col("n_nationkey")
    art = lambda k: F.array(F.concat(F.lit("a"), (n % k).cast("string")))
    capability = F.when(n % 4 == 0, "compose").when(n % 4 == 1, F.lit(None)).otherwise("atomise")
    return _shown(gates.capability_cut(table(spark, sf_dir, "nation", "n_nationkey").select(n.alias("step"), capability.alias("capability"), art(9).alias("consumes"), art(6).alias("produces"))))


@query("SELECT 'DOCUMENT_MISSING' AS code, c_custkey::VARCHAR AS document, NULL AS locator, NULL AS detail FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def verify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as source documents, those with large orders as output."""
    return _shown(gates.documents_missing(table(spark, sf_dir, "customer", "c_custkey").select(_c("c_custkey", "document")), table(spark, sf_dir, "orders", "o_custkey", "o_totalprice").where("o_totalprice > 200000").select(_c("o_custkey", "document")).distinct()))


@query("WITH w AS (SELECT l_orderkey AS d, l_suppkey AS l, count(*) AS n FROM lineitem GROUP BY ALL), g AS (SELECT l_orderkey AS d, l_suppkey AS l, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY ALL), e AS (SELECT l_orderkey AS d, l_suppkey AS l, count(*) AS n FROM lineitem WHERE l_quantity < 5 GROUP BY ALL) SELECT 'FIGURE_LOST' AS code, d::VARCHAR AS document, l::VARCHAR AS locator, w.n || ' ' || coalesce(g.n, 0) || ' ' || coalesce(e.n, 0) AS detail FROM w LEFT JOIN g USING (d, l) LEFT JOIN e USING (d, l) WHERE coalesce(g.n, 0) + coalesce(e.n, 0) < w.n")
def verify_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as figures at their supplier; large ones are in the output, very small ones were declared."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_quantity")
    some = lambda where: rows.where(where).select(_c("l_orderkey", "document"), _c("l_suppkey", "locator"))
    return _shown(gates.figures_lost(some("true"), some("l_quantity > 10"), some("l_quantity < 5")))


@query("SELECT 'FIGURE_DIFFERENT_ASSET' AS code, p_partkey::VARCHAR AS document, p_brand AS locator, 'f' || p_partkey || '.wmf' AS detail FROM part WHERE p_size > 20 AND NOT (p_size > 40 AND p_partkey % 2 = 0)")
def verify_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as figure files; small ones are in the output as they are, some large ones rendered."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size")
    stem = F.concat(F.lit("f"), F.col("p_partkey").cast("string"))
    source = parts.select(_c("p_partkey", "document"), _c("p_brand", "locator"), F.concat(stem, F.lit(".wmf")).alias("file"))
    output = parts.where("p_size <= 20 OR p_size > 40 AND p_partkey % 2 = 0").select(F.concat(stem, F.when(F.col("p_size") > 40, ".render.png").otherwise(".PNG")).alias("file"))
    return _shown(gates.figures_different(source, output))
