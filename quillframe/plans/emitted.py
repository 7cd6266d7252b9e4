"""Queries: word-processor files, the output plan and the control plane, over the supplied tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from quillframe.functions import formulas
from quillframe.operators import aggregates, blueprint, control, sequence, streams
from quillframe.plans.registry import query
from quillframe.sources import docx, docx_build as build
from quillframe.sources.tables import spread, table


def _c(name: str, as_: str) -> Column:
    return F.col(name).alias(as_)


# --- word-processor files: one file per nation, with its suppliers -------------------------------------------------


@F.pandas_udf(BinaryType())
def _nation_file(name: pd.Series, region: pd.Series, suppliers: pd.Series) -> pd.Series:
    """Title, a numbered list of suppliers, a table of them, a picture and a formula; every eighth file is torn."""

    def one(title: str, area: int, rows: list) -> bytes:
        listed = [(int(r["s_suppkey"]), float(r["s_acctbal"])) for r in rows]
        body = [build.paragraph(build.run(title, "b", 'sz w:val="28"'), build.run(f" in {area}")), build.paragraph(build.run("see "), build.picture("p", 914400, 457200), style="Deep")]
        body += [build.paragraph(build.run(f"supplier {k}"), number=(3, k % 2)) for k, _ in listed]
        body += [build.table([[str(k), "rich" if b > 5000 else "poor"] for k, b in listed], "tblBorders")] if listed else []
        body.append(build.paragraph(build.run("area "), "<m:oMath><m:sSup><m:e><m:r><m:t>r</m:t></m:r></m:e><m:sup><m:r><m:t>2</m:t></m:r></m:sup></m:sSup></m:oMath>"))
        styles = '<w:style w:styleId="Base"><w:rPr><w:sz w:val="24"/></w:rPr></w:style><w:style w:styleId="Deep"><w:basedOn w:val="Base"/></w:style>'
        whole = build.build(body, {"p": f"picture {area}".encode()}, {(3, 0): ("decimal", "%1.", 1), (3, 1): ("lowerLetter", "(%2)", 4)}, styles)
        return whole[:40] if title.endswith("7") else whole

    return pd.Series([one(n, int(a), list(s)) for n, a, s in zip(name, region, suppliers)])


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal", "s_nationkey")
    listed = suppliers.groupBy("s_nationkey").agg(F.sort_array(F.collect_list(F.struct("s_suppkey", "s_acctbal"))).alias("rows"))
    nations = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    rows = nations.join(listed, nations["n_nationkey"] == listed["s_nationkey"], "left")
    none = F.array().cast("array<struct<s_suppkey:bigint,s_acctbal:double>>")
    return rows.select(_c("n_name", "source_id"), _nation_file("n_name", "n_regionkey", F.coalesce("rows", none)).alias("content"))


_SUPPLIED = "s AS (SELECT n_name, n_regionkey, s_suppkey, s_acctbal, row_number() OVER (PARTITION BY n_name ORDER BY s_suppkey, s_acctbal) AS k FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE NOT ends_with(n_name, '7')), n AS (SELECT n_name, n_regionkey, (SELECT count(*) FROM s WHERE s.n_name = nation.n_name) AS m FROM nation WHERE NOT ends_with(n_name, '7'))"


@query(
    f"WITH {_SUPPLIED}, b AS (SELECT n_name AS source_id, 'body/p[1]' AS locator, 'paragraph' AS block_type, n_name || ' in ' || n_regionkey AS raw_text FROM n UNION ALL SELECT n_name, 'body/p[2]', 'paragraph', 'see ' FROM n "
    "UNION ALL SELECT n_name, 'body/p[' || (k + 2) || ']', 'paragraph', 'supplier ' || s_suppkey FROM s UNION ALL SELECT n_name, 'body/p[' || (m + 3) || ']', 'paragraph', 'area r2' FROM n UNION ALL SELECT n_name, 'body/tbl[1]', 'table', '' FROM n WHERE m > 0 "
    "UNION ALL SELECT n_name, 'body/tbl[1]/tr[' || k || ']/tc[1]/p[1]', 'table_cell', s_suppkey::VARCHAR FROM s UNION ALL SELECT n_name, 'body/tbl[1]/tr[' || k || ']/tc[2]/p[1]', 'table_cell', CASE WHEN s_acctbal > 5000 THEN 'rich' ELSE 'poor' END FROM s) SELECT * FROM b"
)
def docx_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs, tables and cells of all files, with their locators."""
    return docx.docx_table(_files(spark, sf_dir), "blocks").select("source_id", "locator", "block_type", "raw_text")


@query(f"WITH {_SUPPLIED} SELECT n_name AS source_id, 'body/p[' || (k + 2) || ']' AS locator, CASE WHEN s_suppkey % 2 = 0 THEN row_number() OVER w || '.' ELSE '(' || (row_number() OVER w + 3) || ')' END AS shown, CASE WHEN s_suppkey % 2 = 0 THEN 'decimal' ELSE 'lowerLetter' END AS format FROM s WINDOW w AS (PARTITION BY n_name, s_suppkey % 2 ORDER BY k)")
def docx_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List numbers as they are shown: levels count apart and begin where they are told to."""
    facts = docx.docx_table(_files(spark, sf_dir), "facts").where("layer = 'number'")
    value = lambda k: F.max(F.when(F.col("key") == k, F.col("value"))).alias(k)
    return facts.groupBy("source_id", "locator").agg(value("shown"), value("format"))


@query(f"WITH {_SUPPLIED} SELECT n_name AS source_id, 'body/p[2]' AS locator, 1 AS figure_no, 4 AS char_offset, substr(sha256('picture ' || n_regionkey), 1, 16) AS media_id, 'png' AS ext, 914400::BIGINT AS cx_emu, 457200::BIGINT AS cy_emu, 'inline' AS anchoring, 24 AS body_half_points FROM n")
def docx_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures by content, with the size of the text they stand in, inherited along styles."""
    found = docx.docx_table(_files(spark, sf_dir), "figures")
    return found.select("source_id", "locator", "figure_no", "char_offset", "media_id", "ext", "cx_emu", "cy_emu", "anchoring", F.when(F.col("body_half_points").isNotNull(), 24).alias("body_half_points"))


@query(f"WITH {_SUPPLIED} SELECT n_name AS source_id, 'body/tbl[1]' AS locator, m::INTEGER AS n_rows, 2 AS n_columns, k::INTEGER AS row_no, c::INTEGER AS column_no, CASE c WHEN 1 THEN s_suppkey::VARCHAR ELSE CASE WHEN s_acctbal > 5000 THEN 'rich' ELSE 'poor' END END AS text FROM s JOIN n USING (n_name), (SELECT unnest([1, 2]) AS c)")
def docx_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docx.docx_table(_files(spark, sf_dir), "cells").select("source_id", "locator", "n_rows", "n_columns", "row_no", "column_no", "text")


@query(f"WITH {_SUPPLIED} SELECT n_name AS source_id, 'body/p[1]' AS locator, 1 AS run_no, n_name AS text, true AS bold, 28 AS size FROM n UNION ALL SELECT n_name, 'body/p[1]', 2, ' in ' || n_regionkey, false, NULL FROM n")
def docx_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the titles with their marks."""
    rows = docx.docx_table(_files(spark, sf_dir), "blocks").where("locator = 'body/p[1]'").select("source_id", "locator", F.posexplode("runs").alias("k", "r"))
    return rows.select("source_id", "locator", (F.col("k") + 1).alias("run_no"), "r.text", "r.bold", "r.size")


@query("SELECT n_name AS source_id, 'FILE_UNREADABLE' AS code FROM nation WHERE ends_with(n_name, '7')")
def docx_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that cannot be read."""
    return docx.docx_tables(_files(spark, sf_dir))["diagnostics"].select("source_id", "code")


@query("SELECT p_partkey, rtrim('\\frac{' || p_size || '}{x_{' || (p_partkey % 7) || '}}\\leq ' || CASE WHEN p_size % 2 = 0 THEN '\\alpha ' ELSE '\\sqrt[3]{' || p_size || '\\%}' END) AS latex FROM part")
def formula_latex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulas made from parts, as LaTeX."""
    t = lambda x: F.concat(F.lit("<m:r><m:t>"), x, F.lit("</m:t></m:r>"))
    e = lambda name, x: F.concat(F.lit(f"<m:{name}>"), x, F.lit(f"</m:{name}>"))
    size, k = F.col("p_size").cast("string"), (F.col("p_partkey") % 7).cast("string")
    fraction = e("f", F.concat(e("num", t(size)), e("den", e("sSub", F.concat(e("e", t(F.lit("x"))), e("sub", t(k)))))))
    root = e("rad", F.concat(e("deg", t(F.lit("3"))), e("e", t(F.concat(size, F.lit("%"))))))
    whole = F.concat(F.lit(f'<m:oMath xmlns:m="{build.NAMESPACES["m"]}">'), fraction, t(F.lit("≤")), F.when(F.col("p_size") % 2 == 0, t(F.lit("α"))).otherwise(root), F.lit("</m:oMath>"))
    return spread(table(spark, sf_dir, "part", "p_partkey", "p_size")).select("p_partkey", formulas.omml_to_latex(whole).alias("latex"))


@query("SELECT n_regionkey, 1::BIGINT AS n_contents, count(*) AS n_archives FROM nation GROUP BY 1")
def deterministic_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive per nation of its region's parts: the same bytes wherever they are packed."""
    nations = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    parts = nations.select("n_nationkey", "n_regionkey", F.inline(F.array(*(F.struct(F.concat(F.lit(f"part{k}."), F.col("n_regionkey").cast("string")).alias("name"), F.encode(F.repeat(F.col("n_regionkey").cast("string"), F.lit(100 * k)), "UTF-8").alias("content")) for k in (2, 1, 3)))))
    return control.archives(parts, "n_nationkey", "n_regionkey").groupBy("n_regionkey").agg(F.countDistinct("digest").alias("n_contents"), F.count("*").alias("n_archives"))


# --- figures, arrows, transcriptions -----------------------------------------------------------------------------


@query("SELECT l_orderkey AS document, l_suppkey AS ordinal, list(CASE WHEN l_returnflag = 'A' THEN '——→' ELSE '——' || l_returnflag || '→' END ORDER BY l_linenumber, l_partkey)::VARCHAR AS arrows FROM lineitem WHERE l_quantity < 25 GROUP BY ALL")
def shape_arrows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small lines as drawn arrows, their flag as the condition; A has none."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    figures = rows.select(_c("l_orderkey", "document"), _c("l_suppkey", "ordinal"), (F.col("l_linenumber").cast("long") * 10**9 + F.col("l_partkey")).alias("figure_no"), F.when(F.col("l_quantity") < 25, "arrow").otherwise("shape").alias("shape"), F.when(F.col("l_returnflag") != "A", F.concat(F.lit(" "), "l_returnflag")).alias("condition"))
    return streams.shape_arrows(figures).select("document", "ordinal", _listed("arrows"))


def _listed(name: str) -> Column:
    """A list as SQL shows it."""
    return F.concat(F.lit("["), F.array_join(name, ", "), F.lit("]")).alias(name)


@query("SELECT l_orderkey AS document, list('——' || l_shipdate_ || '→' ORDER BY x, l_linenumber, l_partkey)::VARCHAR AS arrows FROM (SELECT *, l_partkey % 50 AS x, 'c' || l_suppkey AS l_shipdate_ FROM lineitem WHERE l_suppkey % 3 = 0 AND l_linestatus = 'F') GROUP BY ALL")
def picture_arrows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as small pictures, a third of them registered, floating ones from left to right."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_linestatus")
    figures = rows.select(_c("l_orderkey", "document"), F.lit(1).alias("ordinal"), (F.col("l_linenumber").cast("long") * 10**9 + F.col("l_partkey")).alias("figure_no"), _c("l_suppkey", "media_id"), F.when(F.col("l_linestatus") == "F", F.col("l_partkey") % 50).alias("anchor_x"), F.lit("picture").alias("kind"))
    registered = table(spark, sf_dir, "supplier", "s_suppkey").where("s_suppkey % 3 = 0").select(_c("s_suppkey", "media_id"), F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("condition"))
    return streams.picture_arrows(figures, registered)[0].select("document", _listed("arrows"))


@query("SELECT o_orderkey AS document, CASE WHEN o_orderstatus = 'F' THEN 'left——→' ELSE 'left  ' END || o_orderpriority AS text, (o_orderstatus = 'F')::INTEGER AS n_placed FROM orders")
def place_arrows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders have an arrow for the wide gap in their line."""
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    arrows = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("——→"))).otherwise(F.array().cast("array<string>"))
    blocks = rows.select(_c("o_orderkey", "document"), F.lit(1).cast("long").alias("ordinal"), F.concat(F.lit("left  "), "o_orderpriority").alias("text"), arrows.alias("arrows"))
    return streams.place_arrows(blocks).select("document", "text", "n_placed")


@query("WITH r AS (SELECT l_orderkey AS d, unnest([0, 1, 2]) AS pos, unnest(['12345', '', l_returnflag || 'xyz']) AS t FROM (SELECT DISTINCT ON (l_orderkey) l_orderkey, l_returnflag FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)), f AS (SELECT DISTINCT l_orderkey AS d, (l_linenumber % 8)::BIGINT AS off FROM lineitem) SELECT d AS document, off AS \"begin\", 'figure' AS kind, NULL AS text FROM f WHERE off <= 99 UNION ALL SELECT d, b, 'text', substr(whole, b + 1, e - b) FROM (SELECT d, whole, b, lead(b, 1, 9) OVER (PARTITION BY d ORDER BY b) AS e FROM (SELECT DISTINCT d, whole, unnest(list_concat([0, 5], cuts))::BIGINT AS b FROM (SELECT d, string_agg(t, '' ORDER BY pos) AS whole, (SELECT list(DISTINCT off) FROM f WHERE f.d = r.d AND off > 0 AND off < 9) AS cuts FROM r GROUP BY d))) UNION ALL SELECT d, 5, 'text', '' FROM r WHERE pos = 1")
def merged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of an order (one of them empty) cut where its lines, as figures, stand."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    first = lines.groupBy("l_orderkey").agg(F.min_by("l_returnflag", F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("flag"))
    runs = first.select(_c("l_orderkey", "document"), F.lit(1).alias("block"), F.posexplode(F.array(F.lit("12345"), F.lit(""), F.concat("flag", F.lit("xyz")))).alias("pos", "text"))
    figures = lines.select(_c("l_orderkey", "document"), F.lit(1).alias("block"), (F.col("l_linenumber") % 8).cast("int").alias("offset")).distinct().withColumn("figure", F.lit("f"))
    return streams.merged(runs, figures).select("document", "begin", "kind", "text")


@query("SELECT o_orderkey AS document, CASE WHEN o_custkey % 2 = 0 THEN 'ab' || 'X' || o_custkey || 'cd' || CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE '' END ELSE 'abcd' END AS text FROM orders")
def transcribed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered texts of embedded objects at their offsets, two in one block for finished orders."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    blocks = orders.select(_c("o_orderkey", "document"), F.lit(1).alias("ordinal"), F.lit("abcd").alias("text"))
    twice = F.array(F.struct(F.col("o_custkey").cast("string").alias("media_id"), F.lit(2).alias("offset")), F.struct(F.when(F.col("o_orderstatus") == "F", "y").otherwise("none").alias("media_id"), F.lit(4).alias("offset")))
    references = orders.where("o_custkey % 2 = 0").select(_c("o_orderkey", "document"), F.lit(1).alias("ordinal"), F.inline(twice))
    customers = table(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").cast("string").alias("media_id"), F.concat(F.lit("X"), F.col("c_custkey").cast("string")).alias("text"))
    return streams.transcribed(blocks, references, customers.unionByName(spark.createDataFrame([("y", "Y")], "media_id string, text string"))).select("document", "text")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 4 = 0 THEN l_partkey + 1 ELSE l_partkey END AS shown_id FROM lineitem")
def rendered_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth part's metafile has a raster."""
    figures = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").withColumn("media_id", F.col("l_partkey"))
    substitutes = table(spark, sf_dir, "part", "p_partkey").where("p_partkey % 4 = 0").select(_c("p_partkey", "media_id"), (F.col("p_partkey") + 1).alias("raster_id"))
    return streams.rendered(figures, substitutes).select("l_orderkey", "l_linenumber", "l_partkey", "shown_id")


@query("WITH f AS (SELECT l_orderkey AS document, l_suppkey, substr(sha256(l_suppkey::VARCHAR), 1, 16) AS media, (l_linenumber * 1000000000::BIGINT + l_partkey) * 100000 + l_suppkey AS no FROM lineitem) SELECT document, arg_min('label ' || l_suppkey, no) AS label, arg_min('caption ' || (l_suppkey % 7), no) AS caption FROM f WHERE l_suppkey % 5 = 0 GROUP BY document")
def image_banners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures of every fifth supplier are registered banners; the first in an order counts."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")
    digest = lambda c: F.substring(F.sha2(F.col(c).cast("string"), 256), 1, 16)
    figures = lines.select(_c("l_orderkey", "document"), F.lit(1).alias("ordinal"), digest("l_suppkey").alias("media_id"), ((F.col("l_linenumber").cast("long") * 10**9 + F.col("l_partkey")) * 100000 + F.col("l_suppkey")).alias("figure_no"))
    key = F.col("s_suppkey")
    registered = table(spark, sf_dir, "supplier", "s_suppkey").where(key % 5 == 0).select(F.substring(digest("s_suppkey"), 1, 12).alias("banner_id"), F.concat(F.lit("label "), key.cast("string")).alias("label"), F.concat(F.lit("caption "), (key % 7).cast("string")).alias("caption"))
    return streams.image_banners(figures, registered).select("document", "label", "caption")


@query("SELECT o_orderkey AS document, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE 'plain' END AS text, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_banner FROM orders")
def banner_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text boxes with a declared banner give their paragraph its text."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    blocks = orders.select(_c("o_orderkey", "document"), F.lit(1).alias("ordinal"), F.lit("plain").alias("text"))
    boxes = orders.select(_c("o_orderkey", "document"), F.lit(1).alias("ordinal"), F.lit(1).alias("box"), F.concat(F.lit(" "), "o_orderpriority").alias("text"))
    return streams.banner_paragraphs(blocks, boxes, spark.createDataFrame([("1-URGENT",), ("2-HIGH",)], "banner string"))[0].select("document", "text", "is_banner")


@query("WITH s AS (SELECT c_nationkey AS source_id, c_custkey AS start, lead(c_custkey, 1, 1000000000) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS stop FROM customer WHERE c_mktsegment = 'BUILDING') SELECT c.c_custkey, s.start AS document FROM customer c JOIN s ON s.source_id = c.c_nationkey AND c.c_custkey >= s.start AND c.c_custkey < s.stop")
def sliced_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of a nation, cut into documents where one of a segment stands."""
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    blocks = customers.select(_c("c_nationkey", "source_id"), _c("c_custkey", "ordinal"))
    following = F.lead("c_custkey", 1, 1000000000).over(sequence.over("c_nationkey", order="c_custkey"))
    spans = customers.where("c_mktsegment = 'BUILDING'").select(_c("c_nationkey", "source_id"), _c("c_custkey", "start"), following.alias("end"), _c("c_custkey", "document"))
    return streams.sliced(blocks, spans).select(_c("ordinal", "c_custkey"), "document")


@query("SELECT l_partkey AS media_id, arg_min(l_orderkey, o) AS document, count(*) AS n_uses, format('{:.1f}x{:.1f}', arg_min(l_suppkey, o) * 36000 / 360000.0, 2.0) AS display_cm FROM (SELECT *, l_orderkey * 1000000000::BIGINT + l_linenumber * 100000000 + l_suppkey AS o FROM lineitem) GROUP BY 1")
def figure_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as pictures: first place, size and uses."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    figures = rows.select(_c("l_partkey", "media_id"), _c("l_orderkey", "document"), _c("l_linenumber", "ordinal"), _c("l_suppkey", "figure_no"), (F.col("l_suppkey") * 36000).alias("cx_emu"), F.lit(720000).alias("cy_emu"))
    return streams.figure_catalogue(figures).select("media_id", "document", "n_uses", "display_cm")


# --- the output plan ---------------------------------------------------------------------------------------------


@query("WITH e AS (SELECT l_suppkey AS source, l_partkey AS object, l_orderkey * 100::BIGINT + l_linenumber AS ordinal, unnest([l_returnflag || l_orderkey % 40, l_linestatus || l_orderkey % 25]) AS locator, unnest([0, 1]) AS pos FROM lineitem) SELECT source, locator, arg_min(object, ordinal * 10000000000::HUGEINT + object * 10 + pos) AS object FROM e GROUP BY source, locator")
def object_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects by their canonical and their further locator; the first one wins."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    order = F.col("l_orderkey")
    objects = rows.select(_c("l_suppkey", "source"), _c("l_partkey", "object"), F.struct((order * 100 + F.col("l_linenumber")).alias("o"), F.col("l_partkey").alias("object")).alias("ordinal"), F.concat("l_returnflag", (order % 40).cast("string")).alias("locator"), F.array(F.concat("l_linestatus", (order % 25).cast("string"))).alias("locators"))
    return blueprint.object_index(objects)


@query("WITH w AS (SELECT l_suppkey AS source, l_partkey AS object, l_linenumber AS precedence, l_orderkey AS ordinal, l_orderkey * 10 + l_linenumber AS block FROM lineitem), f AS (SELECT source, object, arg_min(block, precedence * 10000000000::BIGINT * 100 + ordinal * 100 + block % 10) AS owner FROM w GROUP BY 1, 2) SELECT source, object, block, owner, CASE WHEN object % 9 = 0 THEN 'unbound' WHEN owner = block THEN 'owned' ELSE 'ignored' END AS status FROM w JOIN f USING (source, object)")
def claimed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines claim parts of a supplier; the first by precedence owns one, every ninth part is missing."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    wanted = rows.select(_c("l_suppkey", "source"), _c("l_partkey", "object"), _c("l_linenumber", "precedence"), _c("l_orderkey", "ordinal"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("block"))
    objects = rows.where("l_partkey % 9 <> 0").select(_c("l_suppkey", "source"), _c("l_partkey", "object")).distinct()
    return blueprint.claims(wanted, objects).select("source", "object", "block", "owner", "status")


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'block' WHEN p_size < 30 AND (p_partkey % 2 = 0 OR p_partkey % 3 = 0) THEN 'carrier' ELSE 'exclusion' END AS disposition, CASE WHEN p_size < 10 OR p_size < 30 AND (p_partkey % 2 = 0 OR p_partkey % 3 = 0) THEN NULL WHEN p_size < 30 THEN 'artwork' WHEN p_size > 40 THEN 'spacer' ELSE 'carrier' END AS exclusion_class FROM part")
def object_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, size = F.col("p_partkey"), F.col("p_size")
    rows = table(spark, sf_dir, "part", "p_partkey", "p_size").select("p_partkey", (size < 10).alias("printed"), (size < 30).alias("is_shape"), (p % 2 == 0).alias("has_box"), (p % 3 == 0).alias("has_image"), F.when(size > 40, " ").otherwise("text").alias("text"))
    return blueprint.dispositions(rows).select("p_partkey", "disposition", "exclusion_class")


@query("SELECT p_partkey, sha256(p_name) AS source_sha256, p_brand AS locator, round(p_size * 36000 / 36000.0 * 10 / coalesce(CASE WHEN p_partkey % 2 = 0 THEN 8 END, CASE WHEN p_partkey % 3 = 0 THEN 10 END, 12), 2) AS width_mm, split_part(p_name, ' ', 1) AS label, trim(substr(p_name, length(split_part(p_name, ' ', 1)) + 1)) AS caption, CASE WHEN p_partkey % 5 <> 0 THEN round(p_size * 10 / 8.0, 2) END AS row_height FROM part")
def block_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance, figure width, heading slots and row height of parts as blocks."""
    p = F.col("p_partkey")
    rows = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size")
    width = blueprint.figure_width(F.col("p_size") * 36000, F.lit(10), F.when(p % 2 == 0, 8), F.when(p % 3 == 0, 10))
    height = blueprint.row_height(F.col("p_size"), F.lit(10), F.lit(8), F.when(p % 5 != 0, "exact"))
    rows = rows.withColumns({"source": blueprint.provenance(F.sha2("p_name", 256), F.col("p_brand")), "slots": blueprint.heading_slots(F.col("p_name")), "width_mm": width, "row_height": height})
    return rows.select("p_partkey", "source.source_sha256", "source.locator", "width_mm", "slots.label", "slots.caption", "row_height")


@query("WITH b AS (SELECT l_orderkey AS source, l_linenumber * 1000000000::BIGINT + l_partkey AS locator, l_suppkey % 3 AS document, l_returnflag || l_suppkey AS text FROM lineitem) SELECT source, locator, CASE WHEN text IN (SELECT 'N' || s_suppkey FROM supplier WHERE s_suppkey % 2 = 0) THEN 'exclusion' ELSE 'block' END AS disposition FROM b WHERE (source, locator) NOT IN (SELECT l_orderkey, l_linenumber * 1000000000::BIGINT + l_partkey FROM lineitem WHERE l_quantity > 30)")
def swept_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unclaimed boxes: blocks, unless their document prints the text already."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    place = (F.col("l_linenumber").cast("long") * 10**9 + F.col("l_partkey")).alias("locator")
    boxes = rows.select(_c("l_orderkey", "source"), place, (F.col("l_suppkey") % 3).alias("document"), F.concat("l_returnflag", F.col("l_suppkey").cast("string")).alias("text"))
    printed = table(spark, sf_dir, "supplier", "s_suppkey").where("s_suppkey % 2 = 0").select((F.col("s_suppkey") % 3).alias("document"), F.concat(F.lit(" N"), F.col("s_suppkey").cast("string")).alias("text"))
    return blueprint.sweep_boxes(boxes, rows.where("l_quantity > 30").select(_c("l_orderkey", "source"), place), printed).select("source", "locator", "disposition")


@query("SELECT l_orderkey AS source, l_linenumber::VARCHAR AS locator, l_partkey AS shape_no, CASE WHEN l_suppkey % 2 = 0 THEN 'text box' ELSE 'artwork' END AS reason FROM lineitem WHERE (l_orderkey, l_linenumber, l_partkey) NOT IN (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount > 0.05)")
def swept_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes that no line with a discount claims are carried."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount")
    shapes = rows.select(_c("l_orderkey", "source"), F.col("l_linenumber").cast("string").alias("locator"), _c("l_partkey", "shape_no"), (F.col("l_suppkey") % 2 == 0).alias("has_box"), "l_discount")
    return blueprint.sweep_shapes(shapes.drop("l_discount"), shapes.where("l_discount > 0.05")).select("source", "locator", "shape_no", "reason")


@query("SELECT l_orderkey AS document, l_linenumber, l_partkey, d AS disposition, row_number() OVER (PARTITION BY l_orderkey, d ORDER BY l_linenumber, l_partkey, l_suppkey) AS running FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'transcribed' WHEN l_linestatus = 'O' THEN 'shape' WHEN l_quantity < 10 THEN 'dropped' ELSE 'kept' END AS d FROM lineitem)")
def figure_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity")
    figures = rows.select(_c("l_orderkey", "document"), "l_linenumber", "l_partkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ordinal"), (F.col("l_returnflag") == "R").alias("transcribed"), F.when(F.col("l_linestatus") == "O", "line").otherwise("picture").alias("shape"), (F.col("l_quantity") >= 10).alias("keep"))
    return blueprint.figure_dispositions(figures).select("document", "l_linenumber", "l_partkey", "disposition", F.col("running").cast("long").alias("running"))


@query("SELECT o_custkey AS document, arg_min(o_orderpriority, o_orderkey) AS title, min(o_orderkey) AS ordinal FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def document_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")
    blocks = rows.select(_c("o_custkey", "document"), _c("o_orderkey", "ordinal"), F.lit("p").alias("locator"), _c("o_orderpriority", "text"), F.when(F.col("o_orderstatus") == "F", "title").otherwise("body").alias("kind"))
    return blueprint.titles(blocks).select("document", "title", "evidence.ordinal")


@query("SELECT c_nationkey AS volume, min(c_custkey) AS ordinal, c_mktsegment AS theme FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY ALL")
def theme_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer", "c_nationkey", "c_custkey", "c_mktsegment").select(_c("c_nationkey", "volume"), _c("c_custkey", "ordinal"), _c("c_mktsegment", "theme"))
    return blueprint.theme_chapters(rows).select("volume", "ordinal", "theme")


@query("SELECT l_orderkey AS document, l_linenumber, l_partkey, CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) = 1 THEN 'title' ELSE 'body' END AS part FROM lineitem")
def callout_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").select(_c("l_orderkey", "document"), "l_linenumber", "l_partkey", _c("l_returnflag", "callout"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ordinal"))
    return blueprint.callout(rows).select("document", "l_linenumber", "l_partkey", "part")


@query("WITH e AS (SELECT l_suppkey AS t, l_orderkey * 10 + l_linenumber AS cell, unnest(['top', 'tl2br']) AS edge, unnest([l_returnflag, l_linestatus]) AS value FROM (SELECT DISTINCT ON (l_suppkey, l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_suppkey, l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus)), n AS (SELECT t, edge, value, count(*) AS n FROM e GROUP BY ALL), u AS (SELECT t, edge, arg_max(value, n * 1000 + ascii(value)) AS usual FROM n GROUP BY ALL) SELECT e.t AS \"table\", cell, e.edge, value FROM e JOIN u ON u.t = e.t AND u.edge = e.edge WHERE value <> usual OR e.edge = 'tl2br'")
def own_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of cells that differ from their table's usual ones, and all diagonals."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    first = rows.groupBy(_c("l_suppkey", "table"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("cell")).agg(F.min(F.struct("l_partkey", "l_returnflag", "l_linestatus")).alias("f"))
    return blueprint.own_edges(first.select("table", "cell", F.create_map(F.lit("top"), F.col("f.l_returnflag"), F.lit("tl2br"), F.col("f.l_linestatus")).alias("edges")))


@query("SELECT l_orderkey AS question, k // 3 AS row_no, string_agg(l_partkey::VARCHAR, ' ' ORDER BY k) AS cells, array_to_string(list_sort(list(DISTINCT l_linenumber)), ' ') AS source_rows FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS k FROM lineitem) GROUP BY 1, 2")
def option_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as options, three in a row, with the rows they come from."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    options = rows.select(F.lit(1).alias("document"), _c("l_orderkey", "question"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ordinal"), F.col("l_partkey").cast("string").alias("text"), _c("l_linenumber", "source_row"), F.lit(3).alias("columns"))
    return blueprint.option_rows(options).select("question", "row_no", F.array_join("cells", " ").alias("cells"), F.array_join("source_rows", " ").alias("source_rows"))


@query("WITH l AS (SELECT o_orderkey, o_custkey % 5 AS k, o_orderstatus || CASE o_custkey % 5 WHEN 0 THEN '+B——heat→C' WHEN 1 THEN '——→B+C' WHEN 2 THEN '→B' WHEN 3 THEN '+B→C+D' ELSE ' nothing' END AS text FROM orders) SELECT o_orderkey, CASE WHEN k = 2 THEN 'skipped' ELSE 'reaction' END AS status, CASE WHEN o_orderkey % 10 = 0 THEN 'exchange' WHEN k = 0 THEN 'combination' WHEN k = 1 THEN 'decomposition' ELSE 'neither' END AS kind, CASE WHEN o_orderkey % 10 = 0 THEN 'adjudicated' ELSE 'counts' END AS basis FROM l WHERE k <> 4")
def reaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reactions in lines made from orders; kinds by their terms, some decided by a person."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    k = F.col("o_custkey") % 5
    end = F.when(k == 0, "+B——heat→C").when(k == 1, "——→B+C").when(k == 2, "→B").when(k == 3, "+B→C+D").otherwise(" nothing")
    lines = orders.select(_c("o_orderkey", "document"), F.lit(1).alias("ordinal"), F.concat("o_orderstatus", end).alias("text"))
    decided = orders.where("o_orderkey % 10 = 0").select(_c("o_orderkey", "document"), F.lit(1).alias("ordinal"), F.lit("exchange").alias("kind"))
    return blueprint.reactions(lines, decided).select(_c("document", "o_orderkey"), "status", "kind", "basis")


_SEGMENTS = "g AS (SELECT l_orderkey AS document, l_linenumber AS block, l_partkey AS media_id, l_orderkey || ':' || l_linenumber || ':' || l_partkey AS object, l_returnflag AS text FROM lineitem)"


def _segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").select(_c("l_orderkey", "document"), _c("l_linenumber", "block"), _c("l_partkey", "media_id"), F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey").alias("object"), _c("l_returnflag", "text"))
    registered = table(spark, sf_dir, "part", "p_partkey", "p_size", "p_brand").where("p_size > 30").select(_c("p_partkey", "media_id"), _c("p_brand", "replacement"))
    return blueprint.substitutions(rows, registered)


@query(f"WITH {_SEGMENTS} SELECT document, block, g.media_id, coalesce(p_brand, text) AS final FROM g LEFT JOIN part ON p_partkey = g.media_id AND p_size > 30")
def substituted_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large parts are registered: lines that hold them print the brand."""
    return _segments(spark, sf_dir)[0].select("document", "block", "media_id", "final")


@query(f"WITH {_SEGMENTS}, u AS (SELECT document, media_id, min(block) AS first, count(DISTINCT block) AS n FROM g JOIN part ON p_partkey = media_id AND p_size > 30 GROUP BY 1, 2), c AS (SELECT DISTINCT document, media_id, object FROM g) SELECT c.document, c.object, coalesce(first, -1)::INTEGER AS owner, coalesce(n, 0) AS n_blocks FROM c LEFT JOIN u ON u.document = c.document AND u.media_id = c.media_id")
def transferred_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims on replaced parts go to the first block that prints the replacement; others stay."""
    done = _segments(spark, sf_dir)[0]
    claims = done.select("document", "media_id", "object", F.lit(-1).alias("owner"))
    return blueprint.transferred(done, claims).select("document", "object", F.col("owner").cast("int").alias("owner"), "n_blocks")


@query("WITH s AS (SELECT l_orderkey AS d, l_linenumber * 1000000000::BIGINT + l_partkey AS pos, l_returnflag AS file, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) AS nth FROM lineitem WHERE l_linestatus = 'F'), g AS (SELECT l_orderkey AS d, l_returnflag AS file, l_suppkey || '/' || l_partkey || '/' || l_linenumber AS figure, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_suppkey || '/' || l_partkey || '/' || l_linenumber) AS nth FROM lineitem WHERE l_quantity > 20) SELECT coalesce(s.d, g.d) AS document, s.pos IS NOT NULL AS in_place, figure FROM s FULL JOIN g ON s.d = g.d AND s.file = g.file AND s.nth = g.nth")
def bound_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures in streams take figures of their file one by one; figures left over come at the end."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity")
    place = F.col("l_linenumber").cast("long") * 10**18 + F.col("l_partkey") * 10**9 + F.col("l_suppkey")
    both = lambda where: rows.where(where).withColumns({"document": F.col("l_orderkey"), "block": F.lit(1), "file": F.col("l_returnflag")})
    streams_ = both("l_linestatus = 'F'").select("document", "block", place.alias("pos"), F.lit("picture").alias("kind"), F.lit("").alias("text"), "file")
    figures = both("l_quantity > 20").select("document", "block", "file", F.concat_ws("/", "l_suppkey", "l_partkey", "l_linenumber").alias("figure"))
    return blueprint.segments(streams_, figures).select("document", (F.col("pos") != 2**30).alias("in_place"), "figure")


@query(
    "WITH f AS (SELECT l_orderkey AS d, l_linenumber AS r, l_partkey AS no, l_suppkey % 2 = 0 AS pictured, 'f' || l_partkey AS file FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)), c AS (SELECT l_orderkey AS d, l_linenumber AS r, min(l_returnflag) AS flag FROM lineitem GROUP BY ALL) "
    "SELECT c.d AS document, c.r AS row_no, concat_ws(' ', CASE WHEN flag <> 'N' THEN flag END, (SELECT string_agg(file, ' ' ORDER BY no) FROM f WHERE f.d = c.d AND f.r = c.r AND pictured)) AS segments FROM c"
)
def table_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tables of one column: words, then pictures, or one empty segment."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    at = [_c("l_orderkey", "document"), F.lit(1).alias("table"), _c("l_linenumber", "row_no"), F.lit(1).alias("column_no")]
    cells = rows.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("flag")).select(*at, F.lit(1).alias("grid_span"), F.lit(None).cast("string").alias("v_merge"), F.lit(None).cast("string").alias("v_align"), F.array(F.when(F.col("flag") == "N", "").otherwise(F.col("flag"))).alias("paragraphs"))
    figures = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct().select(*at, _c("l_partkey", "figure_no"), F.concat(F.lit("f"), F.col("l_partkey").cast("string")).alias("file"), F.when(F.col("l_suppkey") % 2 == 0, "picture").otherwise("shape").alias("kind"))
    listed = spark.createDataFrame([], "document long, table int, image_no long")
    tables, _ = blueprint.table_blocks(cells, figures, listed)
    each = tables.select("document", F.inline("rows")).select("document", "row_no", F.inline("cells"))
    return each.select("document", "row_no", F.array_join("segments", " ").alias("segments"))


@query("WITH n AS (SELECT l_orderkey AS d, count(*) FILTER (WHERE l_suppkey % 2 = 0) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem) GROUP BY 1) SELECT d AS document, k::BIGINT AS image_no FROM n, (SELECT unnest(range(1, 6)) AS k) WHERE k > n")
def unclaimed_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of five images a table lists, those that no cell claims."""
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    at = [_c("l_orderkey", "document"), F.lit(1).alias("table"), _c("l_linenumber", "row_no"), F.lit(1).alias("column_no")]
    figures = rows.distinct().select(*at, F.struct("l_partkey", "l_suppkey").alias("figure_no"), F.lit("f").alias("file"), F.when(F.col("l_suppkey") % 2 == 0, "picture").otherwise("shape").alias("kind"))
    cells = figures.select("document", "table", "row_no", "column_no").distinct().withColumns({"grid_span": F.lit(1), "v_merge": F.lit(None).cast("string"), "v_align": F.lit(None).cast("string"), "paragraphs": F.array(F.lit("x"))})
    listed = rows.select("l_orderkey").distinct().select(_c("l_orderkey", "document"), F.lit(1).alias("table"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(5).cast("long"))).alias("image_no"))
    return blueprint.table_blocks(cells, figures, listed)[1].select("document", "image_no")


# --- aggregates and sequences that had no query ------------------------------------------------------------------


@query("SELECT l_suppkey, v AS l_linenumber, n FROM (SELECT l_suppkey, l_linenumber AS v, count(*) AS n, min(l_orderkey) AS f, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, min(l_orderkey), l_linenumber) AS k FROM lineitem GROUP BY 1, 2) WHERE k = 1")
def plain_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's most frequent line number, every line counted once."""
    return aggregates.plain_mode(table(spark, sf_dir, "lineitem", "l_suppkey", "l_linenumber", "l_orderkey"), "l_suppkey", value="l_linenumber", place="l_orderkey")


@query("SELECT l_suppkey, max(n) AS \"limit\", count(*) AS n_origins FROM (SELECT l_suppkey, l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1")
def origin_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most lines of a supplier in any one order."""
    return aggregates.origin_limit(table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey"), "l_orderkey", "l_suppkey")


@query("SELECT o_custkey, o_orderkey, 'carrier' AS exclusion_class FROM (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders) WHERE before = o_orderpriority")
def repeated_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that are not printed again, as exclusions."""
    rows = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderpriority").withColumn("ordinal", F.col("o_orderkey"))
    return sequence.printed_once(rows, "o_custkey", title="o_orderpriority")[1].select("o_custkey", "o_orderkey", "exclusion_class")


@query("WITH e AS (SELECT user_id, event_id, event_type, CASE WHEN event_id % 4 = 0 THEN event_type END AS cond FROM events) SELECT user_id, event_id, event_id % 3 <> 0 AND coalesce(event_type IN (lag(cond, 1) OVER w, lag(cond, 2) OVER w, lead(cond, 1) OVER w, lead(cond, 2) OVER w), false) AS carrier FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def reclaimed_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that hold nothing but a condition of an arrow near by."""
    rows = table(spark, sf_dir, "events", "user_id", "event_id", "event_type")
    blocks = rows.select("user_id", "event_id", _c("event_id", "ordinal"), _c("event_type", "text"), (F.col("event_id") % 3 != 0).alias("is_body"), F.lit(True).alias("in_box"), F.when(F.col("event_id") % 4 == 0, F.array(F.concat(F.lit(" "), "event_type"))).alias("conditions"))
    return sequence.reclaimed(blocks, "user_id").select("user_id", "event_id", "carrier")


@query("WITH r AS (SELECT o_custkey, o_orderkey, unnest([0, 1]) AS run_no, unnest([o_orderpriority, o_orderstatus]) AS text, unnest([true, false]) AS bold FROM orders), s AS (SELECT *, sum(length(text)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey, run_no ROWS UNBOUNDED PRECEDING) AS stop FROM r), b AS (SELECT *, stop - length(text) AS start FROM s) SELECT o_custkey, o_orderkey, run_no::INTEGER AS run_no, bold, substr(text, (greatest(4, start) - start + 1)::BIGINT, (least(30, stop) - greatest(4, start))::BIGINT) AS part FROM b WHERE start < 30 AND stop > 4")
def run_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters 4 to 30 of each customer's orders as runs, marks kept."""
    rows = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")
    run = lambda c, bold: F.struct(F.col(c).alias("text"), F.lit(bold).alias("bold"))
    runs = rows.select("o_custkey", _c("o_orderkey", "ordinal"), F.array(run("o_orderpriority", True), run("o_orderstatus", False)).alias("runs"))
    return sequence.run_slice(runs, 4, 30, "o_custkey").select("o_custkey", _c("ordinal", "o_orderkey"), "run_no", "run.bold", _c("run.text", "part"))


# --- the control plane -------------------------------------------------------------------------------------------


@query(
    "WITH s AS (SELECT c_custkey AS step, CASE WHEN c_nationkey = 1 THEN 'human' END AS runner, CASE WHEN c_nationkey > 3 THEN 'run' END AS command, CASE WHEN c_nationkey = 2 THEN 'flow' END AS entry, (c_custkey % 13 = 0)::INT AS code, c_custkey % 5 = 0 AS changed FROM customer), "
    "i AS (SELECT o_custkey AS step, bool_or(o_orderstatus = 'P' AND o_orderkey % 3 <> 0) AS lacking, bool_or(o_orderstatus <> 'P' AND o_totalprice > 400000) AS drifted FROM orders GROUP BY 1) "
    "SELECT s.step, CASE WHEN lacking THEN 'blocked' WHEN drifted THEN 'HOLD_INPUT_DRIFT' WHEN runner = 'human' THEN CASE WHEN s.step % 2 = 0 THEN 'satisfied' ELSE 'awaiting-human' END WHEN command IS NULL THEN CASE WHEN entry IS NOT NULL THEN 'external-runner' ELSE 'no-runner' END WHEN code <> 0 THEN 'failed' ELSE 'ok' END AS status, changed AND s.step % 2 = 0 AS code_drift FROM s LEFT JOIN i USING (step)"
)
def step_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as steps, their orders as inputs; all statuses but that of a dry run occur."""
    k = F.col("c_custkey")
    steps = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey").select(k.alias("step"), F.when(F.col("c_nationkey") == 1, "human").alias("runner"), F.when(F.col("c_nationkey") > 3, "run").alias("command"), F.when(F.col("c_nationkey") == 2, "flow").alias("external_entry"), F.when(k % 13 == 0, 1).otherwise(0).alias("return_code"), F.lit("a").alias("code_then"), F.when(k % 5 == 0, "b").otherwise("a").alias("code_now"))
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    inputs = orders.select(_c("o_custkey", "step"), F.col("o_orderkey").cast("string").alias("artifact"), F.lit("x").alias("ran_with"), F.when(F.col("o_orderstatus") != "P", F.when(F.col("o_totalprice") > 400000, "y").otherwise("x")).alias("now"), (F.col("o_orderkey") % 3 == 0).alias("optional"))
    outputs = steps.select("step", F.lit("out").alias("artifact"), (F.col("step") % 2 == 0).alias("there"))
    return control.step_status(steps, inputs, outputs).select("step", "status", "code_drift")


@query("SELECT l_orderkey AS step, l_partkey AS artifact, l_linenumber AS generation FROM lineitem WHERE l_returnflag <> 'N' AND (l_partkey, l_linenumber) NOT IN (SELECT l_partkey, l_linenumber FROM lineitem WHERE l_returnflag = 'N') AND (l_partkey, l_linenumber) NOT IN (SELECT p_partkey, 1 FROM part)")
def dangling_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that lines consume, in a generation that no line makes and that is not external."""
    edges = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag").select(_c("l_orderkey", "step"), _c("l_partkey", "artifact"), _c("l_linenumber", "generation"), F.when(F.col("l_returnflag") == "N", "out").otherwise("in").alias("direction"))
    external = table(spark, sf_dir, "part", "p_partkey").select(_c("p_partkey", "artifact"), F.lit(1).alias("generation"))
    return control.dangling(edges, external).select("step", "artifact", "generation")


@query("SELECT o_custkey AS artifact, o_orderkey AS step, 'UNKNOWN_ID' AS problem FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL SELECT c_custkey, NULL, 'UNBOUND_EXTERNAL' FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 2 = 0")
def unknown_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders name customers; those in debt are not declared, half of a segment has no binding."""
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    named = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey").select(_c("o_custkey", "artifact"), _c("o_orderkey", "step"))
    external = customers.where("c_mktsegment = 'BUILDING'").select(_c("c_custkey", "artifact"))
    return control.unknown(named, customers.where("c_acctbal > 0").select(_c("c_custkey", "artifact")), external, external.where("artifact % 2 <> 0"))


@query("SELECT p_partkey AS artifact, CASE WHEN p_size % 5 = 0 AND p_size % 2 = 0 THEN 'unbound' WHEN p_size % 3 = 0 THEN CASE WHEN p_size % 5 = 0 THEN 'absent' ELSE 'missing' END WHEN p_size > 30 THEN 'drifted' ELSE 'present' END AS status FROM part")
def chain_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as artifacts: some external, some without a path, some not there, some changed."""
    parts, size = table(spark, sf_dir, "part", "p_partkey", "p_size"), F.col("p_size")
    declared = parts.select(_c("p_partkey", "artifact"), (size % 5 == 0).alias("external"), F.when(size % 2 != 0, "path").alias("path"))
    present = parts.where("p_size % 3 <> 0").select(_c("p_partkey", "artifact"), F.lit("now").alias("digest"))
    prior = parts.where("p_size > 10").select(_c("p_partkey", "artifact"), F.when(size > 30, "then").otherwise("now").alias("digest"))
    return control.chain_health(declared, present, prior).select("artifact", "status")


@query("SELECT n_regionkey, sha256('{\"a\":' || n_regionkey || ',\"name\":\"' || n_name || '\"}') AS digest, 'r' || n_regionkey || '/p' AS styles FROM nation")
def config_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration by content: sorted keys, no spaces, whatever order it was written in."""
    rows = table(spark, sf_dir, "nation", "n_name", "n_regionkey").collect()  # configuration: a table of nations
    found = [(r["n_regionkey"], control.digest({"name": r["n_name"], "a": r["n_regionkey"]}), "/".join(control.styles({f"r{r['n_regionkey']}": {}}, {"p": {}}, {})[0][k] for k in ("root", "pack"))) for r in rows]
    return spark.createDataFrame(found, "n_regionkey long, digest string, styles string")
