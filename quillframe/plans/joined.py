"""Queries: joins between questions and answers, blocks and owners, sources and copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.operators import joins
from quillframe.plans.corpus import blocks, texts, turns, with_blocks, with_turns
from quillframe.plans.registry import query
from quillframe.sources.lines import line_blocks
from quillframe.sources.tables import table


def _events_as_questions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Views and clicks are questions, all else answers; places may be null, stems are texts by value."""
    rows = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value").select(
        F.col("event_id").alias("ordinal"),
        F.when(F.col("user_id") % 5 != 0, F.col("user_id") % 40).alias("section"),
        F.when(F.col("user_id") % 3 != 0, F.col("user_id") % 7).alias("node"),
        F.concat(F.lit("question about the value "), F.floor("value").cast("string")).alias("stem"),
        F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 25).alias("number"),
        F.concat(F.lit("answer "), F.col("event_id").cast("string")).alias("answer"),
        F.col("event_type").isin("view", "click").alias("asks"),
    )
    return rows.where("asks").drop("answer", "asks"), rows.where("NOT asks").drop("asks")


_QA = (
    "WITH e AS (SELECT event_id AS ordinal, CASE WHEN user_id % 5 <> 0 THEN user_id % 40 END AS section, CASE WHEN user_id % 3 <> 0 THEN user_id % 7 END AS node, "
    "'question about the value ' || floor(value)::BIGINT AS stem, CASE WHEN event_id % 4 <> 0 THEN event_id % 25 END AS number, 'answer ' || event_id AS answer, event_type IN ('view', 'click') AS asks FROM events), "
    "q AS (SELECT * FROM e WHERE asks), a AS (SELECT * FROM e WHERE NOT asks), "
    "s AS (SELECT section, node, substr(stem, 1, 18) AS prefix, arg_max(answer, ordinal) AS stem_answer FROM a GROUP BY ALL), n AS (SELECT section, node, number, arg_max(answer, ordinal) AS number_answer FROM a WHERE number IS NOT NULL GROUP BY ALL) "
    "SELECT q.ordinal, coalesce(stem_answer, number_answer) AS answer, CASE WHEN stem_answer IS NOT NULL THEN 'stem' WHEN number_answer IS NOT NULL THEN 'number' END AS matched_by FROM q "
    "LEFT JOIN s ON q.section IS NOT DISTINCT FROM s.section AND q.node IS NOT DISTINCT FROM s.node AND substr(q.stem, 1, 18) = s.prefix "
    "LEFT JOIN n ON q.section IS NOT DISTINCT FROM n.section AND q.node IS NOT DISTINCT FROM n.node AND q.number = n.number"
)


@query(_QA)
def answer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, answers = _events_as_questions(spark, sf_dir)
    return joins.answer_join(questions, answers, ["section", "node"]).select("ordinal", "answer", "matched_by")


@query("SELECT c_custkey, n_name, (SELECT count(*) FROM supplier s WHERE s.s_nationkey IS NOT DISTINCT FROM c.c_nationkey) AS n_partners FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey")
def partner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their annotated partners, null keys matching null."""
    customers, nations = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey"), table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    partners = table(spark, sf_dir, "supplier", "s_nationkey").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    rows = customers.join(partners, customers["c_nationkey"].eqNullSafe(partners["s_nationkey"]), "left")
    return rows.join(nations, rows["c_nationkey"] == nations["n_nationkey"], "left").select("c_custkey", "n_name", F.coalesce("n", F.lit(0)).alias("n_partners"))


@query("WITH t AS (SELECT o_orderkey, '1. ' || o_orderpriority || ' 2. ' || o_orderstatus || ' is 3.5 3、' || o_custkey AS text FROM orders) SELECT o_orderkey, u.number::INTEGER AS number, u.part FROM t, LATERAL (SELECT unnest([1, 2, 3]) AS number, unnest([regexp_extract(text, '^1\\. (.*) 2\\. ', 1), regexp_extract(text, ' 2\\. (.*) 3、', 1), regexp_extract(text, '3、(.*)$', 1)]) AS part) u")
def combined_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey")
    text = F.concat(F.lit("1. "), "o_orderpriority", F.lit(" 2. "), "o_orderstatus", F.lit(" is 3.5 3、"), F.col("o_custkey").cast("string"))
    return joins.combined_answers(rows.select("o_orderkey", text.alias("text"))).select("o_orderkey", "number", "part")


@query("WITH t AS (SELECT o_orderkey, unnest(['1', '2', '3']) AS label, unnest([o_orderpriority, '', o_orderstatus]) AS body, unnest([o_orderpriority, o_orderstatus, o_orderstatus]) AS shared_body FROM orders) SELECT o_orderkey, label, body, shared_body, body = '' AS answer_shared FROM t")
def sub_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second part is empty and shares the third's text."""
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    text = F.concat(F.lit("(1) "), "o_orderpriority", F.lit(" (2)（3）"), "o_orderstatus")
    return joins.sub_answers(rows.select("o_orderkey", text.alias("text"))).select("o_orderkey", "label", "body", "shared_body", "answer_shared")


@query("WITH l AS (SELECT l_orderkey AS document, l_linenumber, l_partkey, l_returnflag, CASE WHEN l_linenumber % 2 = 0 THEN 'body/tbl[' || l_linenumber // 2 || ']/tr[1]/tc[' || l_partkey % 3 || ']/p[1]' ELSE 'body/p[' || l_linenumber || ']' END AS locator FROM lineitem), r AS (SELECT *, split_part(locator, '/tr[', 1) AS root FROM l), u AS (SELECT document, root, min(l_partkey) AS owner FROM r WHERE l_returnflag = 'N' GROUP BY ALL) SELECT r.document, r.locator, r.l_partkey, u.owner FROM r LEFT JOIN u USING (document, root)")
def owner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, part = F.col("l_linenumber"), F.col("l_partkey")
    cell = F.concat(F.lit("body/tbl["), F.floor(n / 2).cast("string"), F.lit("]/tr[1]/tc["), (part % 3).cast("string"), F.lit("]/p[1]"))
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").select(F.col("l_orderkey").alias("document"), F.when(n % 2 == 0, cell).otherwise(F.concat(F.lit("body/p["), n.cast("string"), F.lit("]"))).alias("locator"), "l_partkey", "l_returnflag")
    units = rows.where("l_returnflag = 'N'").select("document", F.substring_index("locator", "/tr[", 1).alias("locator"), F.col("l_partkey").alias("unit"), F.col("l_partkey").alias("ordinal"))
    return joins.owner_join(rows, units).select("document", "locator", "l_partkey", "owner")


@query(with_blocks(", h AS (SELECT DISTINCT document, text AS heading FROM blocks WHERE kind = 'section' AND text <> ''), u AS (SELECT * FROM blocks WHERE kind NOT IN ('stem', 'callout')) SELECT u.document, u.ordinal, CASE WHEN bool_or(coalesce(contains(u.raw_text, h.heading), false)) THEN 'heading' ELSE 'prose' END AS unit_kind FROM u LEFT JOIN h ON u.document = h.document GROUP BY u.document, u.ordinal"))
def unclaimed_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    heading = F.when(F.col("kind") == "section", F.col("text"))
    return joins.unclaimed(blocks(spark, sf_dir), F.col("kind").isin("stem", "callout"), heading)


@query(with_blocks("SELECT document, ordinal FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = b.document) AND raw_text <> ''"))
def orphan_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "labels", "doc_id").withColumnRenamed("doc_id", "document")
    return joins.orphans(line_blocks(table(spark, sf_dir, "documents", "doc_id", "text")).where("raw_text <> ''"), spans, ["document"]).select("document", "ordinal")


@query("SELECT l_orderkey AS block, arg_min(l_partkey, l_linenumber * 1000000000::BIGINT + l_partkey) AS owner FROM lineitem GROUP BY l_orderkey")
def first_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").select(F.col("l_orderkey").alias("block"), F.col("l_linenumber").alias("char_start"), F.col("l_partkey").alias("unit"))
    return joins.first_owner(spans)


@query(with_blocks("SELECT document, ordinal, length(raw_text) - length(text) AS uncovered FROM blocks ORDER BY uncovered DESC, document, ordinal LIMIT 5"))
def worst_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five blocks with the most characters that normalisation drops."""
    rows = texts(spark, sf_dir).select("document", "ordinal", (F.length("raw_text") - F.length("text")).cast("long").alias("uncovered"))
    return rows.orderBy(F.desc("uncovered"), "document", "ordinal").limit(5)


@query("WITH f AS (SELECT c_custkey AS file, c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN c_custkey // 2 END AS holder FROM customer), u AS (SELECT DISTINCT o_custkey AS file FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000) SELECT f.file, f.holder, CASE WHEN f.file IN (SELECT file FROM u) THEN NULL WHEN c_acctbal < 0 THEN 'duplicate' END AS reason, CASE WHEN f.file IN (SELECT file FROM u) THEN 'consumed' WHEN f.holder IN (SELECT file FROM u) THEN 'containedIn' WHEN c_acctbal < 0 THEN 'excluded' ELSE 'ORPHAN' END AS status FROM f")
def disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal").select("c_acctbal", F.col("c_custkey").alias("file"), F.when(F.col("c_custkey") % 3 == 0, F.floor(F.col("c_custkey") / 2)).alias("holder"))
    consumed = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_totalprice").where("o_orderstatus = 'F' AND o_totalprice > 200000").select(F.col("o_custkey").alias("file"))
    excluded = files.where("c_acctbal < 0").select("file", F.lit("duplicate").alias("reason"))
    out = joins.disposition(files, consumed, excluded)
    return out.select("file", "holder", F.when(F.col("status") != "consumed", F.col("reason")).alias("reason"), "status")


@query("SELECT p_partkey AS path, CASE WHEN p_size <= 5 THEN 'UPSTREAM_GONE' WHEN p_partkey % 4 <> 0 THEN 'in-sync' WHEN p_size > 25 THEN 'adjudicated' ELSE 'UPSTREAM_MOVED' END AS status FROM part")
def adjudicated_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    rows = parts.select(F.col("p_partkey").alias("path"), F.sha2("p_name", 256).alias("digest"))
    moved = F.when(F.col("p_partkey") % 4 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name"))
    upstream = parts.where("p_size > 5").select(F.col("p_partkey").alias("path"), F.sha2(moved, 256).alias("digest"))
    decisions = parts.where("p_size > 25").select(F.col("p_partkey").alias("path"), F.sha2(moved, 256).alias("digest"))
    return joins.adjudicated_drift(rows, upstream, decisions).select("path", "status")


@query(
    "WITH b AS (SELECT item_id, text, row_number() OVER (ORDER BY item_id) AS n FROM benchmark), o AS (SELECT item_id, CASE item_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'x ' || text || ' y' WHEN 2 THEN substr(text, 1, 20) WHEN 3 THEN reverse(text) WHEN 4 THEN 'zzz' ELSE text END AS got FROM b), "
    "r AS (SELECT b.item_id, b.text, regexp_replace(b.text, '[\\t\\n\\v\\f\\r ]+', '', 'g') AS w, regexp_replace(coalesce(o.got, ''), '[\\t\\n\\v\\f\\r ]+', '', 'g') AS g, o.got FROM b JOIN o USING (item_id)) "
    "SELECT item_id, CASE WHEN w = '' THEN 'blank' WHEN w = g THEN 'ok' WHEN text < 'F' THEN 'declared' WHEN got IS NULL THEN 'TEXT_MISSING' WHEN contains(g, w) THEN 'transcription' WHEN g <> '' AND contains(w, g) THEN 'TEXT_PARTIAL' "
    "WHEN len(list_filter(string_split(w, ''), lambda c: NOT contains(g, c))) = 0 THEN 'letters_only' ELSE 'TEXT_CHANGED' END AS status FROM r"
)
def reconcile_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages against changed copies of themselves."""
    source = table(spark, sf_dir, "benchmark", "item_id", "text")
    kind = F.col("item_id") % 6
    got = F.when(kind == 0, F.lit(None)).when(kind == 1, F.concat(F.lit("x "), "text", F.lit(" y"))).when(kind == 2, F.substring("text", 1, 20)).when(kind == 3, F.reverse("text")).when(kind == 4, "zzz").otherwise(F.col("text"))
    output = source.select("item_id", got.alias("text")).where("text IS NOT NULL")
    return joins.reconcile_text(source, output, ["item_id"], source.where("text < 'F'")).select("item_id", "status")


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def layout_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.layout_missing(table(spark, sf_dir, "documents", "doc_id"), table(spark, sf_dir, "labels", "doc_id"), ["doc_id"])


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'absentInRepro' WHEN o_totalprice < 20000 THEN 'different' ELSE 'same' END AS status FROM orders")
def artifact_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")
    digest = F.sha2(F.concat(F.col("o_orderkey").cast("string"), "o_orderstatus"), 256)
    again = orders.where("o_orderstatus <> 'P'").select("o_orderkey", F.when(F.col("o_totalprice") < 20000, "other").otherwise(digest).alias("digest"))
    return joins.artifact_reconcile(orders.select("o_orderkey", digest.alias("digest")), again, ["o_orderkey"]).select("o_orderkey", "status")


@query("WITH a AS (SELECT DISTINCT c_custkey AS key FROM customer WHERE c_acctbal > 0), b AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_totalprice > 200000) SELECT key, 'left' AS side FROM a WHERE key NOT IN (SELECT key FROM b) UNION ALL SELECT key, 'right' FROM b WHERE key NOT IN (SELECT key FROM a)")
def set_symmetric_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal").where("c_acctbal > 0").select(F.col("c_custkey").alias("key"))
    return joins.symmetric_difference(left, table(spark, sf_dir, "orders", "o_custkey", "o_totalprice").where("o_totalprice > 200000").select(F.col("o_custkey").alias("key")))


@query(with_blocks("SELECT role, count(*) AS n_blocks FROM blocks WHERE role NOT IN ('blank', 'short', 'plain') GROUP BY role"))
def unmapped_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = spark.createDataFrame([("blank",), ("short",), ("plain",)], "role string")
    return joins.unmapped(blocks(spark, sf_dir), mapping, "role")


@query(with_turns("SELECT t.document, t.ordinal, coalesce(CASE WHEN t.text IN (SELECT text FROM benchmark) THEN 'known passage' END, CASE WHEN t.text = 'You are a helpful assistant.' THEN '' END, t.text) AS final_text FROM turns t"))
def text_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = spark.createDataFrame([("You are a helpful assistant.", "")], "old string, new string")
    known = table(spark, sf_dir, "benchmark", "text").distinct().select(F.col("text").alias("old"), F.lit("known passage").alias("new"))
    return joins.text_override(turns(spark, sf_dir), known.unionByName(fixed)).select("document", "ordinal", "final_text")


@query("SELECT o_orderpriority AS value, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_left, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_right FROM orders GROUP BY 1 HAVING n_left <> n_right")
def multiset_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that two multisets hold in different numbers; no rows when they are equal."""
    orders = table(spark, sf_dir, "orders", "o_orderpriority", "o_orderstatus")
    side = lambda s: orders.where(F.col("o_orderstatus") == s).select(F.col("o_orderpriority").alias("value"))
    return joins.multiset_difference(side("F"), side("O"))


@query("SELECT DISTINCT p_brand, p_size FROM part EXCEPT SELECT p_brand, p_size FROM part WHERE p_retailprice > 1200")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered pairs that were not applied."""
    parts = table(spark, sf_dir, "part", "p_brand", "p_size", "p_retailprice")
    return parts.select("p_brand", "p_size").distinct().join(parts.where("p_retailprice > 1200").select("p_brand", "p_size"), ["p_brand", "p_size"], "left_anti")


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_discount > 0.09 AND l_quantity > 45)")
def acceptance_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acceptance items without a check."""
    checks = table(spark, sf_dir, "lineitem", "l_suppkey", "l_discount", "l_quantity").where("l_discount > 0.09 AND l_quantity > 45")
    suppliers = table(spark, sf_dir, "supplier", "s_suppkey")
    return suppliers.join(checks, suppliers["s_suppkey"] == checks["l_suppkey"], "left_anti")


@query("SELECT c_custkey, w.number::BIGINT AS wanted, c.c_nationkey IS NOT NULL AS found FROM (SELECT unnest(range(3, 30)) AS number) w LEFT JOIN customer c ON c.c_nationkey = w.number")
def scope_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the numbers asked for; numbers without one are reported."""
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    wanted = spark.range(3, 30).withColumnRenamed("id", "wanted")
    return wanted.join(customers, wanted["wanted"] == customers["c_nationkey"], "left").select("c_custkey", "wanted", F.col("c_nationkey").isNotNull().alias("found"))


@query("WITH n AS (SELECT greatest(1, count(*) // 26) AS lo, 2 * count(*) AS hi FROM customer) SELECT n_nationkey, count(c_custkey) AS n_references, count(c_custkey) BETWEEN any_value(lo) AND any_value(hi) AS ok FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey, n GROUP BY n_nationkey")
def banner_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared banners, how often each is used, and whether that is plausible."""
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    size = customers.count()
    used = customers.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    nations = table(spark, sf_dir, "nation", "n_nationkey")
    n = F.coalesce("n", F.lit(0))
    return nations.join(used, nations["n_nationkey"] == used["c_nationkey"], "left").select("n_nationkey", n.alias("n_references"), n.between(max(1, size // 26), 2 * size).alias("ok"))
