"""Sources and sinks (S1-S15). Sinks write to the shared folder and the query reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.operators.batches import block_batches
from rowferry.operators.lookups import missing_parents, parent_columns
from rowferry.session import scratch_folder
from rowferry.sources import scan, sinks
from suite import fixtures as X
from suite.plans import DIFFERENT, HEAD, customer_plan
from suite.quality import all_issues
from suite.registry import Tables, case


@case("s1_table_scan", "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_quantity > 25 AND l_returnflag = 'R'")
def s1(t: Tables) -> DataFrame:
    return scan.scan(t.lineitem, ["l_orderkey", "l_extendedprice"], "l_quantity > 25 AND l_returnflag = 'R'")


def read_back(t: Tables, path: str) -> DataFrame:
    return scan.read_text_csv(t.spark, path)


TYPES = {"ID": "long", "total": "currency", "Flag": "boolean", "Day": "date", "Note": "string"}


@case(
    "s2_typed_csv_scan",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS total, CASE WHEN o_orderstatus = 'P' THEN 'n/k' END AS total__raw,
  CAST(NULL AS VARCHAR) AS id__raw, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS flag, CASE WHEN o_orderstatus = 'P' THEN 'maybe' END AS flag__raw,
  CAST(o_orderdate AS DATE) AS day, CAST(NULL AS VARCHAR) AS day__raw, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS note FROM orders""",
)
def s2(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    dirty = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(status == "P", "n/k").otherwise(F.col("o_totalprice").cast("string")).alias("total"),
        F.when(status == "F", "Yes").when(status == "O", "off").otherwise("maybe").alias("flag"),
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("day"),
        F.when(F.col("o_orderpriority") == "5-LOW", "#N/A").otherwise(F.col("o_orderpriority")).alias("note"),
    )
    path = scratch_folder(t.spark, "s2")
    sinks.write_csv(dirty, path, separator=";")
    return scan.read_csv(t.spark, path, TYPES, separator=";", european_dates=True)


@case("s2_multi_line_cells", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, '<' || text || '>' AS text FROM documents WHERE text IS NOT NULL")
def s2_multi_line(t: Tables) -> DataFrame:
    path = scratch_folder(t.spark, "s2_lines")
    texts = t.documents.where("text IS NOT NULL").select("doc_id", F.concat(F.lit("<"), F.col("text"), F.lit(">")).alias("text"))
    sinks.write_csv(texts, path, keep_order=True)
    return read_back(t, path).select("doc_id", "text")


@case("s2_missing_file_is_empty", "SELECT CAST(NULL AS BIGINT) AS id, c_name AS name FROM customer")
def s2_missing(t: Tables) -> DataFrame:
    absent = scan.read_csv(t.spark, scratch_folder(t.spark, "absent"), {"id": "long", "name": "string"}, keep_failures=False)
    return absent.unionByName(t.customer.select(F.lit(None).cast("long").alias("id"), F.col("c_name").alias("name")))


@case("s5_csv_sink", """SELECT CAST(c_custkey AS VARCHAR) AS "C_CUSTKEY", c_name AS "C_NAME", CASE WHEN c_acctbal < 0 THEN '#N/A' ELSE CAST(c_acctbal AS VARCHAR) END AS "C_ACCTBAL" FROM customer""")
def s5(t: Tables) -> DataFrame:
    path = scratch_folder(t.spark, "s5")
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    sinks.write_csv(t.customer.select("c_name", balance.alias("c_acctbal"), "c_custkey"), path, upper_header=True)
    return read_back(t, path)


@case(
    "s6_plain_target_export",
    """SELECT o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, c_name AS "Customer.c_name" FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def s6(t: Tables) -> DataFrame:
    folder = scratch_folder(t.spark, "s6")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    rows = parent_columns(rows, t.customer, "o_custkey", "c_custkey", "Customer", ["c_name"])
    sinks.export_table(rows, folder, "orders", "o_orderkey", ["o_custkey"], without_ids=True)
    return read_back(t, f"{folder}/orders.csv")


@case(
    "s7_write_audit_sink",
    X.with_ctes(
        *HEAD,
        select=f"""SELECT coalesce(CAST(l.target_id AS VARCHAR), '#N/A') AS "Id", CAST(s.c_custkey AS VARCHAR) AS "Old Id", s.c_name, CAST(s.c_acctbal AS VARCHAR) AS c_acctbal,
  CAST(s.c_nationkey AS VARCHAR) AS c_nationkey, s.c_mktsegment, '#N/A' AS "Errors", CASE WHEN l.target_id IS NULL THEN 'insert' ELSE 'update' END AS operation
  FROM customer_dup s LEFT JOIN links l ON s.c_custkey = l.source_id WHERE l.target_id IS NULL OR {DIFFERENT}""",
    ),
)
def s7(t: Tables) -> DataFrame:
    folder = scratch_folder(t.spark, "s7")
    sinks.write_audit(customer_plan(t), folder, "customer", "c_custkey")
    return read_back(t, f"{folder}/customer_target")


@case(
    "s9_split_by_id_prefix",
    """SELECT 'User' AS part, ' 005' || c_custkey AS "Id", c_name AS "Name" FROM customer UNION ALL SELECT 'Group', '00g' || s_suppkey, s_name FROM supplier""",
)
def s9(t: Tables) -> DataFrame:
    users = t.customer.select(F.concat(F.lit(" 005"), F.col("c_custkey").cast("string")).alias("Id"), F.col("c_name").alias("Name"))
    groups = t.supplier.select(F.concat(F.lit("00g"), F.col("s_suppkey").cast("string")).alias("Id"), F.col("s_name").alias("Name"))
    blank = t.nation.select(F.lit(" ").alias("Id"), F.col("n_name").alias("Name"))
    parts = scan.split_by_prefix(users.unionByName(groups).unionByName(blank), "Id")
    user, group = (parts[n].select(F.lit(n).alias("part"), "Id", "Name") for n in ("User", "Group"))
    return user.unionByName(group)


@case("s10_source_snapshot", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def s10(t: Tables) -> DataFrame:
    folder, query = scratch_folder(t.spark, "s10"), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'"

    def read() -> DataFrame:
        return scan.scan(t.orders, ["o_orderkey", "o_totalprice"], "o_orderstatus = 'O'")

    scan.snapshot(t.spark, folder, query, read)
    return scan.snapshot(t.spark, folder, query, lambda: read().where("false"))


@case(
    "s11_size_bounded_chunks",
    """WITH RECURSIVE b AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS block, octet_length(encode(o_orderpriority)) + 1 AS n FROM orders),
  s AS (SELECT block, sum(n)::BIGINT AS n, row_number() OVER (ORDER BY block) AS rn FROM b GROUP BY block),
  g AS (SELECT rn, block, CAST(0 AS BIGINT) AS chunk, n AS fill FROM s WHERE rn = 1
    UNION ALL SELECT s.rn, s.block, CASE WHEN g.fill + s.n > 30000 THEN g.chunk + 1 ELSE g.chunk END, CASE WHEN g.fill + s.n > 30000 THEN s.n ELSE g.fill + s.n END FROM g JOIN s ON s.rn = g.rn + 1)
  SELECT o_orderkey, g.chunk FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS block FROM orders) JOIN g USING (block)""",
)
def s11(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    return block_batches(rows, ["o_orderkey"], "o_orderpriority", 30_000, 1000).select("o_orderkey", "chunk")


@case(
    "s12_issue_report_sink",
    X.with_ctes(
        X.ORDERS_DAMAGED,
        select="""SELECT 'o_custkey' AS "Field name", CAST(o_custkey AS VARCHAR) AS "Field value", 'MISSING PARENT LOOKUP RECORD' AS "Error" FROM orders_damaged WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""",
    ),
)
def s12(t: Tables) -> DataFrame:
    path = scratch_folder(t.spark, "s12")
    sinks.write_issues(all_issues(t).where("Error = 'MISSING PARENT LOOKUP RECORD'"), path)
    return read_back(t, path).select("Field name", "Field value", "Error")


@case(
    "s13_missing_parent_sink",
    X.with_ctes(
        X.CUSTOMER_TARGET, X.CUSTOMER_XREF, X.ORDERS_DAMAGED,
        select="""SELECT CAST(o_orderkey AS VARCHAR) AS "Record Id", CAST(o_custkey AS VARCHAR) AS "Missing parent External Id value" FROM orders_damaged WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT source_id FROM customer_xref)""",
    ),
)
def s13(t: Tables) -> DataFrame:
    path = scratch_folder(t.spark, "s13")
    rows = missing_parents(X.orders_damaged(t), X.customer_xref(t), "o_orderkey", "o_custkey", "orders", "customer", "c_name")
    sinks.write_missing_parents(rows, path)
    return read_back(t, path).select("Record Id", "Missing parent External Id value")


@case("s14_normalised_source_copy", "SELECT CAST(p_partkey AS VARCHAR) AS \"Id\", p_name, CASE WHEN p_size > 40 THEN '#N/A' ELSE CAST(p_size AS VARCHAR) END AS p_size FROM part")
def s14(t: Tables) -> DataFrame:
    raw, copy = scratch_folder(t.spark, "raw"), scratch_folder(t.spark, "source")
    size = F.when(F.col("p_size") > 40, "NULL").otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string")))
    sinks.write_csv(t.part.select(F.col("p_partkey").alias("Id"), "p_name", size.alias("p_size")), raw, separator="|", quote_all=False)
    sinks.copy_normalised(scan.read_text_csv(t.spark, raw, separator="|"), copy, {"P_SIZE": "int"})
    return read_back(t, copy)


@case(
    "s15_document_package",
    X.with_ctes(
        X.DOC_VERSIONS, X.DOC_LINKS, "chosen AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
        "kept AS (SELECT * FROM doc_links WHERE parent_id IN (SELECT c_custkey FROM chosen))",
        select="""SELECT 'links' AS part, count(*) AS rows FROM kept UNION ALL SELECT 'versions', count(*) FROM doc_versions WHERE doc_id IN (SELECT doc_id FROM kept)
  UNION ALL SELECT 'attachments', count(*) FROM pages WHERE page_id IN (SELECT c_custkey FROM chosen) UNION ALL SELECT 'notes', count(*) FROM conversations WHERE conv_id IN (SELECT c_custkey FROM chosen)""",
    ),
)
def s15(t: Tables) -> DataFrame:
    tables = {
        "versions": X.doc_versions(t),
        "links": X.doc_links(t),
        "attachments": t.pages.withColumn("parent_id", F.col("page_id")),
        "notes": t.conversations.withColumn("parent_id", F.col("conv_id")),
    }
    folder = scratch_folder(t.spark, "s15")
    sinks.write_package(scan.read_package(tables, t.customer.where("c_mktsegment = 'BUILDING'"), "c_custkey"), folder)
    counts = [
        t.spark.read.parquet(f"{folder}/{name}").agg(F.count("*").alias("rows")).select(F.lit(name).alias("part"), "rows")
        for name in scan.PACKAGE
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])
