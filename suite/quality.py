"""Checks and repairs (Q1-Q9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.operators import lookups, quality
from rowferry.plans import repair
from rowferry.spec import LookupSpec, MigrationSpec, TableSpec
from suite import fixtures as X
from suite.joins import CHECKED, STATE, customer_keys
from suite.registry import Tables, case


@case(
    "q1_table_contract_check",
    X.with_ctes(
        X.ORDERS_DAMAGED,
        select="""SELECT 'orders' AS "table", 'o_custkey' AS field, 'BLANK VALUES' AS error, count_if(o_custkey IS NULL)::BIGINT AS blanks FROM orders_damaged
  UNION ALL SELECT 'orders', 'o_totalprice', 'MISSING COLUMN IN THE CSV FILE', NULL
  UNION ALL SELECT 'orders', 'cust_id', 'MISSING COLUMN IN THE CSV FILE', NULL
  UNION ALL SELECT 'invoices', NULL, 'MISSING CSV FILE', NULL
  UNION ALL SELECT 'documents', 'text', 'BLANK VALUES', n FROM (SELECT count_if(trim(text) = '')::BIGINT AS n FROM documents) WHERE n > 0""",
    ),
)
def q1(t: Tables) -> DataFrame:
    tables = {"orders": X.orders_damaged(t), "customer": t.customer, "documents": t.documents, "invoices": None}
    required = {
        "orders": ["O_OrderKey", "'o_custkey'", "o_totalprice"],
        "customer": ["c_custkey", "c_name"],
        "documents": ["doc_id", "text"],
        "invoices": ["id"],
    }
    return quality.check_contract(t.spark, tables, required, {"orders": [("cust_id", "o_cust_name")]})


Q7_SQL = """numbered AS (SELECT trim(id) AS id, o_custkey, ord, row_number() OVER (PARTITION BY trim(id) ORDER BY ord) AS rn FROM orders_no_id)"""
Q7_ID = "CASE WHEN id <> '' AND rn = 1 THEN id ELSE upper(substr(sha256('orders|' || id || '|' || ord), 1, 18)) END"


@case("q5_legacy_composite_columns", """SELECT p_partkey, concat_ws(';', p_brand, nullif(p_type, 'ECONOMY')) AS "Kind.Key" FROM part""")
def q5(t: Tables) -> DataFrame:
    kind = F.when(F.col("p_type") == "ECONOMY", "").otherwise(F.col("p_type"))
    rows = t.part.select("p_partkey", F.col("p_brand").alias("Kind.Brand"), kind.alias("Kind.Type"))
    return quality.combine_legacy_key(rows, "Kind", ["Brand", "Type"], "Kind.Key")


@case("q6_add_id_column", """SELECT c_name, c_acctbal, upper(substr(sha256('customer|' || c_name), 1, 18)) AS "Id" FROM customer""")
def q6(t: Tables) -> DataFrame:
    return quality.add_ids(t.customer.select("c_name", "c_acctbal"), "customer", "Id", ["c_name"])


@case("q6_add_id_to_equal_rows", "SELECT p_name, p_type, count(*) AS rows, count(*) AS ids FROM part GROUP BY ALL")
def q6_equal(t: Tables) -> DataFrame:
    rows = quality.add_ids(t.part.select("p_name", "p_type"), "part", "Id")
    return rows.groupBy("p_name", "p_type").agg(F.count("*").alias("rows"), F.countDistinct("Id").alias("ids"))


@case("q7_id_uniqueness_repair", X.with_ctes(X.ORDERS_NO_ID, Q7_SQL, select=f"SELECT {Q7_ID} AS id, o_custkey, ord FROM numbered"))
def q7(t: Tables) -> DataFrame:
    return quality.repair_ids(X.orders_no_id(t), "orders", "id", ["ord"])


ORPHANS = """orphans AS (SELECT CAST(NULL AS VARCHAR) AS "Date update", 'orders' AS "sObject name", 'o_custkey' AS "Field name", CAST(o_custkey AS VARCHAR) AS "Field value",
  'customer' AS "Parent SObject name", 'c_custkey' AS "Parent field name", CAST(NULL AS VARCHAR) AS "Parent field value", 'MISSING PARENT LOOKUP RECORD' AS "Error"
  FROM orders_damaged WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))"""
CONFLICTS = f"""conflicts AS (SELECT CAST(NULL AS VARCHAR) AS "Date update", 'orders' AS "sObject name", 'o_custkey' AS "Field name", CAST(o_custkey AS VARCHAR) AS "Field value",
  CAST(NULL AS VARCHAR) AS "Parent SObject name", 'c_name' AS "Parent field name", o_cust_name AS "Parent field value", 'LOOKUP ID/REFERENCE CONFLICT' AS "Error"
  FROM (SELECT *, {STATE} AS state FROM checked) WHERE state = 'conflict')"""
ISSUES = (
    X.ORDERS_DAMAGED, CHECKED, ORPHANS, CONFLICTS,
    """issues AS (SELECT "sObject name" AS "table", "Error" AS error FROM orphans UNION ALL SELECT "sObject name", "Error" FROM conflicts)""",
)


@case("q8_orphan_check", X.with_ctes(X.ORDERS_DAMAGED, ORPHANS, select="SELECT * FROM orphans"))
def q8(t: Tables) -> DataFrame:
    return lookups.orphan_issues(X.orders_damaged(t), "orders", "o_custkey", "customer", t.customer, "c_custkey")


@case("q9_conflict_check", X.with_ctes(X.ORDERS_DAMAGED, CHECKED, CONFLICTS, select="SELECT * FROM conflicts"))
def q9(t: Tables) -> DataFrame:
    return lookups.conflict_issues(X.orders_damaged(t), "orders", "o_custkey", "o_cust_name", "c_name", customer_keys(t))


def all_issues(t: Tables) -> DataFrame:
    return q8(t).unionByName(q9(t))


def repaired(t: Tables) -> repair.Repaired:
    spec = MigrationSpec(
        (
            TableSpec("customer", "c_custkey", ("c_name",), ("c_acctbal",), "Upsert"),
            TableSpec(
                "orders", "o_orderkey", ("o_orderkey",), (), "Upsert",
                (LookupSpec("o_custkey", "customer", "o_cust_name"),),
            ),
        )
    )
    dirty = X.orders_damaged(t).withColumn("extra", F.lit("x")).withColumnRenamed("o_orderkey", " O_ORDERKEY ")
    return repair.repair(spec, {"customer": t.customer, "orders": dirty})


@case(
    "q4_repair_chain",
    X.with_ctes(
        X.ORDERS_DAMAGED, CHECKED,
        select=f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN state = 'id_fixed' THEN ref_id ELSE o_custkey END AS o_custkey,
  CASE WHEN state = 'reference_fixed' THEN id_name ELSE o_cust_name END AS o_cust_name FROM (SELECT *, {STATE} AS state FROM checked)""",
    ),
)
def q4(t: Tables) -> DataFrame:
    return repaired(t).tables["orders"]


@case("q4_repair_chain_issues", X.with_ctes(X.ORDERS_DAMAGED, CHECKED, CONFLICTS, select="SELECT * FROM conflicts"))
def q4_issues(t: Tables) -> DataFrame:
    return repaired(t).issues


@case(
    "q4_repair_repeated_ids",
    X.with_ctes(
        X.ORDERS_NO_ID,
        select="""SELECT count(*) AS rows, count(*) AS ids, count(DISTINCT CASE WHEN trim(id) <> '' THEN trim(id) END) AS kept FROM orders_no_id""",
    ),
)
def q4_repeated(t: Tables) -> DataFrame:
    """No order is given, so that repeated ids tie in it. All rows stay, and no two share an id."""
    spec = MigrationSpec((TableSpec("orders", "id", ("id",), ("o_custkey", "ord"), "Upsert"),))
    out = repair.repair(spec, {"orders": X.orders_no_id(t)}).tables["orders"]
    before = X.orders_no_id(t).select(F.trim("id").alias("_old")).where("_old <> ''").distinct()
    kept = F.count_distinct(F.when(F.col("_old").isNotNull(), F.col("id")))
    return out.join(before, F.col("id") == F.col("_old"), "left").agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids"), kept.alias("kept"))
