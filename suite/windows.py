"""Row order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.operators import documents, mocking, ranking
from suite import fixtures as X
from suite.registry import Tables, case


@case(
    "w1_first_row_per_id",
    X.with_ctes(
        X.CUSTOMER_REPEAT,
        select="SELECT c_custkey, c_name, c_acctbal, ord FROM customer_repeat QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY ord) = 1",
    ),
)
def w1(t: Tables) -> DataFrame:
    return ranking.first_per_key(X.customer_repeat(t), ["c_custkey"], ["ord"])


@case(
    "w2_last_row_per_key",
    X.with_ctes(
        X.CUSTOMER_REPEAT,
        select="SELECT c_custkey, c_name, c_acctbal, ord FROM customer_repeat QUALIFY row_number() OVER (PARTITION BY c_name ORDER BY ord DESC) = 1",
    ),
)
def w2(t: Tables) -> DataFrame:
    return ranking.last_per_key(X.customer_repeat(t), ["c_name"], ["ord"])


@case(
    "w3_first_match_per_group",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) = 1""",
)
def w3(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_linenumber")
    first = ranking.first_per_key(rows, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"])
    return first.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")


@case(
    "w4_duplicate_ordinal",
    """SELECT o_orderkey, CASE WHEN rn = 1 THEN k ELSE k || '_' || (rn - 2) END AS unique_key FROM (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)""",
)
def w4(t: Tables) -> DataFrame:
    out = ranking.duplicate_names(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", ["o_orderkey"], "unique_key")
    return out.select("o_orderkey", "unique_key")


@case(
    "w5_sequence_number",
    "SELECT o_orderkey, 'N-' || (100 + (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) * 5) AS number FROM orders",
)
def w5(t: Tables) -> DataFrame:
    ranked = ranking.rank_rows(t.orders.select("o_orderkey", "o_orderdate"), [], ["o_orderdate", "o_orderkey"])
    return ranked.select("o_orderkey", mocking.sequence_number(F.col("_rn"), "N-", 100, 5).alias("number"))


@case(
    "w6_sequence_date",
    """SELECT c_custkey, TIMESTAMP '2020-01-15 00:00:00' + to_days(CAST(rn - 1 AS INTEGER)) AS by_day,
  TIMESTAMP '2020-01-15 00:00:00' - to_months(CAST(rn - 1 AS INTEGER)) AS by_month,
  TIMESTAMP '2020-01-15 00:00:00' + to_seconds(CAST(rn - 1 AS INTEGER)) AS by_second
  FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer)""",
)
def w6(t: Tables) -> DataFrame:
    ranked = ranking.rank_rows(t.customer.select("c_custkey", "c_nationkey"), ["c_nationkey"], ["c_custkey"])
    start, at = "2020-01-15", F.col("_rn")
    return ranked.select(
        "c_custkey",
        mocking.sequence_date(at, start, "d").cast("timestamp_ntz").alias("by_day"),
        mocking.sequence_date(at, start, "-m").cast("timestamp_ntz").alias("by_month"),
        mocking.sequence_date(at, start, "s").cast("timestamp_ntz").alias("by_second"),
    )


@case(
    "w7_per_name_file_counter",
    """SELECT doc_id, source || '-' || CASE WHEN rn > 9999 THEN CAST(rn AS VARCHAR) ELSE lpad(CAST(rn AS VARCHAR), 4, '0') END || '.' || lang AS file_name
  FROM (SELECT doc_id, source, lang, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents)""",
)
def w7(t: Tables) -> DataFrame:
    files = t.documents.select("doc_id", "source", F.concat(F.lit("C:\\in\\a.b."), "lang").alias("path"))
    return documents.file_names(files, "Document", "source", "path", ["doc_id"]).select("doc_id", "file_name")


@case("w8_fixed_size_chunks", "SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 500 AS chunk FROM events")
def w8(t: Tables) -> DataFrame:
    return ranking.chunks(t.events.select("event_id", "ts"), ["ts", "event_id"], 500).select("event_id", "chunk")


@case(
    "w5_sequence_number_tied_order",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (ORDER BY l_linestatus, l_returnflag, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS number FROM lineitem",
)
def w5_tied(t: Tables) -> DataFrame:
    """Two values in the first order column, three in the second."""
    order = ["l_linestatus", "l_returnflag", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return ranking.rank_rows(t.lineitem.select(*order), [], order, "number").select(*order[2:6], "number")


@case(
    "w8_chunks_with_nan",
    """SELECT o_orderkey, (row_number() OVER (ORDER BY v NULLS FIRST, o_orderkey) - 1) // 700 AS chunk
  FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END AS v FROM orders)""",
)
def w8_nan(t: Tables) -> DataFrame:
    price = F.when(F.col("o_orderstatus") == "P", None).when(F.col("o_orderstatus") == "F", float("nan")).otherwise(F.col("o_totalprice"))
    return ranking.chunks(t.orders.select("o_orderkey", price.alias("v")), ["v", "o_orderkey"], 700).select("o_orderkey", "chunk")
