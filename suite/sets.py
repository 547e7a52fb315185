"""Unions, distinct rows, removals, defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.operators import closure, sets
from suite import fixtures as X
from suite.registry import Tables, case


@case(
    "u1_union_with_id_dedupe",
    """SELECT * FROM orders WHERE o_orderstatus = 'F' UNION SELECT * FROM orders WHERE o_totalprice > 200000 UNION SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def u1(t: Tables) -> DataFrame:
    batches = [t.orders.where(c) for c in ("o_orderstatus = 'F'", "o_totalprice > 200000", "o_orderpriority = '1-URGENT'")]
    return sets.union_distinct(batches, "o_orderkey", ["o_orderkey"])


@case(
    "u2_union_of_common_columns",
    """SELECT c_custkey AS "Id", c_name AS "Name" FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""",
)
def u2(t: Tables) -> DataFrame:
    users = t.customer.withColumnsRenamed({"c_custkey": "Id", "c_name": "Name"})
    groups = t.supplier.withColumnsRenamed({"s_suppkey": "Id", "s_name": "Name"})
    return sets.union_common(users, groups, ["Id", "Name"])


@case("u3_seen_value_exclusion", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def u3(t: Tables) -> DataFrame:
    return closure.unseen(t.orders, t.orders.where("o_totalprice > 400000"), "o_custkey")


@case("u4_distinct_by_property", "SELECT arg_min(doc_id, doc_id) AS doc_id, arg_min(v, doc_id) AS v FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN upper(source) ELSE source END AS v FROM documents) GROUP BY lower(v)")
def u4(t: Tables) -> DataFrame:
    spelled = F.when(F.col("lang") == "en", F.upper("source")).otherwise(F.col("source"))
    return sets.distinct_by(t.documents.select("doc_id", spelled.alias("v")), "v", ["doc_id"], ignore_case=True)


@case("u5_remove_first_match", "SELECT event_id, event_type FROM events WHERE event_id <> (SELECT min(event_id) FROM events WHERE event_type = 'error')")
def u5(t: Tables) -> DataFrame:
    return sets.remove_first(t.events.select("event_id", "event_type"), F.col("event_type") == "error", ["event_id"])


@case(
    "u6_listed_keys_with_defaults",
    X.with_ctes(
        X.CUSTOMER_TARGET,
        select="SELECT c.c_name, coalesce(t.target_id, -1) AS target_id, CASE WHEN t.target_id IS NULL THEN 'new' ELSE t.c_mktsegment END AS c_mktsegment FROM customer c LEFT JOIN customer_target t USING (c_name)",
    ),
)
def u6(t: Tables) -> DataFrame:
    known = X.customer_target(t).select("c_name", "target_id", "c_mktsegment")
    return sets.keep_listed(known, "c_name", t.customer, {"target_id": F.lit(-1).cast("long"), "c_mktsegment": F.lit("new")})


@case(
    "u7_not_processed_rows",
    X.with_ctes(X.CUSTOMER_TARGET, select="SELECT c_custkey, c_name FROM customer WHERE c_name NOT IN (SELECT c_name FROM customer_target)"),
)
def u7(t: Tables) -> DataFrame:
    return sets.not_processed(t.customer.select("c_custkey", "c_name"), X.customer_target(t), "c_name")


@case(
    "s8_append_two_tables",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
)
def s8(t: Tables) -> DataFrame:
    first = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    second = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return sets.append(first, second, ["name", "balance", "segment"])
