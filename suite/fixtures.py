"""Derived source and target tables, each once as a DataFrame and once as a SQL fragment.

They read whole tables. A target that lacks some rows and differs in others is what a
migration meets, so the conditions below shape data; none of them thins out the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.registry import Tables

# Customers of the target: some nations are not there yet, one segment has other balances.
CUSTOMER_TARGET = """customer_target AS (
  SELECT c_custkey + 1000000 AS target_id, c_name, c_nationkey, c_mktsegment,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
  FROM customer WHERE c_nationkey >= 8)"""


def customer_target(t: Tables) -> DataFrame:
    balance = F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    return t.customer.where("c_nationkey >= 8").select(
        (F.col("c_custkey") + 1000000).alias("target_id"), "c_name", "c_nationkey", "c_mktsegment", balance.alias("c_acctbal")
    )


# Customers with a second row for one segment: same name, other id, later in order.
CUSTOMER_DUP = """customer_dup AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
  UNION ALL
  SELECT c_custkey + 5000000, c_name, c_nationkey, c_acctbal + 5, c_mktsegment
  FROM customer WHERE c_mktsegment = 'FURNITURE')"""


def customer_dup(t: Tables) -> DataFrame:
    copies = t.customer.where("c_mktsegment = 'FURNITURE'").select(
        (F.col("c_custkey") + 5000000).alias("c_custkey"), "c_name", "c_nationkey",
        (F.col("c_acctbal") + 5).alias("c_acctbal"), "c_mktsegment",
    )
    return t.customer.unionByName(copies)


# The same rows with a repeated id instead: ``ord`` tells the copies apart.
CUSTOMER_REPEAT = """customer_repeat AS (
  SELECT c_custkey, c_name, c_acctbal, c_custkey * 2 AS ord FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_acctbal + 5, c_custkey * 2 + 1 FROM customer WHERE c_mktsegment = 'FURNITURE')"""


def customer_repeat(t: Tables) -> DataFrame:
    first = t.customer.select("c_custkey", "c_name", "c_acctbal", (F.col("c_custkey") * 2).alias("ord"))
    second = t.customer.where("c_mktsegment = 'FURNITURE'").select(
        "c_custkey", "c_name", (F.col("c_acctbal") + 5).alias("c_acctbal"), (F.col("c_custkey") * 2 + 1).alias("ord")
    )
    return first.unionByName(second)


CUSTOMER_XREF = """customer_xref AS (
  SELECT s.c_custkey AS source_id, t.target_id FROM customer s JOIN customer_target t ON s.c_name = t.c_name)"""


def customer_xref(t: Tables) -> DataFrame:
    from rowferry.operators.matching import match

    return match(t.customer, customer_target(t), "c_custkey", "target_id", ["c_name"])


# Orders with damaged lookups: empty ids, ids of nobody, names that disagree with the id.
ORDERS_DAMAGED = """orders_damaged AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
              WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN -o_custkey - 1
              ELSE o_custkey END AS o_custkey,
         CASE WHEN o_orderstatus = 'P' THEN 'Customer#' || lpad(CAST(o_custkey + 1 AS VARCHAR), 9, '0')
              WHEN o_orderstatus = 'F' AND o_totalprice > 400000 THEN 'nobody'
              ELSE 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS o_cust_name
  FROM orders)"""


def orders_damaged(t: Tables) -> DataFrame:
    def name_of(key):
        return F.concat(F.lit("Customer#"), F.lpad(key.cast("string"), 9, "0"))

    key = F.col("o_custkey")
    low = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")
    damaged = F.when(F.col("o_orderpriority") == "1-URGENT", None).when(low, -key - 1).otherwise(key)
    wrong = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)
    name = F.when(F.col("o_orderstatus") == "P", name_of(key + 1)).when(wrong, "nobody").otherwise(name_of(key))
    return t.orders.select("o_orderkey", damaged.alias("o_custkey"), name.alias("o_cust_name"))


# Orders whose id is text, blank for one priority, there twice for another.
ORDERS_NO_ID = """orders_no_id AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN ' ' ELSE CAST(o_orderkey AS VARCHAR) || ' ' END AS id,
         o_custkey, o_orderkey * 2 AS ord FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), o_custkey, o_orderkey * 2 + 1 FROM orders WHERE o_orderpriority = '3-MEDIUM')"""


def orders_no_id(t: Tables) -> DataFrame:
    text = F.col("o_orderkey").cast("string")
    first = t.orders.select(
        F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.concat(text, F.lit(" "))).alias("id"),
        "o_custkey", (F.col("o_orderkey") * 2).alias("ord"),
    )
    again = t.orders.where("o_orderpriority = '3-MEDIUM'").select(
        text.alias("id"), "o_custkey", (F.col("o_orderkey") * 2 + 1).alias("ord")
    )
    return first.unionByName(again)


# Every event points to an earlier one.
EVENT_CHAIN = """event_chain AS (
  SELECT event_id, event_type, CASE WHEN event_id > user_id THEN event_id - user_id - 1 END AS parent_id FROM events)"""


def event_chain(t: Tables) -> DataFrame:
    parent = F.when(F.col("event_id") > F.col("user_id"), F.col("event_id") - F.col("user_id") - 1)
    return t.events.select("event_id", "event_type", parent.alias("parent_id"))


# Documents as versions; a target that lacks one language and has other texts in one source.
DOC_VERSIONS = """doc_versions AS (
  SELECT doc_id, doc_id + 500000 AS version_id, source || '-' || lang AS title,
         CASE WHEN source = 'src7' THEN upper(source) ELSE NULL END AS external, md5(text) AS checksum,
         CASE WHEN lang = 'es' THEN 'https://example.com/' || doc_id END AS url,
         n_chars AS modified, n_chars AS size
  FROM documents)"""
DOC_VERSIONS_TARGET = """doc_versions_target AS (
  SELECT doc_id + 9000000 AS doc_id, version_id + 9000000 AS version_id, title, external,
         CASE WHEN title LIKE 'src3-%' THEN md5(checksum) ELSE checksum END AS checksum,
         url, CASE WHEN title LIKE 'src4-%' THEN modified - 1 ELSE modified END AS modified, size
  FROM doc_versions WHERE title NOT LIKE '%-de')"""
DOC_LINKS = """doc_links AS (
  SELECT doc_id AS link_id, doc_id // 3 AS parent_id, doc_id, 'V' AS share FROM documents
  UNION ALL
  SELECT doc_id + 10000000, doc_id // 3 + 1, doc_id, 'C' FROM labels)"""
DOC_LINKS_TARGET = """doc_links_target AS (
  SELECT l.link_id + 20000000 AS link_id, x.target_id AS parent_id, l.doc_id + 9000000 AS doc_id
  FROM doc_links l JOIN customer_xref x ON l.parent_id = x.source_id)"""
DOCS = ",\n".join((CUSTOMER_TARGET, CUSTOMER_XREF, DOC_VERSIONS, DOC_VERSIONS_TARGET, DOC_LINKS, DOC_LINKS_TARGET))


def doc_versions(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        (F.col("doc_id") + 500000).alias("version_id"),
        F.concat_ws("-", "source", "lang").alias("title"),
        F.when(F.col("source") == "src7", F.upper("source")).alias("external"),
        F.md5("text").alias("checksum"),
        F.when(F.col("lang") == "es", F.concat(F.lit("https://example.com/"), F.col("doc_id").cast("string"))).alias("url"),
        F.col("n_chars").alias("modified"),
        F.col("n_chars").alias("size"),
    )


def doc_versions_target(t: Tables) -> DataFrame:
    title = F.col("title")
    return (
        doc_versions(t)
        .where(~title.endswith("-de"))
        .select(
            (F.col("doc_id") + 9000000).alias("doc_id"),
            (F.col("version_id") + 9000000).alias("version_id"),
            "title",
            "external",
            F.when(title.startswith("src3-"), F.md5("checksum")).otherwise(F.col("checksum")).alias("checksum"),
            "url",
            F.when(title.startswith("src4-"), F.col("modified") - 1).otherwise(F.col("modified")).alias("modified"),
            "size",
        )
    )


def doc_links(t: Tables) -> DataFrame:
    third = F.floor(F.col("doc_id") / 3)
    own = t.documents.select(F.col("doc_id").alias("link_id"), third.alias("parent_id"), "doc_id", F.lit("V").alias("share"))
    more = t.labels.select(
        (F.col("doc_id") + 10000000).alias("link_id"), (third + 1).alias("parent_id"), "doc_id", F.lit("C").alias("share")
    )
    return own.unionByName(more)


def doc_links_target(t: Tables) -> DataFrame:
    return doc_links(t).join(customer_xref(t), F.col("parent_id") == F.col("source_id")).select(
        (F.col("link_id") + 20000000).alias("link_id"), F.col("target_id").alias("parent_id"), (F.col("doc_id") + 9000000).alias("doc_id")
    )


def with_ctes(*fragments: str, select: str) -> str:
    return "WITH " + ",\n".join(fragments) + "\n" + select
