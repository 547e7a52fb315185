"""Column choice, names and order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.text import split_name
from rowferry.operators import project
from suite import fixtures as X
from suite.registry import Tables, case


@case("p1_column_projection", "SELECT c_mktsegment, c_custkey, c_name FROM customer")
def p1(t: Tables) -> DataFrame:
    return project.project(t.customer, ["c_mktsegment"], "c_custkey", ["c_name"])


def described(t: Tables) -> DataFrame:
    """Customers with the flags a catalogue keeps about each column."""
    flags = {
        "c_custkey": {"createable": False, "updateable": False},
        "c_name": {"custom": True},
        "c_nationkey": {"lookup": True},
        "c_acctbal": {"custom": True, "updateable": False},
        "c_mktsegment": {"custom": True, "type": "picklist"},
    }
    return t.customer.select(*[F.col(c).alias(c, metadata=flags[c]) for c in t.customer.columns])


@case("p2_select_by_keyword", "SELECT c_name, c_mktsegment FROM customer")
def p2(t: Tables) -> DataFrame:
    return project.by_keyword(described(t), ["custom_true", "updateable_true"])


@case("p2_select_by_type", "SELECT c_mktsegment FROM customer")
def p2_type(t: Tables) -> DataFrame:
    return project.by_keyword(described(t), ["type_picklist"])


@case("p2_select_all_but_restricted", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def p2_all(t: Tables) -> DataFrame:
    return project.by_keyword(described(t), ["all"], restricted=["c_nationkey"])


@case(
    "p3_compound_expansion",
    """SELECT c_custkey, n_name AS "BillingCity", r_name AS "BillingCountry" FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def p3(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    address = F.struct(F.col("n_name").alias("BillingCity"), F.col("r_name").alias("BillingCountry"))
    rows = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("Address", address)
    return project.select_compounds(rows, ["c_custkey", "Address"])


@case("p4_column_exclusion", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def p4(t: Tables) -> DataFrame:
    return project.exclude(t.orders, "O_TOTALPRICE; o_orderdate;O_OrderPriority")


@case("p5_unknown_column_pruning", "SELECT c_name, c_acctbal FROM customer")
def p5(t: Tables) -> DataFrame:
    return project.prune_unknown(t.customer, ["C_NAME", "c_acctbal", "c_phone", "c_custkey"], X.customer_target(t))


@case("p6_writable_columns", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def p6(t: Tables) -> DataFrame:
    return project.writable(t.customer, described(t).schema, "c_custkey")


@case("p6_writable_without_excluded", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def p6_excluded(t: Tables) -> DataFrame:
    return project.writable(t.customer, described(t).schema, "c_custkey", excluded=["c_nationkey", "c_mktsegment"])


@case("p7_per_operation_pruning", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def p7(t: Tables) -> DataFrame:
    barred = [f.name for f in described(t).schema.fields if not f.metadata.get("updateable", True)]
    return project.for_operation(t.customer, barred, "c_custkey")


NAMES = {"c_name": "Title__c", "c_acctbal": "Balance__c"}


@case("p8_rename_to_target", 'SELECT c_custkey, c_name AS "Title__c", c_nationkey, c_acctbal AS "Balance__c", c_mktsegment FROM customer')
def p8(t: Tables) -> DataFrame:
    rules = [("customer", "", "Account"), ("customer", "c_name", "Title__c"), ("customer", "c_acctbal", "Balance__c"), ("customer", "c_name", "Other")]
    return project.rename(t.customer, project.rename_map(rules, "customer")[1])


@case("p9_rename_to_source", "SELECT * FROM customer")
def p9(t: Tables) -> DataFrame:
    return project.rename_back(project.rename(t.customer, NAMES), NAMES)


@case(
    "p12_relationship_path",
    """SELECT c_custkey, n_name AS "Nation.n_name", r_name AS "Nation.Region.r_name" FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def p12(t: Tables) -> DataFrame:
    region = F.struct("r_name").alias("Region")
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.struct("n_name", region).alias("Nation")
    )
    rows = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return project.relationship(rows, ["c_custkey", "Nation.n_name", "Nation.Region.r_name"])


@case("p13_column_order", """SELECT c_custkey AS "Id", c_acctbal AS "Old Id", c_mktsegment AS a, c_nationkey AS b, c_name AS "Errors" FROM customer""")
def p13(t: Tables) -> DataFrame:
    return project.order_columns(t.customer.toDF("Id", "Errors", "b", "Old Id", "a"))


@case("p14_header_repair", 'SELECT o_orderkey AS "Id", o_custkey AS "CustKey", o_totalprice AS "Total" FROM orders')
def p14(t: Tables) -> DataFrame:
    dirty = t.orders.select(
        F.col("o_orderkey").alias(" id "), F.col("o_orderstatus").alias("CUSTKEY"), F.col("o_custkey").alias("CustKey"),
        F.col("o_totalprice").alias("total "), F.col("o_orderpriority").alias("Other"),
    )
    return project.repair_names(dirty, ["Id", "CustKey", "Total"], drop_others=True)


@case("p15_strip_ids_and_lookups", 'SELECT o_orderstatus, o_totalprice, c_name AS "Customer.Name" FROM orders JOIN customer ON o_custkey = c_custkey')
def p15(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("c_custkey").alias("Customer.Id"), F.col("c_name").alias("Customer.Name"),
    )
    return project.strip_ids(rows, "O_ORDERKEY", ["o_custkey"])


@case("p16_old_id_column", """SELECT c_name, CAST(c_custkey AS VARCHAR) AS "Old Id", CAST(NULL AS VARCHAR) AS "Errors" FROM customer""")
def p16(t: Tables) -> DataFrame:
    return project.audit_columns(t.customer.select(F.col("c_custkey").alias("_src_id"), "c_name", F.lit(True).alias("_processed")))


@case("p17_clone_columns", "SELECT s_suppkey, s_nationkey FROM supplier")
def p17(t: Tables) -> DataFrame:
    return project.clone(t.supplier, include=["s_suppkey", "s_name", "s_nationkey"], exclude_=["s_name"])


@case("p19_flatten_nested_lists", "SELECT doc_id, unnest(flatten(list_transform(string_split(source || ' ' || lang, ' '), lambda w: string_split(w, 'r')))) AS piece FROM documents")
def p19(t: Tables) -> DataFrame:
    words = F.split(F.concat_ws(" ", "source", "lang"), " ")
    rows = t.documents.select("doc_id", F.transform(words, lambda w: F.split(w, "r")).alias("pieces"))
    return project.flatten_lists(rows, "pieces", "piece")


@case(
    "k14_person_names",
    """SELECT c_custkey, c_mktsegment AS first, c_name AS second FROM customer""",
)
def k14(t: Tables) -> DataFrame:
    first, second = split_name(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("  "), F.col("c_name"), F.lit(" third")))
    return t.customer.select("c_custkey", first.alias("first"), second.alias("second"))
