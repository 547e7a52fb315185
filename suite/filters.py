"""Filters, order and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.operators import filters as f
from rowferry.operators import ordering, ranking
from suite import fixtures as X
from suite.registry import Tables, case

WORDS = ["éon", "token", "the"]


@case("f1_where_filter", "SELECT * FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'O'")
def f1(t: Tables) -> DataFrame:
    return f.where(t.orders, "o_totalprice > 100000 AND o_orderstatus = 'O'")


@case("f2_source_records_filter", "SELECT * FROM customer WHERE c_acctbal > 100 AND c_mktsegment LIKE 'B%'")
def f2(t: Tables) -> DataFrame:
    return f.source_records_filter(t.customer, "c_acctbal > 100 AND c_mktsegment LIKE 'B%'")


@case("f2_broken_filter_keeps_all", "SELECT * FROM customer")
def f2_broken(t: Tables) -> DataFrame:
    return f.source_records_filter(t.customer, "no_such_column > ")


@case("f3_target_records_filter", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (1, 2, 3)")
def f3(t: Tables) -> DataFrame:
    return f.target_records_filter(t.customer, "c_nationkey IN (1, 2, 3)").select("c_custkey", "c_name")


@case("f4_in_list_filter", "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def f4(t: Tables) -> DataFrame:
    return f.in_keys(t.orders, "o_custkey", t.customer.where("c_acctbal < 0"), "c_custkey")


def with_flag(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice", F.when(F.col("o_orderstatus") == "F", True).alias("is_deleted"))


@case("f6_without_deleted_rows", "SELECT o_orderkey, o_totalprice, CAST(NULL AS BOOLEAN) AS is_deleted FROM orders WHERE o_orderstatus <> 'F'")
def f6(t: Tables) -> DataFrame:
    return f.not_deleted(with_flag(t), "is_deleted")


@case("f6_with_deleted_rows", "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN TRUE END AS is_deleted FROM orders")
def f6_all(t: Tables) -> DataFrame:
    return f.target_read(with_flag(t), "o_totalprice > 0", "is_deleted", all_rows=True)


@case("f7_hierarchy_delete_reads_all", "SELECT * FROM orders")
def f7(t: Tables) -> DataFrame:
    return f.target_read(t.orders, "o_orderstatus = 'F'", hierarchy_delete=True)


@case("f8_combined_predicates", "SELECT * FROM orders WHERE (o_orderstatus = 'F' OR o_orderstatus = 'O') AND (o_totalprice > 200000 OR o_orderpriority = '5-LOW')")
def f8(t: Tables) -> DataFrame:
    status = f.any_of("o_orderstatus = 'F'", "o_orderstatus = 'O'")
    return t.orders.where(f.all_of(status, f.any_of("o_totalprice > 200000", "o_orderpriority = '5-LOW'")))


# RE2 has no look-behind; its own word boundary is the ASCII one that is meant.
WORD_SQL = r"'(?i)\b(éon|token|the|eon)\b'"


@case("f9_bad_words_filter", f"SELECT doc_id, source FROM documents WHERE regexp_matches(text, {WORD_SQL})")
def f9(t: Tables) -> DataFrame:
    return f.keep_words(t.documents, ["text"], WORDS).select("doc_id", "source")


@case("k17_word_highlight", rf"SELECT doc_id, regexp_replace(text, {WORD_SQL}, '***\1***', 'g') AS text FROM documents WHERE regexp_matches(text, {WORD_SQL})")
def k17(t: Tables) -> DataFrame:
    return f.keep_words(t.documents.select("doc_id", "text"), ["text"], WORDS, mark=True)


@case("f10_record_filter_hook", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def f10(t: Tables) -> DataFrame:
    return f.filter_hook(t.events.select("event_id", "event_type"), lambda df: df.where("event_type IN ('click', 'view')"))


@case("f11_file_size_filter", "SELECT doc_id, n_chars FROM documents WHERE lang = 'en' AND n_chars <= 2000 AND source <> 'src1'")
def f11(t: Tables) -> DataFrame:
    rows = t.documents.withColumn("latest", F.col("lang") == "en")
    return f.latest_files(rows, "latest", "n_chars", 2000, "source <> 'src1'").select("doc_id", "n_chars")


@case("f12_group_default_filter", "SELECT event_id AS Id FROM events WHERE event_type = 'click'")
def f12(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "Queue").otherwise(F.col("event_type"))
    return f.group_filter(t.events.select(F.col("event_id").alias("Id"), kind.alias("Type"))).select("Id")


@case("f12_group_custom_filter", "SELECT event_id AS Id FROM events WHERE event_type = 'view'")
def f12_custom(t: Tables) -> DataFrame:
    return f.group_filter(t.events.select(F.col("event_id").alias("Id"), F.col("event_type").alias("Type")), "Type = 'view'").select("Id")


@case("f13_feed_content_filter", "SELECT conv_id, turn FROM conversations WHERE role = 'assistant'")
def f13(t: Tables) -> DataFrame:
    kind = F.when(F.col("role") == "assistant", "ContentPost").otherwise("TextPost")
    return f.feed_content(t.conversations.withColumn("Type", kind)).select("conv_id", "turn")


@case("f14_person_split", "SELECT c_custkey, c_nationkey BETWEEN 5 AND 9 OR c_nationkey < 5 AS person FROM customer")
def f14(t: Tables) -> DataFrame:
    from suite.plans import people

    rows = people(t).select(F.col("Id").alias("c_custkey"), "IsPersonAccount")
    person = f.person_side(rows, "IsPersonAccount", True).select("c_custkey", F.lit(True).alias("person"))
    return person.unionByName(f.person_side(rows, "IsPersonAccount", False).select("c_custkey", F.lit(False).alias("person")))


@case("f15_blank_id_filter", X.with_ctes(X.ORDERS_NO_ID, select="SELECT ord FROM orders_no_id WHERE trim(id) <> ''"))
def f15(t: Tables) -> DataFrame:
    return f.with_id(X.orders_no_id(t), "id").select("ord")


@case("o1_order_by", "SELECT o_orderkey, o_totalprice AS total FROM orders ORDER BY total DESC, o_orderkey")
def o1(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("total"))
    return ordering.order_rows(rows, "o_totalprice DESC, o_orderkey", {"o_totalprice": "total"})


@case("o2_limit_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 10")
def o2(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return ordering.limit_rows(ordering.order_rows(rows, "o_totalprice DESC, o_orderkey"), 50, 10)


@case(
    "o4_link_order",
    X.with_ctes(
        X.DOC_LINKS,
        select="SELECT parent_id, link_id, doc_id FROM doc_links QUALIFY row_number() OVER (PARTITION BY parent_id ORDER BY share, doc_id DESC, link_id) = 1",
    ),
)
def o4(t: Tables) -> DataFrame:
    rows, order = ordering.order_keys(X.doc_links(t), "share, doc_id DESC, link_id")
    return ranking.first_per_key(rows, ["parent_id"], order).select("parent_id", "link_id", "doc_id")
