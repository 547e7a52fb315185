"""Joins (J1-J35)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.keys import key_text
from rowferry.operators import closure, documents, formula, lookups, matching, pairing
from suite import fixtures as X
from suite.registry import Tables, case

XREF = (X.CUSTOMER_TARGET, X.CUSTOMER_XREF)


@case(
    "j1_external_id_match",
    X.with_ctes(
        X.CUSTOMER_DUP, X.CUSTOMER_TARGET,
        select="""SELECT s.c_custkey AS source_id, t.target_id FROM customer_dup s JOIN customer_target t ON s.c_name = t.c_name
  QUALIFY row_number() OVER (PARTITION BY s.c_name ORDER BY s.c_custkey DESC) = 1""",
    ),
)
def j1(t: Tables) -> DataFrame:
    return matching.match(X.customer_dup(t), X.customer_target(t), "c_custkey", "target_id", ["c_name"])


LINEITEM_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@case(
    "j2_composite_key_match",
    """WITH s AS (SELECT p_partkey, concat_ws(';', nullif(p_name, ''), nullif(p_brand, ''), nullif(p_type, '')) AS k FROM part),
  tgt AS (SELECT k, max(p_partkey) + 800000 AS target_id FROM s WHERE k NOT LIKE '%Brand#1;%' GROUP BY k)
  SELECT a.source_id, tgt.target_id FROM (SELECT k, max(p_partkey) AS source_id FROM s GROUP BY k) a JOIN tgt ON a.k = tgt.k""",
)
def j2(t: Tables) -> DataFrame:
    target = t.part.where("p_brand <> 'Brand#1'").withColumn("target_id", F.col("p_partkey") + 800000)
    return matching.match(t.part, target, "p_partkey", "target_id", ["p_name", "p_brand", "p_type"])


def customer_nation(t: Tables, customers: DataFrame) -> DataFrame:
    nation = t.nation.select(F.col("n_nationkey"), F.struct("n_name", "n_regionkey").alias("Nation"))
    return customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


@case(
    "j3_nested_relationship_match",
    X.with_ctes(
        X.CUSTOMER_TARGET,
        select="""SELECT s.source_id, g.target_id FROM
  (SELECT n_name || ';' || c_mktsegment AS k, max(c_custkey) AS source_id FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) s
  JOIN (SELECT n_name || ';' || c_mktsegment AS k, max(target_id) AS target_id FROM customer_target JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) g ON s.k = g.k""",
    ),
)
def j3(t: Tables) -> DataFrame:
    source, target = customer_nation(t, t.customer), customer_nation(t, X.customer_target(t))
    return matching.match(source, target, "c_custkey", "target_id", ["Nation.n_name", "c_mktsegment"])


@case(
    "j4_lookup_remap",
    X.with_ctes(
        *XREF,
        select="SELECT o.o_orderkey, x.target_id AS o_custkey FROM orders o LEFT JOIN customer_xref x ON o.o_custkey = x.source_id",
    ),
)
def j4(t: Tables) -> DataFrame:
    return lookups.remap(t.orders.select("o_orderkey", "o_custkey"), X.customer_xref(t), "o_custkey")


@case(
    "j4_lineitem_to_orders",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey + 70000000 END AS order_target
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def j4_lineitem(t: Tables) -> DataFrame:
    known = t.orders.where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("source_id"), (F.col("o_orderkey") + 70000000).alias("target_id")
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lookups.remap(rows, known, "l_orderkey", "order_target")


@case(
    "j5_children_of_parents",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def j5(t: Tables) -> DataFrame:
    chosen = t.customer.where("c_mktsegment = 'BUILDING'")
    return closure.children_of(t.orders.select("o_orderkey", "o_custkey"), [("o_custkey", chosen, "c_custkey")])


@case(
    "j5_children_by_several_lookups",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
  WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#4') OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""",
)
def j5_or(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts, suppliers = t.part.where("p_brand = 'Brand#4'"), t.supplier.where("s_acctbal < 0")
    return closure.children_of(rows, [("l_partkey", parts, "p_partkey"), ("l_suppkey", suppliers, "s_suppkey")])


@case(
    "j6_parents_of_children",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
)
def j6(t: Tables) -> DataFrame:
    chosen = t.orders.where("o_totalprice > 300000")
    return closure.parents_of(t.customer.select("c_custkey", "c_name"), "c_custkey", [(chosen, "o_custkey")])


_TO_THE_TOP = f"""WITH RECURSIVE {X.EVENT_CHAIN},
reached AS (
  SELECT event_id, parent_id FROM event_chain WHERE event_type = 'purchase'
  UNION
  SELECT e.event_id, e.parent_id FROM event_chain e JOIN reached r ON e.event_id = r.parent_id)
SELECT event_id, parent_id FROM reached"""


@case("j7_self_reference_expansion", _TO_THE_TOP)
def j7(t: Tables) -> DataFrame:
    chain = X.event_chain(t)
    chosen = chain.where("event_type = 'purchase'")
    return closure.with_self_references(chain, "event_id", "parent_id", chosen).select("event_id", "parent_id")


@case(
    "j8_missing_parent_report",
    X.with_ctes(
        *XREF, X.ORDERS_DAMAGED,
        select="""SELECT CAST(o_orderkey AS VARCHAR) AS "Record Id", 'o_custkey' AS "Lookup field name", 'o_cust_name' AS "Lookup reference field name",
  'orders' AS "sObject name", 'customer' AS "Parent SObject name", 'c_name' AS "Parent ExternalId field name", o_cust_name AS "Missing parent External Id value"
  FROM orders_damaged WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT source_id FROM customer_xref)""",
    ),
)
def j8(t: Tables) -> DataFrame:
    return lookups.missing_parents(
        X.orders_damaged(t), X.customer_xref(t), "o_orderkey", "o_custkey", "orders", "customer", "c_name", "o_cust_name"
    )


@case(
    "j9_filtered_target_read",
    X.with_ctes(
        X.CUSTOMER_TARGET,
        select="SELECT target_id, c_name FROM customer_target WHERE c_name IN (SELECT c_name FROM customer WHERE c_acctbal > 5000)",
    ),
)
def j9(t: Tables) -> DataFrame:
    target = X.customer_target(t).select("target_id", "c_name")
    return matching.target_subset(target, "c_name", t.customer.where("c_acctbal > 5000"), "c_name")


@case(
    "j11_polymorphic_lookup",
    """SELECT event_id, coalesce(u.c_custkey + 100, g.s_suppkey + 900000) AS owner FROM events
  LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 2000) u ON user_id = u.c_custkey LEFT JOIN supplier g ON user_id = g.s_suppkey""",
)
def j11(t: Tables) -> DataFrame:
    users = t.customer.where("c_acctbal > 2000").select(F.col("c_custkey").alias("source_id"), (F.col("c_custkey") + 100).alias("target_id"))
    groups = t.supplier.select(F.col("s_suppkey").alias("source_id"), (F.col("s_suppkey") + 900000).alias("target_id"))
    return lookups.polymorphic(t.events.select("event_id", "user_id"), "user_id", users, groups, "owner").drop("user_id")


@case(
    "j12_lookup_value_to_id",
    X.with_ctes(
        X.ORDERS_DAMAGED,
        select="""SELECT o_cust_name AS lookup_value, max_by(o_custkey, o_orderkey) AS lookup_id FROM orders_damaged WHERE o_custkey IS NOT NULL GROUP BY 1""",
    ),
)
def j12(t: Tables) -> DataFrame:
    return lookups.value_to_id(X.orders_damaged(t), "o_custkey", ["o_cust_name"], ["o_orderkey"])


@case(
    "j13_relink_after_mapping",
    X.with_ctes(
        X.ORDERS_DAMAGED,
        select="""SELECT o_orderkey, coalesce(c.c_custkey, o.o_custkey) AS o_custkey, o_cust_name FROM orders_damaged o LEFT JOIN customer c ON o.o_cust_name = c.c_name""",
    ),
)
def j13(t: Tables) -> DataFrame:
    parents = t.customer.select(F.col("c_name").alias("lookup_value"), F.col("c_custkey").alias("lookup_id"))
    return lookups.relink(X.orders_damaged(t), "o_custkey", "o_cust_name", parents)


@case(
    "j14_merge_by_id",
    """SELECT o.o_orderkey, coalesce(n.status, 'first') AS status, CASE WHEN n.o_orderkey IS NULL THEN 'E' ELSE n.err END AS err FROM orders o
  LEFT JOIN (SELECT o_orderkey, 'purged' AS status, CASE WHEN o_totalprice > 400000 THEN 'big' END AS err FROM orders WHERE o_orderstatus = 'F') n ON o.o_orderkey = n.o_orderkey""",
)
def j14(t: Tables) -> DataFrame:
    first = t.orders.select("o_orderkey", F.lit("first").alias("status"), F.lit("E").alias("err"))
    second = t.orders.where("o_orderstatus = 'F'").select(
        "o_orderkey", F.lit("purged").alias("status"), F.when(F.col("o_totalprice") > 400000, "big").alias("err")
    )
    return matching.merge_by_id(first, second, "o_orderkey")


@case(
    "j15_parent_external_columns",
    """SELECT o_orderkey, o_custkey, c_name AS "Customer.c_name", c_mktsegment AS "Customer.c_mktsegment" FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def j15(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey")
    return lookups.parent_columns(rows, t.customer, "o_custkey", "c_custkey", "Customer", ["c_name", "c_mktsegment"])


CHECKED = """checked AS (
  SELECT d.o_orderkey, d.o_custkey, d.o_cust_name, i.c_name AS id_name, r.c_custkey AS ref_id
  FROM orders_damaged d LEFT JOIN customer i ON d.o_custkey = i.c_custkey LEFT JOIN customer r ON d.o_cust_name = r.c_name)"""
STATE = """CASE WHEN o_custkey IS NULL OR o_cust_name IS NULL THEN 'blank' WHEN id_name IS NOT NULL AND id_name <> o_cust_name THEN 'reference_fixed'
  WHEN id_name IS NOT NULL THEN 'ok' WHEN ref_id IS NOT NULL AND ref_id <> o_custkey THEN 'id_fixed' WHEN ref_id IS NOT NULL THEN 'ok' ELSE 'conflict' END"""


def customer_keys(t: Tables) -> lookups.ParentKeys:
    return lookups.parent_keys(t.customer, "c_custkey", ["c_name"], ["c_custkey"])


@case(
    "j16_lookup_conflict_repair",
    X.with_ctes(
        X.ORDERS_DAMAGED, CHECKED,
        select=f"""SELECT o_orderkey, CASE WHEN state = 'id_fixed' THEN ref_id ELSE o_custkey END AS o_custkey,
  CASE WHEN state = 'reference_fixed' THEN id_name ELSE o_cust_name END AS o_cust_name, state FROM (SELECT *, {STATE} AS state FROM checked)""",
    ),
)
def j16(t: Tables) -> DataFrame:
    return lookups.repair_conflicts(X.orders_damaged(t), "o_custkey", "o_cust_name", customer_keys(t), "state")


NEW_PARENT = "upper(substr(sha256('customer|' || o_cust_name), 1, 18))"


@case(
    "j17_missing_lookup_id_column",
    X.with_ctes(
        X.ORDERS_DAMAGED,
        select=f"""SELECT o_orderkey, o_cust_name, coalesce(CAST(c.c_custkey AS VARCHAR), {NEW_PARENT}) AS cust_id
  FROM orders_damaged LEFT JOIN customer c ON o_cust_name = c.c_name""",
    ),
)
def j17(t: Tables) -> DataFrame:
    rows = X.orders_damaged(t).drop("o_custkey")
    return lookups.fill_lookup_id(rows, "cust_id", "o_cust_name", customer_keys(t), "customer", generate=True)


@case(
    "j18_missing_reference_column",
    X.with_ctes(
        X.ORDERS_DAMAGED,
        select="SELECT o_orderkey, o_custkey, c.c_name AS cust_name FROM orders_damaged LEFT JOIN customer c ON o_custkey = c.c_custkey",
    ),
)
def j18(t: Tables) -> DataFrame:
    rows = X.orders_damaged(t).drop("o_cust_name")
    return lookups.fill_reference(rows, "o_custkey", "cust_name", customer_keys(t), "customer")


@case(
    "j19_synthesised_parents",
    X.with_ctes(
        X.ORDERS_DAMAGED,
        select=f"""SELECT DISTINCT {NEW_PARENT} AS id, o_cust_name AS c_name FROM orders_damaged WHERE o_cust_name NOT IN (SELECT c_name FROM customer)""",
    ),
)
def j19(t: Tables) -> DataFrame:
    return lookups.new_parents_from_references(X.orders_damaged(t), "o_cust_name", customer_keys(t), "customer", "id", "c_name")


@case(
    "j20_propagate_parent_ids",
    X.with_ctes(
        X.ORDERS_DAMAGED,
        select="""SELECT o_orderkey, o_cust_name, coalesce('N' || c.c_custkey, CAST(o.o_custkey AS VARCHAR)) AS o_custkey, CASE WHEN c.c_custkey IS NOT NULL THEN 'N' || c.c_custkey END AS "Customer.Id"
  FROM orders_damaged o LEFT JOIN customer c ON o.o_cust_name = c.c_name""",
    ),
)
def j20(t: Tables) -> DataFrame:
    fresh = t.customer.select(F.concat(F.lit("N"), F.col("c_custkey").cast("string")).alias("id"), "c_name", "c_custkey")
    keys = lookups.parent_keys(fresh, "id", ["c_name"], ["c_custkey"])
    return lookups.propagate_parent_ids(X.orders_damaged(t), "o_custkey", "Customer.Id", "o_cust_name", keys)


@case(
    "j21_pair_by_key_with_duplicates",
    """WITH a AS (SELECT l_orderkey, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS i FROM lineitem WHERE l_returnflag <> 'A'),
  b AS (SELECT l_orderkey, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS i FROM lineitem WHERE l_returnflag = 'A')
  SELECT x.l_orderkey AS pair_key, x.n AS ordinal, x.i AS left_id, y.i AS right_id
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY i) AS n FROM a) x
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY i) AS n FROM b) y ON x.l_orderkey = y.l_orderkey AND x.n = y.n""",
)
def j21(t: Tables) -> DataFrame:
    line = F.col("l_partkey") * 100000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")
    rows = t.lineitem.select("l_orderkey", "l_returnflag", line.alias("i"))
    return pairing.pair_by_key(
        rows.where("l_returnflag <> 'A'"), rows.where("l_returnflag = 'A'"), "l_orderkey", "i", "i", ["i"], ["i"]
    )


@case(
    "j22_pair_by_content",
    """WITH a AS (SELECT o_orderkey AS i, sha256(o_custkey || '|' || o_orderpriority || '|' || o_orderstatus) AS h FROM
    (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, replace(o_orderpriority, ' ', '') AS o_orderpriority, o_orderstatus FROM orders)),
  x AS (SELECT i, h, row_number() OVER (PARTITION BY h ORDER BY i) AS n FROM a),
  y AS (SELECT i, h, row_number() OVER (PARTITION BY h ORDER BY i) AS n FROM a WHERE i IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 100000))
  SELECT x.h AS digest, x.n AS ordinal, x.i AS left_id, y.i AS right_id FROM x LEFT JOIN y ON x.h = y.h AND x.n = y.n""",
)
def j22(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    skip = ["o_orderkey", "o_totalprice"]
    return pairing.pair_by_content(
        rows, rows.where("o_totalprice > 100000"), "o_orderkey", "o_orderkey", ["o_orderkey"], ["o_orderkey"], skip
    )


@case(
    "j23_formula_input_same_row",
    X.with_ctes(
        *XREF,
        select="""SELECT c.c_custkey, t.c_acctbal AS target_balance FROM customer c LEFT JOIN customer_xref x ON c.c_custkey = x.source_id LEFT JOIN customer_target t ON x.target_id = t.target_id""",
    ),
)
def j23(t: Tables) -> DataFrame:
    links = matching.match(t.customer, X.customer_target(t), "c_custkey", "target_id", ["c_name"], payload=["c_acctbal"])
    return formula.same_row(t.customer.select("c_custkey"), links, "c_custkey", "source_id", "_t_c_acctbal", "target_balance")


@case(
    "j24_formula_input_parent",
    """SELECT c_custkey, CASE WHEN home IS NOT NULL THEN h.n_name ELSE n.n_name END AS nation FROM
  (SELECT c_custkey, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey + 20 END AS home FROM customer)
  LEFT JOIN nation n ON c_nationkey = n.n_nationkey LEFT JOIN nation h ON home = h.n_nationkey""",
)
def j24(t: Tables) -> DataFrame:
    home = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey") + 20)
    rows = t.customer.select("c_custkey", "c_nationkey", home.alias("home"))
    return formula.from_parent(rows, ["c_nationkey", "home"], t.nation, "n_nationkey", "n_name", "nation").select("c_custkey", "nation")


@case(
    "j25_formula_input_child",
    """SELECT c_custkey, min_by(o_totalprice, o_orderkey) AS first_total FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
)
def j25(t: Tables) -> DataFrame:
    return formula.from_child(
        t.customer.select("c_custkey"), "c_custkey", t.orders, ["o_custkey"], "o_totalprice", ["o_orderkey"], "first_total"
    )


@case(
    "j26_lookup_by_equality",
    """SELECT c_custkey, s_name AS supplier FROM customer LEFT JOIN (SELECT s_nationkey, min_by(s_name, s_suppkey) AS s_name FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey""",
)
def j26(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_nationkey")
    return formula.by_equality(rows, t.supplier, [("c_nationkey", "s_nationkey")], "s_name", ["s_suppkey"], "supplier").drop("c_nationkey")


@case(
    "j26_lookup_by_comparison",
    """SELECT c_custkey, min_by(s_name, s_suppkey) AS supplier FROM customer LEFT JOIN supplier ON c_nationkey = s_nationkey AND s_acctbal <= c_acctbal GROUP BY c_custkey""",
)
def j26_comparison(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    out = formula.by_comparison(
        rows, t.supplier, [("c_nationkey", "s_nationkey")], ("s_acctbal", "<=", "c_acctbal"), "s_name", ["s_suppkey"], "supplier"
    )
    return out.select("c_custkey", "supplier")


@case(
    "j26_lookup_by_free_condition",
    """SELECT c_custkey, min_by(n_name, n_nationkey) AS nation FROM customer LEFT JOIN nation ON n_nationkey > c_nationkey AND length(n_name) <> length(c_mktsegment) GROUP BY c_custkey""",
)
def j26_free(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")

    def names_differ(nation):
        return F.length(nation["n_name"]) != F.length("c_mktsegment")

    return formula.by_condition(
        rows, t.nation, [("n_nationkey", ">", "c_nationkey")], "n_name", ["n_nationkey"], "nation", names_differ, ["c_mktsegment"]
    ).select("c_custkey", "nation")


@case(
    "j26_lookup_by_range",
    """WITH days AS (SELECT DISTINCT o_orderdate AS d FROM orders),
  hits AS (SELECT d, min_by(p.o_orderkey, (p.o_totalprice, p.o_orderkey)) AS k FROM days JOIN orders p ON p.o_orderdate > d AND p.o_orderdate <= d + INTERVAL 7 DAY GROUP BY d)
  SELECT o_orderkey, k AS next_cheapest FROM orders LEFT JOIN hits ON o_orderdate = d""",
)
def j26_range(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").alias("day"), (F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")).alias("until"))
    week = [("o_orderdate", ">", "day"), ("o_orderdate", "<=", "until")]
    out = formula.by_condition(rows, t.orders, week, "o_orderkey", ["o_totalprice", "o_orderkey"], "next_cheapest")
    return out.select("o_orderkey", "next_cheapest")


@case(
    "j26_lookup_by_range_of_key",
    """SELECT a.o_orderkey, min_by(b.o_orderkey, (b.o_orderdate, b.o_orderkey)) AS answer FROM orders a
  LEFT JOIN orders b ON b.o_custkey = a.o_custkey AND b.o_orderdate >= a.o_orderdate AND b.o_orderdate <= a.o_orderdate + INTERVAL 365 DAY
  AND b.o_orderpriority <> a.o_orderpriority GROUP BY a.o_orderkey""",
)
def j26_range_of_key(t: Tables) -> DataFrame:
    until = F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS")
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("day"), until.alias("until"), F.col("o_orderpriority").alias("priority"))
    terms = [("o_custkey", "=", "o_custkey"), ("o_orderdate", ">=", "day"), ("o_orderdate", "<=", "until")]

    def other_priority(order):
        return order["o_orderpriority"] != F.col("priority")

    out = formula.by_condition(rows, t.orders, terms, "o_orderkey", ["o_orderdate", "o_orderkey"], "answer", other_priority, ["priority"])
    return out.select("o_orderkey", "answer")


@case(
    "j27_constant_alias",
    """SELECT o_orderkey, (SELECT min_by(c_name, c_custkey) FROM customer WHERE c_acctbal > 9000) AS reference FROM orders""",
)
def j27(t: Tables) -> DataFrame:
    return formula.constant(t.orders.select("o_orderkey"), t.customer, "c_name", ["c_custkey"], "reference", "c_acctbal > 9000")


@case(
    "j28_person_contact_backfill",
    X.with_ctes(
        *XREF,
        """contacts AS (SELECT o_orderkey AS id, o_custkey AS account FROM orders WHERE o_orderstatus <> 'P')""",
        """target_contacts AS (SELECT o_orderkey + 40000000 AS id, x.target_id AS account FROM orders JOIN customer_xref x ON o_custkey = x.source_id WHERE o_orderpriority = '1-URGENT')""",
        """linked AS (SELECT o_orderkey AS source_id FROM orders WHERE o_orderpriority = '2-HIGH')""",
        select="""SELECT s.id AS source_id, g.id AS target_id FROM
  (SELECT account, max(id) AS id FROM contacts WHERE id NOT IN (SELECT source_id FROM linked) GROUP BY 1) s JOIN customer_xref x ON s.account = x.source_id
  JOIN (SELECT account, min(id) AS id FROM target_contacts GROUP BY 1) g ON x.target_id = g.account""",
    ),
)
def j28(t: Tables) -> DataFrame:
    xref = X.customer_xref(t)
    contacts = t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("account"))
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    implicit = lookups.remap(urgent, xref, "o_custkey", "account").where("account IS NOT NULL")
    implicit = implicit.select((F.col("o_orderkey") + 40000000).alias("id"), "account")
    linked = t.orders.where("o_orderpriority = '2-HIGH'").select(F.col("o_orderkey").alias("source_id"))
    return lookups.person_contacts(contacts, implicit, xref, linked, "id", "account", ["id"])


MATCHED = """latest AS (SELECT doc_id, lower(trim(coalesce(external, title))) AS v FROM doc_versions QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY version_id DESC) = 1),
known AS (SELECT l.parent_id AS p, lower(trim(coalesce(external, title))) AS v, min_by(l.doc_id, l.link_id) AS doc FROM doc_links_target l JOIN doc_versions_target USING (doc_id) GROUP BY 1, 2),
matched AS (SELECT l.link_id, l.parent_id, l.doc_id, l.share, x.target_id AS target_parent_id, latest.v AS match_value, known.doc AS target_doc_id
  FROM doc_links l JOIN customer_xref x ON l.parent_id = x.source_id JOIN latest ON l.doc_id = latest.doc_id
  LEFT JOIN known ON x.target_id = known.p AND latest.v = known.v)"""


def matched(t: Tables) -> DataFrame:
    return documents.match_documents(
        X.doc_links(t), X.doc_versions(t), X.customer_xref(t), X.doc_links_target(t), X.doc_versions_target(t), "external", ["link_id"]
    )


@case("j29_document_match", X.with_ctes(X.DOCS, MATCHED, select="SELECT * FROM matched"))
def j29(t: Tables) -> DataFrame:
    return matched(t)


DOC_XREF = "doc_xref AS (SELECT doc_id AS source_id, doc_id + 9000000 AS target_id FROM documents WHERE lang <> 'de')"


def doc_xref(t: Tables) -> DataFrame:
    return t.documents.where("lang <> 'de'").select(F.col("doc_id").alias("source_id"), (F.col("doc_id") + 9000000).alias("target_id"))


@case(
    "j30_link_remap",
    X.with_ctes(
        *XREF, X.DOC_LINKS, DOC_XREF,
        select="SELECT l.link_id, p.target_id AS parent_id, d.target_id AS doc_id, l.share FROM doc_links l JOIN customer_xref p ON l.parent_id = p.source_id JOIN doc_xref d ON l.doc_id = d.source_id",
    ),
)
def j30(t: Tables) -> DataFrame:
    return documents.remap_links(X.doc_links(t), X.customer_xref(t), doc_xref(t))


@case(
    "j31_attachment_remap",
    X.with_ctes(
        *XREF,
        select="SELECT page_id, x.target_id AS parent_id, CASE WHEN length(url) >= 16 AND length(url) % 4 = 0 AND regexp_matches(url, '^[A-Za-z0-9+/]+={0,2}$') THEN url ELSE to_base64(encode(url)) END AS body FROM pages JOIN customer_xref x ON page_id = x.source_id WHERE length(url) > 0",
    ),
)
def j31(t: Tables) -> DataFrame:
    rows = t.pages.select("page_id", F.col("page_id").alias("parent_id"), F.col("url").alias("body"))
    return documents.remap_attachments(rows, X.customer_xref(t), body="body")


@case("j32_reverse_xref", X.with_ctes(*XREF, select="SELECT target_id AS source_id, source_id AS target_id FROM customer_xref"))
def j32(t: Tables) -> DataFrame:
    return matching.reverse(X.customer_xref(t))


@case("j33_delete_set_from_hierarchy", X.with_ctes(*XREF, select='SELECT target_id AS "Id" FROM customer_xref'))
def j33(t: Tables) -> DataFrame:
    return matching.hierarchy_ids(X.customer_xref(t))


@case(
    "j34_rows_by_parent_ids",
    X.with_ctes(
        X.DOC_LINKS,
        select="SELECT link_id, parent_id, doc_id, share FROM doc_links WHERE parent_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
    ),
)
def j34(t: Tables) -> DataFrame:
    return documents.rows_of_parents(X.doc_links(t), "parent_id", t.customer.where("c_mktsegment = 'BUILDING'"), "c_custkey")


@case(
    "j35_new_document_id_map",
    X.with_ctes(
        X.DOC_VERSIONS, X.DOC_VERSIONS_TARGET,
        select="SELECT s.doc_id AS source_id, g.doc_id AS target_id FROM doc_versions s JOIN doc_versions_target g ON s.version_id + 9000000 = g.version_id",
    ),
)
def j35(t: Tables) -> DataFrame:
    inserted = X.doc_versions(t).select("doc_id", (F.col("version_id") + 9000000).alias("version_id"))
    return documents.new_document_ids(inserted, X.doc_versions_target(t))


@case(
    "k9_composite_key",
    """SELECT p_partkey, concat_ws(';', nullif(p_name, ''), CASE WHEN p_size > 25 THEN NULL ELSE nullif(p_brand, '') END) AS key FROM part""",
)
def k9(t: Tables) -> DataFrame:
    brand = F.when(F.col("p_size") > 25, None).otherwise(F.col("p_brand"))
    return t.part.select("p_partkey", key_text([F.col("p_name"), brand]).alias("key"))
