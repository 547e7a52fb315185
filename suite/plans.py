"""Write plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.batches import size_batches
from rowferry.operators.matching import match
from rowferry.plans import apply as A
from rowferry.plans import migrate, persons, upsert
from rowferry.session import scratch_folder
from rowferry.spec import LookupSpec, MigrationSpec, TableSpec
from suite import fixtures as X
from suite.registry import Tables, case

COMPARED = {"c_acctbal": T.DoubleType(), "c_mktsegment": T.StringType(), "c_nationkey": T.IntegerType()}

LINKS = """links AS (
  SELECT s.c_custkey AS source_id, t.target_id, t.c_acctbal AS t_bal, t.c_mktsegment AS t_seg, t.c_nationkey AS t_nat
  FROM (SELECT c_name, max(c_custkey) AS c_custkey FROM customer_dup GROUP BY c_name) s
  JOIN customer_target t ON s.c_name = t.c_name)"""
DIFFERENT = "(s.c_acctbal IS DISTINCT FROM l.t_bal OR s.c_mktsegment IS DISTINCT FROM l.t_seg OR s.c_nationkey IS DISTINCT FROM l.t_nat)"
HEAD = (X.CUSTOMER_DUP, X.CUSTOMER_TARGET, LINKS)


def customer_plan(t: Tables, operation: str = "Upsert", **options) -> DataFrame:
    source, target = X.customer_dup(t), X.customer_target(t)
    links = match(source, target, "c_custkey", "target_id", ["c_name"], payload=list(COMPARED))
    return upsert.classify(source, links, "c_custkey", COMPARED, operation, **options)


def plan_sql(action: str, reason: str) -> str:
    return X.with_ctes(
        *HEAD,
        select=f"SELECT s.c_custkey, l.target_id, {action} AS action, {reason} AS skip_reason "
        "FROM customer_dup s LEFT JOIN links l ON s.c_custkey = l.source_id",
    )


OUT = ["c_custkey", "target_id", "action", "skip_reason"]


@case(
    "m1_upsert_classification",
    plan_sql(
        f"CASE WHEN l.target_id IS NULL THEN 'insert' WHEN {DIFFERENT} THEN 'update' ELSE 'skip' END",
        f"CASE WHEN l.target_id IS NOT NULL AND NOT {DIFFERENT} THEN 'same_data' END",
    ),
)
def m1(t: Tables) -> DataFrame:
    return customer_plan(t).select(*OUT)


@case(
    "m1_update_only",
    plan_sql(
        f"CASE WHEN l.target_id IS NOT NULL AND {DIFFERENT} THEN 'update' ELSE 'skip' END",
        f"CASE WHEN l.target_id IS NULL THEN 'no_match' WHEN NOT {DIFFERENT} THEN 'same_data' END",
    ),
)
def m1_update(t: Tables) -> DataFrame:
    return customer_plan(t, "Update").select(*OUT)


@case(
    "m1_insert_only",
    plan_sql(
        "CASE WHEN l.target_id IS NULL THEN 'insert' ELSE 'skip' END",
        "CASE WHEN l.target_id IS NOT NULL THEN 'other' END",
    ),
)
def m1_insert(t: Tables) -> DataFrame:
    return customer_plan(t, "Insert").select(*OUT)


@case(
    "m1_skip_existing",
    plan_sql(
        "CASE WHEN l.target_id IS NULL THEN 'insert' ELSE 'skip' END",
        "CASE WHEN l.target_id IS NOT NULL THEN 'existing' END",
    ),
)
def m1_existing(t: Tables) -> DataFrame:
    return customer_plan(t, skip_existing=True).select(*OUT)


@case(
    "m2_row_difference",
    X.with_ctes(
        *HEAD,
        select=f"SELECT s.c_custkey, {DIFFERENT} AS different FROM customer_dup s JOIN links l ON s.c_custkey = l.source_id",
    ),
)
def m2(t: Tables) -> DataFrame:
    source, target = X.customer_dup(t), X.customer_target(t)
    links = match(source, target, "c_custkey", "target_id", ["c_name"], payload=list(COMPARED))
    joined = source.join(links, F.col("c_custkey") == F.col("source_id"))
    return joined.select("c_custkey", upsert.row_differs(COMPARED).alias("different"))


# Two related tables. Orders look up customers; customers look up their last order, which
# comes later, so that lookup is deferred.
LAST_ORDER = """customer_last AS (
  SELECT c.c_custkey, c.c_name, c.c_acctbal, max(o.o_orderkey) AS last_order
  FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY ALL)"""


def customer_last(t: Tables) -> DataFrame:
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last_order"))
    return t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "c_name", "c_acctbal", "last_order"
    )


def two_tables(t: Tables):
    spec = MigrationSpec(
        (
            TableSpec("customer", "c_custkey", ("c_name",), ("c_name", "c_acctbal", "last_order"), "Upsert",
                      (LookupSpec("last_order", "orders"),)),
            TableSpec("orders", "o_orderkey", ("o_orderref",), ("o_orderref", "o_totalprice", "o_custkey"), "Upsert",
                      (LookupSpec("o_custkey", "customer"),)),
        )
    )
    ref = F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("o_orderref")
    orders = t.orders.select("o_orderkey", ref, "o_totalprice", "o_custkey")
    sources = {"customer": customer_last(t), "orders": orders}
    known_customers = X.customer_target(t).select(
        F.col("target_id").alias("c_custkey"), "c_name", "c_acctbal", F.lit(None).cast("long").alias("last_order")
    )
    known_orders = t.orders.where("o_orderstatus <> 'P'").select(
        (F.col("o_orderkey") + 70000000).alias("o_orderkey"), ref, "o_totalprice",
        F.lit(None).cast("long").alias("o_custkey"),
    )
    return spec, sources, {"customer": known_customers, "orders": known_orders}


# A table that links orders and parts and has no key of its own: both parents' keys and the line make it.
@case(
    "m1_junction_table",
    """WITH line AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, min_by(l_linestatus, l_extendedprice) AS l_linestatus, min_by(l_returnflag, l_extendedprice) AS l_returnflag
    FROM lineitem GROUP BY ALL)
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS l_id,
  CASE WHEN o_orderstatus <> 'P' AND l_linestatus = 'F' THEN concat_ws('-', 'T', l_orderkey, l_partkey, l_suppkey, l_linenumber) END AS known_id,
  CASE WHEN o_orderstatus = 'P' OR l_linestatus <> 'F' THEN 'insert' WHEN l_returnflag = 'R' THEN 'update' ELSE 'skip' END AS action
  FROM line JOIN orders ON l_orderkey = o_orderkey""",
)
def m1_junction(t: Tables) -> DataFrame:
    plan = migrate.plan_run(*junction_tables(t))["line"].plan
    return plan.select("l_id", F.when(F.col("action") != "insert", F.col("target_id")).alias("known_id"), "action")


def junction_tables(t: Tables):
    spec = MigrationSpec(
        (
            TableSpec("orders", "o_orderkey", ("o_orderref",), ("o_orderref",), "Upsert"),
            TableSpec("part", "p_partkey", ("p_name", "p_ref"), ("p_name", "p_ref"), "Upsert"),
            TableSpec("line", "l_id", ("l_orderkey", "l_partkey.p_ref", "l_suppkey", "l_linenumber"), ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"), "Upsert",
                      (LookupSpec("l_orderkey", "orders"), LookupSpec("l_partkey", "part"))),
        )
    )
    orders = t.orders.select("o_orderkey", F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("o_orderref"), "o_orderstatus")
    parts = t.part.select("p_partkey", "p_name", F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("p_ref"))
    of = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]  # a key that two lines share counts once
    # dealt by order, so that grouping and what looks up orders share one shuffle
    dealt = t.lineitem.repartition(int(t.lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    lines = dealt.groupBy(*of).agg(*[F.min_by(c, "l_extendedprice").alias(c) for c in ("l_quantity", "l_linestatus", "l_returnflag")]).withColumn("l_id", F.concat_ws("-", *of))
    sources = {"orders": orders.drop("o_orderstatus"), "part": parts, "line": lines.select("l_id", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")}
    known = orders.where("o_orderstatus <> 'P'")
    old = lines.where("l_linestatus = 'F'").join(known, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    quantity = F.when(F.col("l_returnflag") == "R", F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    targets = {
        "orders": known.select((F.col("o_orderkey") + 70000000).alias("o_orderkey"), "o_orderref"),
        "part": parts.withColumn("p_partkey", F.col("p_partkey") + 800000),
        "line": old.select(F.concat_ws("-", F.lit("T"), "l_id").alias("l_id"), (F.col("l_orderkey") + 70000000).alias("l_orderkey"), (F.col("l_partkey") + 800000).alias("l_partkey"), "l_suppkey", "l_linenumber", quantity.alias("l_quantity")),
    }
    return spec, sources, targets


NEW_ID = "CAST('0x' || substr(sha256('{0}|' || CAST({1} AS VARCHAR)), 1, 15) AS BIGINT)"
TWO = (
    X.CUSTOMER_TARGET,
    LAST_ORDER,
    f"""cust AS (
  SELECT s.c_custkey, coalesce(t.target_id, {NEW_ID.format('customer', 's.c_custkey')}) AS target_id,
         CASE WHEN t.target_id IS NULL THEN 'insert' WHEN s.c_acctbal IS DISTINCT FROM t.c_acctbal THEN 'update' ELSE 'skip' END AS action,
         s.last_order
  FROM customer_last s LEFT JOIN customer_target t ON s.c_name = t.c_name)""",
    f"""ord AS (
  SELECT o.o_orderkey, CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderkey + 70000000 ELSE {NEW_ID.format('orders', 'o.o_orderkey')} END AS target_id,
         c.target_id AS o_custkey, CASE WHEN o.o_orderstatus <> 'P' THEN 'update' ELSE 'insert' END AS action
  FROM orders o LEFT JOIN cust c ON o.o_custkey = c.c_custkey)""",
)


@case(
    "m3_first_pass",
    X.with_ctes(*TWO, select="SELECT o_orderkey, target_id, o_custkey, action FROM ord"),
)
def m3(t: Tables) -> DataFrame:
    runs = migrate.plan_run(*two_tables(t))
    return runs["orders"].plan.select("o_orderkey", "target_id", "o_custkey", "action")


@case(
    "m4_deferred_lookup_pass",
    X.with_ctes(
        *TWO,
        select="""SELECT c.c_custkey, c.target_id, o.target_id AS last_order,
  CASE WHEN c.last_order IS NULL THEN 'skip' ELSE 'update' END AS action,
  CASE WHEN c.last_order IS NULL THEN 'same_data' END AS skip_reason
  FROM cust c LEFT JOIN ord o ON c.last_order = o.o_orderkey""",
    ),
)
def m4(t: Tables) -> DataFrame:
    runs = migrate.plan_run(*two_tables(t))
    return runs["customer"].deferred.select("c_custkey", "target_id", "last_order", "action", "skip_reason")


@case(
    "m5_insert_with_new_ids",
    X.with_ctes(
        *HEAD,
        select="""SELECT s.c_custkey AS source_id,
  coalesce(CAST(l.target_id AS VARCHAR), upper(substr(sha256('customer|' || CAST(s.c_custkey AS VARCHAR)), 1, 18))) AS target_id
  FROM customer_dup s LEFT JOIN links l ON s.c_custkey = l.source_id""",
    ),
)
def m5(t: Tables) -> DataFrame:
    plan = customer_plan(t).withColumn("target_id", F.col("target_id").cast("string"))
    return upsert.pairs_after(upsert.with_new_ids(plan, "customer", "c_custkey"), "c_custkey")


@case(
    "m6_dry_run",
    X.with_ctes(
        *TWO,
        select="""SELECT 'customer' AS object, action, count(*) AS rows FROM cust GROUP BY action
  UNION ALL SELECT 'orders', action, count(*) FROM ord GROUP BY action""",
    ),
)
def m6(t: Tables) -> DataFrame:
    runs = migrate.plan_run(*two_tables(t))
    planned = migrate.summary(runs).where("pass = 'forward'")
    return planned.groupBy("object", "action").agg(F.count("*").alias("rows"))


@case(
    "m7_delete_old_data",
    X.with_ctes(X.CUSTOMER_TARGET, select="SELECT target_id, 'delete' AS action FROM customer_target WHERE c_acctbal < 0"),
)
def m7(t: Tables) -> DataFrame:
    return upsert.old_data_plan(X.customer_target(t), "target_id", "c_acctbal < 0")


@case("m8_delete_from_source", "SELECT o_orderkey AS target_id, 'delete' AS action FROM orders WHERE o_orderstatus = 'F'")
def m8(t: Tables) -> DataFrame:
    return upsert.delete_plan(t.orders.where("o_orderstatus = 'F'"), "o_orderkey")


@case(
    "m9_delete_by_hierarchy",
    X.with_ctes(X.CUSTOMER_TARGET, X.CUSTOMER_XREF, select="SELECT target_id, 'delete' AS action FROM customer_xref"),
)
def m9(t: Tables) -> DataFrame:
    return upsert.hierarchy_delete_plan(X.customer_xref(t))


FLAGGED = X.CUSTOMER_TARGET + """,
flagged AS (SELECT target_id, c_name, FALSE AS is_deleted FROM customer_target)"""


def flagged(t: Tables) -> DataFrame:
    return X.customer_target(t).select("target_id", "c_name", F.lit(False).alias("is_deleted"))


@case(
    "m10_hard_delete",
    X.with_ctes(FLAGGED, select="SELECT * FROM flagged WHERE target_id NOT IN (SELECT target_id FROM customer_target WHERE c_acctbal < 0)"),
)
def m10(t: Tables) -> DataFrame:
    deletes = upsert.old_data_plan(X.customer_target(t), "target_id", "c_acctbal < 0", hard=True)
    return A.apply_plan(flagged(t), deletes, "target_id", [], "is_deleted")


@case(
    "m10_soft_delete",
    X.with_ctes(
        FLAGGED,
        select="SELECT target_id, c_name, target_id IN (SELECT target_id FROM customer_target WHERE c_acctbal < 0) AS is_deleted FROM flagged",
    ),
)
def m10_soft(t: Tables) -> DataFrame:
    deletes = upsert.old_data_plan(X.customer_target(t), "target_id", "c_acctbal < 0")
    return A.apply_plan(flagged(t), deletes, "target_id", [], "is_deleted")


@case(
    "m11_read_only",
    X.with_ctes(
        X.CUSTOMER_TARGET, X.CUSTOMER_XREF,
        select="SELECT o.o_orderkey, x.target_id AS o_custkey FROM orders o LEFT JOIN customer_xref x ON o.o_custkey = x.source_id",
    ),
)
def m11(t: Tables) -> DataFrame:
    spec = MigrationSpec(
        (
            TableSpec("customer", "c_custkey", ("c_name",), ("c_name",), "Readonly"),
            TableSpec("orders", "o_orderkey", ("o_orderkey",), ("o_custkey",), "Insert", (LookupSpec("o_custkey", "customer"),)),
        )
    )
    known = X.customer_target(t).select(F.col("target_id").alias("c_custkey"), "c_name")
    empty = t.orders.select("o_orderkey", "o_custkey").where(F.lit(False))
    runs = migrate.plan_run(spec, {"customer": t.customer, "orders": t.orders}, {"customer": known, "orders": empty})
    return runs["orders"].plan.select("o_orderkey", "o_custkey")


@case(
    "m13_apply_plan",
    X.with_ctes(
        *HEAD,
        select="""SELECT coalesce(CAST(l.target_id AS VARCHAR), upper(substr(sha256('customer|' || CAST(s.c_custkey AS VARCHAR)), 1, 18))) AS target_id,
  s.c_name, s.c_nationkey, s.c_mktsegment, s.c_acctbal FROM customer_dup s LEFT JOIN links l ON s.c_custkey = l.source_id""",
    ),
)
def m13(t: Tables) -> DataFrame:
    plan = customer_plan(t).withColumn("target_id", F.col("target_id").cast("string"))
    plan = upsert.with_new_ids(plan, "customer", "c_custkey")
    target = X.customer_target(t).withColumn("target_id", F.col("target_id").cast("string"))
    return A.apply_plan(target, plan, "target_id", target.columns)


@case(
    "m13_apply_three_plans",
    X.with_ctes(
        *HEAD,
        select="""SELECT coalesce(CAST(l.target_id AS VARCHAR), upper(substr(sha256('customer|' || CAST(s.c_custkey AS VARCHAR)), 1, 18))) AS target_id,
  s.c_name, s.c_nationkey, s.c_mktsegment,
  CASE WHEN l.target_id IS NOT NULL AND s.c_mktsegment = 'BUILDING' AND s.c_nationkey < 20 THEN 0.0 ELSE s.c_acctbal END AS c_acctbal
  FROM customer_dup s LEFT JOIN links l ON s.c_custkey = l.source_id
  WHERE l.target_id IS NULL OR s.c_nationkey < 20 OR s.c_mktsegment IN ('MACHINERY', 'FURNITURE')""",
    ),
)
def m13_three(t: Tables) -> DataFrame:
    """Deletes, then the upsert, which writes some of the deleted rows anew, then a second update."""
    target = X.customer_target(t).withColumn("target_id", F.col("target_id").cast("string"))
    deletes = upsert.old_data_plan(target, "target_id", "c_nationkey >= 20", hard=True)
    plan = customer_plan(t).withColumn("target_id", F.col("target_id").cast("string"))
    plan = upsert.with_new_ids(plan, "customer", "c_custkey")
    later = target.where("c_mktsegment = 'BUILDING' AND c_nationkey < 20").select(
        "target_id", F.lit(upsert.UPDATE).alias("action"), F.lit(0.0).alias("c_acctbal")
    )
    phases = [A.Phase(deletes, []), A.Phase(plan, target.columns), A.Phase(later, ["c_acctbal"])]
    return A.apply_phases(target, phases, "target_id")


PERSONS = """people AS (
  SELECT c_custkey AS Id, CASE WHEN c_acctbal < 0 THEN ' ' ELSE c_mktsegment || ' ' || c_name || ' x' END AS Name,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'First' END AS FirstName,
         CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'Last' END AS LastName,
         CASE WHEN c_nationkey < 5 THEN 'true' WHEN c_nationkey < 10 THEN '1' WHEN c_nationkey < 15 THEN '0' WHEN c_nationkey < 20 THEN '' END AS IsPersonAccount
  FROM customer)"""


def people(t: Tables) -> DataFrame:
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    return t.customer.select(
        F.col("c_custkey").alias("Id"),
        F.when(F.col("c_acctbal") < 0, " ").otherwise(F.concat_ws(" ", segment, F.col("c_name"), F.lit("x"))).alias("Name"),
        F.when(segment == "BUILDING", "First").alias("FirstName"),
        F.when(segment.isin("BUILDING", "HOUSEHOLD"), "Last").alias("LastName"),
        F.when(nation < 5, "true").when(nation < 10, "1").when(nation < 15, "0").when(nation < 20, "").alias("IsPersonAccount"),
    )


MADE_NAME = "upper(substr(sha256('name|' || CAST(Id AS VARCHAR)), 1, 10))"


@case(
    "m15_person_business_passes",
    X.with_ctes(
        PERSONS,
        select=f"""SELECT Id, CASE WHEN trim(Name) <> '' THEN Name
    ELSE coalesce(nullif(concat_ws(' ', FirstName, LastName), ''), {MADE_NAME}) END AS Name,
    CAST(NULL AS VARCHAR) AS FirstName, CAST(NULL AS VARCHAR) AS LastName, 'business' AS pass
  FROM people WHERE IsPersonAccount IS NULL OR IsPersonAccount IN ('0', '')
  UNION ALL
  SELECT Id, NULL,
    CASE WHEN FirstName IS NULL AND LastName IS NULL THEN coalesce(nullif(split_part(trim(Name), ' ', 1), ''), {MADE_NAME}) ELSE FirstName END,
    CASE WHEN FirstName IS NULL AND LastName IS NULL THEN split_part(trim(Name), ' ', 2) ELSE LastName END, 'person'
  FROM people WHERE IsPersonAccount IN ('true', '1')""",
    ),
)
def m15(t: Tables) -> DataFrame:
    return persons.both_passes(people(t), "IsPersonAccount", "Id", ["Id", "Name", "FirstName", "LastName"])


@case(
    "m18_size_bound_batches",
    """WITH RECURSIVE o AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) AS rn FROM documents),
  g AS (SELECT rn, doc_id, n_chars, CAST(0 AS BIGINT) AS batch, n_chars AS fill FROM o WHERE rn = 1
    UNION ALL
    SELECT o.rn, o.doc_id, o.n_chars, CASE WHEN g.fill + o.n_chars > 50000 THEN g.batch + 1 ELSE g.batch END,
      CASE WHEN g.fill + o.n_chars > 50000 THEN o.n_chars ELSE g.fill + o.n_chars END FROM g JOIN o ON o.rn = g.rn + 1)
  SELECT doc_id, n_chars, batch FROM g""",
)
def m18(t: Tables) -> DataFrame:
    return size_batches(t.documents.select("doc_id", "n_chars"), [], ["doc_id"], "n_chars", 50_000)


@case(
    "o3_ordered_deletes",
    """SELECT o_orderkey AS target_id, 'delete' AS action, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS seq
  FROM orders WHERE o_orderstatus = 'F'""",
)
def o3(t: Tables) -> DataFrame:
    rows = t.orders.where("o_orderstatus = 'F'")
    plan = upsert.delete_plan(rows, "o_orderkey")
    return upsert.ordered_deletes(plan, rows, "o_orderkey", ["o_orderdate", "o_orderkey"])


@case(
    "m14_all_or_none",
    """SELECT 'refused' AS run, count(*) AS rows FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'applied', count(*) FROM orders""",
)
def m14(t: Tables) -> DataFrame:
    outcome = []
    for run, error in (("refused", "o_totalprice > 0"), ("applied", "o_totalprice < 0")):
        path = scratch_folder(t.spark, "m14")
        A.replace_table(t.orders.where("o_orderstatus = 'F'"), path)
        A.apply_all_or_none(t.orders, t.orders.where(error), path)
        outcome.append(t.spark.read.parquet(path).agg(F.count("*").alias("rows")).select(F.lit(run).alias("run"), "rows"))
    return outcome[0].unionByName(outcome[1])
