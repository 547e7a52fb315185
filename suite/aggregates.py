"""Counts and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.operators import filters, mapping, mocking, stats
from rowferry.spec import MockField, ValueRule
from suite import fixtures as X
from suite.plans import DIFFERENT, HEAD, customer_plan
from suite.quality import ISSUES, all_issues
from suite.registry import Tables, case

PLAN = f"""plan AS (
  SELECT CASE WHEN l.target_id IS NULL THEN 'insert' WHEN {DIFFERENT} THEN 'update' ELSE 'skip' END AS action,
         CASE WHEN l.target_id IS NOT NULL AND NOT {DIFFERENT} THEN 'same_data' END AS skip_reason
  FROM customer_dup s LEFT JOIN links l ON s.c_custkey = l.source_id)"""


@case("a1_row_count", 'SELECT count(o_orderkey) AS "CNT" FROM orders')
def a1(t: Tables) -> DataFrame:
    return stats.row_count(t.orders, "o_orderkey")


@case("a2_count_capped_by_limit", 'SELECT least(count(o_orderkey), 1000) AS "CNT" FROM orders')
def a2(t: Tables) -> DataFrame:
    return stats.row_count(t.orders, "o_orderkey", limit=1000)


def labelled(t: Tables) -> DataFrame:
    return customer_plan(t).withColumn("object", F.lit("customer")).withColumn("pass", F.lit("forward"))


@case("a3_write_summary", X.with_ctes(*HEAD, PLAN, select="SELECT 'customer' AS object, 'forward' AS pass, action, count(*) AS rows FROM plan GROUP BY action"))
def a3(t: Tables) -> DataFrame:
    return stats.write_summary(labelled(t))


@case(
    "a3_write_totals",
    X.with_ctes(*HEAD, PLAN, select="SELECT 'customer' AS object, count_if(action = 'insert')::BIGINT AS inserted, count_if(action = 'update')::BIGINT AS updated, CAST(0 AS BIGINT) AS deleted FROM plan"),
)
def a3_totals(t: Tables) -> DataFrame:
    return stats.write_totals(labelled(t))


@case(
    "a4_skip_reason_counts",
    X.with_ctes(
        *HEAD, PLAN,
        select="SELECT count_if(skip_reason = 'same_data')::BIGINT AS same_data, CAST(0 AS BIGINT) AS no_match, (count_if(action = 'skip') - count_if(skip_reason = 'same_data'))::BIGINT AS other FROM plan",
    ),
)
def a4(t: Tables) -> DataFrame:
    return stats.skip_counts(customer_plan(t))


RULES = [
    ValueRule("events", "event_type", "/(click|view)/", "seen"),
    ValueRule("events", "event_type", "error", "failed"),
    ValueRule("events", "event_type", "nothing", "never"),
]


@case(
    "a5_value_rule_hits",
    """SELECT 'events' AS object, 'event_type' AS field, rule, count(e) AS rows FROM
  (VALUES ('/(click|view)/'), ('error'), ('nothing')) r(rule) LEFT JOIN (SELECT CASE WHEN event_type IN ('click', 'view') THEN '/(click|view)/' WHEN event_type = 'error' THEN 'error' END AS e FROM events) ON e = rule GROUP BY rule""",
)
def a5(t: Tables) -> DataFrame:
    return mapping.rule_hits(t.events, "events", RULES, ["event_type"])


@case(
    "a6_mock_apply_counts",
    """SELECT 'c_name' AS field, count_if(c_name LIKE '%7%')::BIGINT AS rows FROM customer UNION ALL SELECT 'c_mktsegment', count_if(c_mktsegment <> 'BUILDING')::BIGINT FROM customer""",
)
def a6(t: Tables) -> DataFrame:
    mocks = [MockField("c_name", "name", included="7"), MockField("c_mktsegment", "word", excluded="^building$")]
    return mocking.apply_counts(t.customer, mocks, "c_custkey")


@case("a7_issue_summary", X.with_ctes(*ISSUES, select='SELECT "table", error, count(*) AS issues FROM issues GROUP BY ALL'))
def a7(t: Tables) -> DataFrame:
    return stats.issue_summary(all_issues(t))


@case("a9_write_success_failure", "SELECT count(*) AS processed, count_if(o_totalprice > 450000)::BIGINT AS failed FROM orders")
def a9(t: Tables) -> DataFrame:
    return stats.write_results(t.orders.select("o_orderkey", F.when(F.col("o_totalprice") > 450000, "too large").alias("Errors")))


@case(
    "a10_group_rows_by_key",
    """SELECT event_id, user_id || '|' || event_type AS group_key, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS position FROM events""",
)
def a10(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type")
    return stats.rows_by_key(rows, ["user_id", "event_type"], ["event_id"]).select("event_id", "group_key", "position")


@case("a11_last_row_by_key", "SELECT user_id || '|' || event_type AS group_key, max(event_id) AS event_id FROM events GROUP BY 1")
def a11(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type")
    return stats.last_by_key(rows, ["user_id", "event_type"], ["event_id"]).select("group_key", "event_id")


@case("a12_distinct_values", "SELECT DISTINCT l_returnflag || '|' || l_linestatus || '|' || l_linenumber AS value FROM lineitem")
def a12(t: Tables) -> DataFrame:
    return stats.distinct_values(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])


@case("a12_distinct_ignoring_case", "SELECT max_by(v, doc_id) AS value FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN upper(source) ELSE source END AS v FROM documents) GROUP BY lower(v)")
def a12_case(t: Tables) -> DataFrame:
    spelled = F.when(F.col("lang") == "en", F.upper("source")).otherwise(F.col("source"))
    return stats.distinct_ignoring_case(t.documents.select("doc_id", spelled.alias("v")), "v", ["doc_id"])


@case(
    "a13_bad_word_counts",
    r"SELECT count_if(regexp_matches(text, '(?i)\b(éon|token|the|eon)\b'))::BIGINT AS kept, count_if(NOT regexp_matches(text, '(?i)\b(éon|token|the|eon)\b'))::BIGINT AS filtered FROM documents",
)
def a13(t: Tables) -> DataFrame:
    return stats.match_counts(t.documents, filters.word_match(["text"], ["éon", "token", "the"]))


@case("a14_total_volume", X.with_ctes(X.DOC_VERSIONS, select="SELECT count(*) AS versions, count_if(length(url) > 0)::BIGINT AS urls, sum(size)::BIGINT AS bytes FROM doc_versions"))
def a14(t: Tables) -> DataFrame:
    return stats.volume(X.doc_versions(t), "size", "url")
