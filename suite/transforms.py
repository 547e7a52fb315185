"""Value transforms and hooks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions import masking as M
from rowferry.operators import formula, mapping, masking, mocking, project
from rowferry.plans import hooks
from rowferry.session import scratch_folder
from rowferry.spec import MockField, ValueRule
from suite import fixtures as X
from suite.plans import customer_plan, plan_sql, DIFFERENT
from suite.registry import Tables, case

SEED = "a fixed seed"

RULES = [
    ValueRule("events", "event_type", "/(click|view)(e?)/", "seen-$1"),
    ValueRule("events", "event_type", "seen-view", "watched"),
    ValueRule("events", "event_type", "error", "TRUE"),
    ValueRule("events", "event_type", "signup", "NULL"),
    ValueRule("events", "event_type", "purchase", ""),
]


@case(
    "t1_value_mapping",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'seen-click' WHEN 'view' THEN 'watched' WHEN 'error' THEN 'true' WHEN 'signup' THEN NULL ELSE event_type END AS event_type FROM events""",
)
def t1(t: Tables) -> DataFrame:
    return mapping.map_values(t.events.select("event_id", "event_type"), "events", RULES)


@case(
    "t1_value_mapping_many_rules",
    """SELECT c_custkey, CASE WHEN CAST(substr(c_name, 10) AS BIGINT) < 500 THEN 'Client ' || CAST(substr(c_name, 10) AS BIGINT) ELSE c_name END AS c_name FROM customer""",
)
def t1_many(t: Tables) -> DataFrame:
    rules = [ValueRule("customer", "c_name", f"Customer#{i:09d}", f"Client {i}") for i in range(500)]
    return mapping.map_values(t.customer.select("c_custkey", "c_name"), "customer", rules)


# Every customer and every order is a rule: the tables grow together.
@case(
    "t1_rules_from_dataframe",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN o_orderstatus = 'P' THEN CAST(l_orderkey AS VARCHAR) WHEN o_orderpriority = '5-LOW' THEN NULL
    WHEN o_orderpriority = '1-URGENT' THEN 'urgent ' || CAST(l_orderkey AS VARCHAR) ELSE '$1 order\\' || CAST(l_orderkey AS VARCHAR) END AS "order"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def t1_table(t: Tables) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    value = F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderpriority") == "5-LOW", "#N/A").when(F.col("o_orderpriority") == "1-URGENT", "eval(concat('urgent ', RAW_VALUE))")
    value = value.otherwise(F.concat(F.lit("$1 order\\"), key))
    first = t.orders.select(F.lit("line").alias("ObjectName"), F.lit("order").alias("FieldName"), key.alias("RawValue"), F.lit("an earlier rule").alias("Value"), F.lit(0).alias("sheet"))
    rules = first.unionByName(t.orders.select(F.lit("line").alias("ObjectName"), F.lit("order").alias("FieldName"), F.concat(F.lit(" "), key).alias("RawValue"), value.alias("Value"), F.lit(1).alias("sheet")))
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_orderkey").alias("order"))
    return mapping.map_values(rows, "line", mapping.RuleTable(rules, ("sheet",)), ["order"])


@case(
    "t2_computed_mapping",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1-URGENT/8' WHEN '2-HIGH' THEN '2-HIGH' WHEN '3-MEDIUM' THEN 'medium' ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def t2(t: Tables) -> DataFrame:
    rules = [
        ValueRule("orders", "o_orderpriority", "1-URGENT", "eval(concat(RAW_VALUE, '/', length(RAW_VALUE)))"),
        ValueRule("orders", "o_orderpriority", "2-HIGH", "eval(no_such_function(RAW_VALUE))"),
        ValueRule("orders", "o_orderpriority", "3-MEDIUM", "eval(lower(substr(raw_value, 3)))"),
    ]
    return mapping.map_values(t.orders.select("o_orderkey", "o_orderpriority"), "orders", rules)


@case("t2_computed_column", "SELECT p_partkey, upper(p_name) || '!' AS p_name FROM part")
def t2_column(t: Tables) -> DataFrame:
    return mapping.compute(t.part.select("p_partkey", "p_name"), "p_name", "concat(upper(RAW_VALUE), '!')")


@case(
    "t3_formula_column",
    """SELECT c_custkey, c_name || ' / ' || n_name || ' / ' || coalesce(CAST(CAST(total AS BIGINT) AS VARCHAR), '-') || ' x' AS label FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT o_custkey, min_by(floor(o_totalprice), o_orderkey) AS total FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def t3(t: Tables) -> DataFrame:
    rows = formula.from_parent(t.customer, ["c_nationkey"], t.nation, "n_nationkey", "n_name", "nation")
    rows = formula.from_child(rows, "c_custkey", t.orders, ["o_custkey"], "o_totalprice", ["o_orderkey"], "total")
    aliases = {"name": F.col("c_name"), "nation": F.col("nation"), "total": F.col("total"), "text": F.lit("")}
    prepared = [("text", "coalesce(cast(floor(formula.total) as string), '-')"), ("text", "concat(formula.text, ' x')")]
    out = formula.apply(rows, aliases, "concat_ws(' / ', formula.name, formula.nation, formula.text)", "label", prepared)
    return out.select("c_custkey", "label")


def _names(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _pick(words, salt: str) -> str:
    number = f"CAST('0x' || substr(md5(c_custkey || '|{salt}'), 1, 8) AS BIGINT)"
    return f"{_names(words)}[CAST({number} % {len(words)} + 1 AS INTEGER)]"


@case(
    "t4_mock_columns",
    f"""SELECT c_custkey, {_pick(mocking.FIRST_NAMES, 'c_name|first')} || ' ' || {_pick(mocking.LAST_NAMES, 'c_name|last')} AS c_name,
  c_nationkey, c_acctbal, 'was ' || c_mktsegment AS c_mktsegment, CAST(c_custkey AS VARCHAR) AS copy,
  'S' || CAST(10 + (row_number() OVER (ORDER BY c_custkey) - 1) * 2 AS VARCHAR) AS number FROM customer""",
)
def t4(t: Tables) -> DataFrame:
    mocks = [
        MockField("c_name", "full_name"),
        MockField("c_mktsegment", "c_set_value('was RAW_VALUE')"),
        MockField("copy", "ids"),
        MockField("number", "c_seq_number('S', 10, 2)"),
        MockField("c_custkey", "word"),
    ]
    rows = t.customer.withColumn("copy", F.lit("")).withColumn("number", F.lit(""))
    return mocking.apply(rows, mocks, "c_custkey", ["c_custkey"])


@case(
    "t5_mock_conditions",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderstatus ELSE 'x' END AS o_orderstatus,
  CASE WHEN o_orderpriority LIKE '%high%' OR o_orderpriority LIKE '%HIGH%' THEN 'N' || row_number() OVER (PARTITION BY o_orderpriority = '2-HIGH' ORDER BY o_orderkey) ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN note IS NULL THEN 'filled' ELSE note END AS note FROM (SELECT *, CASE WHEN o_totalprice > 200000 THEN 'big' END AS note FROM orders)""",
)
def t5(t: Tables) -> DataFrame:
    mocks = [
        MockField("o_orderstatus", "c_set_value('x')", excluded="^f$"),
        MockField("o_orderpriority", "c_seq_number('N', 1, 1)", included="high"),
        MockField("note", "c_set_value('filled')", included="^*"),
    ]
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.when(F.col("o_totalprice") > 200000, "big").alias("note"))
    return mocking.apply(rows, mocks, "o_orderkey", ["o_orderkey"])


@case(
    "t6_row_level_mock_flag",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderstatus WHEN o_orderpriority LIKE '%URGENT%' OR o_orderstatus = 'O' THEN 'x' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority WHEN o_orderpriority LIKE '%URGENT%' THEN 'y' ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def t6(t: Tables) -> DataFrame:
    mocks = [
        MockField("o_orderstatus", "c_set_value('x')", included="o", excluded="f --row"),
        MockField("o_orderpriority", "c_set_value('y')", included="urgent --row"),
    ]
    return mocking.apply(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), mocks, "o_orderkey", ["o_orderkey"])


# The masks in SQL: the same split, extract and zip, with the hash spelled out.
INNER, OUTER = (pad.hex() for pad in M._pads(SEED))


def q(pattern: str) -> str:
    """A SQL literal. The other engine never backtracks and has no possessive quantifier."""
    return "'" + pattern.replace("++", "+").replace("'", "''") + "'"


def hash_sql(value: str) -> str:
    inner = f"sha256(unhex('{INNER}') || encode({value}))"
    return f"upper(substr(sha256(unhex('{OUTER}') || unhex({inner})), 1, 16))"


def token_sql(label: str, value: str) -> str:
    return f"{label} || '<' || {hash_sql(value)} || '>'"


def id_token_sql(label: str, value: str) -> str:
    return f"CASE WHEN regexp_matches({value}, {q(M.RECORD_ID)}) THEN {value} ELSE {token_sql(q(label), value)} END"


def group_sql(pattern: str, number: int, hit: str) -> str:
    return f"regexp_extract({hit}, {q(pattern)}, {number})"


def hits_sql(text: str, pattern: str, swap: Callable[[str], str], z: str = "z") -> str:
    pairs = f"list_zip(string_split_regex({text}, {q(pattern)}), regexp_extract_all({text}, {q(pattern)}))"
    return f"array_to_string(list_transform({pairs}, lambda {z}: {z}[1] || coalesce({swap(f'{z}[2]')}, '')), '')"


def quoted_sql(text: str, pattern: str, mark: str) -> str:
    return hits_sql(text, pattern, lambda h: f"{q(mark)} || {id_token_sql('soql', group_sql(pattern, 1, h))} || {q(mark)}", "y")


HOLDS = (
    "(" + " OR ".join(f"contains(lower(x), {q(mark)})" for mark in M.QUERY_MARKS) + f" OR regexp_matches(x, {q(M.SELECT_FROM)}))"
)


def in_list_sql(pattern: str, mark: str) -> str:
    p = M.IN_LIST
    masked = hits_sql("x", p, lambda h: f"{group_sql(p, 1, h)} || {quoted_sql(group_sql(p, 2, h), pattern, mark)} || ')'")
    return f"CASE WHEN {HOLDS} THEN {masked} ELSE x END"


def _comparison_sql() -> str:
    p = M.FIELD_COMPARISON
    literal = lambda h: group_sql(p, 2, h)
    value = lambda h: f"substr({literal(h)}, 2, length({literal(h)}) - 2)"
    masked = hits_sql("x", p, lambda h: f"{group_sql(p, 1, h)} || left({literal(h)}, 1) || {id_token_sql('soql', value(h))} || left({literal(h)}, 1)")
    return f"CASE WHEN {HOLDS} THEN {masked} ELSE x END"


PROMPT_SQL = hits_sql(
    "x", M.PROMPT,
    lambda h: f"CASE WHEN trim({group_sql(M.PROMPT, 2, h)}) = '' THEN {h} ELSE {group_sql(M.PROMPT, 1, h)} || {id_token_sql('prompt', f'trim({group_sql(M.PROMPT, 2, h)})')} END",
)
PAIR_SQL = hits_sql(
    "x", M.VALUE_PAIR,
    lambda h: f"{group_sql(M.VALUE_PAIR, 1, h)} || {id_token_sql('value', f'trim({group_sql(M.VALUE_PAIR, 2, h)})')} || {group_sql(M.VALUE_PAIR, 3, h)}",
)
SECRETS_SQL = [
    hits_sql("x", M.SECRET_DOUBLE_QUOTED, lambda h: f"{group_sql(M.SECRET_DOUBLE_QUOTED, 1, h)} || {token_sql(group_sql(M.SECRET_DOUBLE_QUOTED, 2, h), group_sql(M.SECRET_DOUBLE_QUOTED, 3, h))} || '\"'"),
    hits_sql("x", M.SECRET_SINGLE_QUOTED, lambda h: f"{group_sql(M.SECRET_SINGLE_QUOTED, 1, h)} || {token_sql(q('secret'), group_sql(M.SECRET_SINGLE_QUOTED, 2, h))} || ''''"),
    hits_sql("x", M.SECRET_BARE, lambda h: f"{group_sql(M.SECRET_BARE, 1, h)} || {token_sql(group_sql(M.SECRET_BARE, 2, h), group_sql(M.SECRET_BARE, 3, h))}"),
    hits_sql("x", M.BEARER, lambda h: f"'Bearer ' || {token_sql(q('bearer'), group_sql(M.BEARER, 1, h))}"),
]
PLACES_SQL = [
    hits_sql("x", pattern, lambda h, label=label: token_sql(q(label), h))
    for pattern, label in ((M.EMAIL, "email"), (M.URL, "url"), (M.DOMAIN, "domain"), (M.DRIVE_PATH, "path"), (M.SHARE_PATH, "path"))
]
LITERALS_SQL = [in_list_sql(M.QUOTED_SINGLE, "'"), in_list_sql(M.QUOTED_DOUBLE, '"'), _comparison_sql()]


def stages_sql(source: str, stages: list[str]) -> list[str]:
    """One CTE per mask: (id, x) in, (id, x) out. ``source`` reads the first one."""
    ctes = [f"m0 AS ({source})"]
    for i, stage in enumerate(stages):
        ctes.append(f"m{i + 1} AS MATERIALIZED (SELECT id, {stage} AS x FROM m{i})")
    return ctes


def masked_sql(source: str, stages: list[str], name: str = "doc_id", text: str = "text") -> str:
    ctes = stages_sql(source, stages)
    return X.with_ctes(*ctes, select=f"SELECT id AS {name}, x AS {text} FROM m{len(stages)}")


DOCS = "SELECT doc_id AS id, text AS x FROM documents"


def staged(df: DataFrame, column: str, *stages) -> DataFrame:
    return masking.anonymize_values(df, column, SEED, *stages)


KNOWN = [("the", "word"), ("token", "org"), ("the token", "org")]


@case(
    "t7_hash_mask_known_values",
    f"""SELECT doc_id, replace(replace(replace(text, 'the token', 'org<{M.keyed_hash_text('the token', SEED)}>'), 'token', 'org<{M.keyed_hash_text('token', SEED)}>'), 'the', 'word<{M.keyed_hash_text('the', SEED)}>') AS text FROM documents""",
)
def t7(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", M.mask_known(F.col("text"), KNOWN, SEED).alias("text"))


@case("t7_keyed_hash", f"SELECT DISTINCT c_mktsegment, {hash_sql('c_mktsegment')} AS hash FROM customer")
def t7_hash(t: Tables) -> DataFrame:
    return t.customer.select("c_mktsegment", M.keyed_hash(F.col("c_mktsegment"), SEED).alias("hash")).distinct()


@case("t8_mask_secrets", masked_sql(DOCS, SECRETS_SQL))
def t8(t: Tables) -> DataFrame:
    return staged(
        t.documents.select("doc_id", "text"), "text",
        M.mask_double_quoted_secrets, M.mask_single_quoted_secrets, M.mask_bare_secrets, M.mask_bearer,
    )


@case("t9_mask_emails_urls_paths", masked_sql(DOCS, PLACES_SQL))
def t9(t: Tables) -> DataFrame:
    return staged(
        t.documents.select("doc_id", "text"), "text",
        M.mask_emails, M.mask_urls, M.mask_domains, M.mask_drive_paths, M.mask_share_paths,
    )


@case("t9_mask_page_urls", masked_sql("SELECT page_id AS id, html || ' ' || url AS x FROM pages", PLACES_SQL, "page_id", "html"))
def t9_pages(t: Tables) -> DataFrame:
    rows = t.pages.select("page_id", F.concat_ws(" ", "html", "url").alias("html"))
    return staged(rows, "html", M.mask_emails, M.mask_urls, M.mask_domains, M.mask_drive_paths, M.mask_share_paths)


QUERY_LINES = """SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'where name in (''' || c_name || ''')'
  ELSE 'Query string: SELECT Id FROM Account WHERE Name IN (''' || c_name || ''', "' || c_mktsegment || '", ''001000000000000AAA'') AND Owner__r.Name = ''' || c_name || ''' AND Kind = ''x''' END AS x FROM customer"""


def query_lines(t: Tables) -> DataFrame:
    plain = F.concat(F.lit("where name in ('"), "c_name", F.lit("')"))
    query = F.concat(
        F.lit("Query string: SELECT Id FROM Account WHERE Name IN ('"), "c_name", F.lit("', \""), "c_mktsegment",
        F.lit("\", '001000000000000AAA') AND Owner__r.Name = '"), "c_name", F.lit("' AND Kind = 'x'"),
    )
    return t.customer.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", plain).otherwise(query).alias("line"))


@case("t10_mask_query_literals", masked_sql(QUERY_LINES, LITERALS_SQL, "c_custkey", "line"))
def t10(t: Tables) -> DataFrame:
    return staged(query_lines(t), "line", M.mask_in_lists_single, M.mask_in_lists_double, M.mask_comparisons)


ANSWER_LINES = """SELECT conv_id * 1000 + turn AS id, CASE role WHEN 'user' THEN 'Prompt answer:  ' || replace(text, chr(10), ' ') ELSE '[x] {Account} - ' || role || ': ' || replace(text, chr(10), ' ') END AS x FROM conversations"""


def answer_lines(t: Tables) -> DataFrame:
    flat = F.replace("text", F.lit("\n"), F.lit(" "))
    line = F.when(F.col("role") == "user", F.concat(F.lit("Prompt answer:  "), flat)).otherwise(
        F.concat(F.lit("[x] {Account} - "), "role", F.lit(": "), flat)
    )
    return t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), line.alias("line"))


@case("t11_mask_answers_and_pairs", masked_sql(ANSWER_LINES, [PROMPT_SQL, PAIR_SQL], "id", "line"))
def t11(t: Tables) -> DataFrame:
    asked = answer_lines(t).withColumn("line", M.mask_prompt_answers(F.col("line"), SEED))
    return staged(asked, "line", M.mask_value_pairs)


KNOWN_SQL = "replace(replace(replace(x, {0}), {1}), {2})".format(
    *[f"'{v}', '{label}<{M.keyed_hash_text(v, SEED)}>'" for v, label in sorted(KNOWN, key=lambda e: -len(e[0]))][::1]
)
ALL_STAGES = [PROMPT_SQL, KNOWN_SQL, *SECRETS_SQL, *PLACES_SQL, *LITERALS_SQL, PAIR_SQL]
BYPASS_SQL = (
    "(" + " OR ".join([f"contains(lower(text), {q(m)})" for m in M.RULE_MARKS])
    + f" OR contains(text, '@@NO_ANON@@') OR contains(text, '[STACK TRACE]') OR regexp_matches(text, {q(M.STACK_LINE)}) OR regexp_matches(text, {q(M.STACK_CALL)}))"
)
MARKED = "marked AS (SELECT doc_id, CASE WHEN lang = 'de' THEN '@@NO_ANON@@' || text ELSE text END AS text FROM documents)"


@case(
    "t12_mask_bypass",
    X.with_ctes(
        MARKED,
        *stages_sql("SELECT doc_id AS id, text AS x FROM marked", ALL_STAGES),
        select=f"SELECT doc_id, CASE WHEN {BYPASS_SQL} THEN replace(text, '@@NO_ANON@@', '') ELSE x END AS text FROM marked JOIN m{len(ALL_STAGES)} ON doc_id = id",
    ),
)
def t12(t: Tables) -> DataFrame:
    text = F.when(F.col("lang") == "de", F.concat(F.lit(M.BYPASS_MARKER), "text")).otherwise(F.col("text"))
    return masking.anonymize(t.documents.select("doc_id", text.alias("text")), "text", SEED, KNOWN)


@case("h2_data_retrieved_hook", "SELECT c_custkey, upper(c_mktsegment) || '!' AS c_mktsegment FROM customer")
def h2(t: Tables) -> DataFrame:
    def shout(tables):
        marked = F.concat(F.upper("c_mktsegment"), F.lit("!"))
        return {"customer": tables["customer"].withColumn("c_mktsegment", marked)}

    loaded = hooks.data_retrieved({"customer": t.customer, "orders": t.orders}, shout)
    return loaded["customer"].select("c_custkey", "c_mktsegment")


@case("h3_before_update_hook", "SELECT c_custkey, round(c_acctbal * 2, 2) AS c_acctbal FROM customer")
def h3(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_acctbal")
    return hooks.before_update(rows, lambda df: df.withColumn("c_acctbal", F.round(F.col("c_acctbal") * 2, 2)))


@case(
    "h4_after_update_hook",
    plan_sql(
        f"CASE WHEN l.target_id IS NULL THEN 'insert' WHEN {DIFFERENT} THEN 'update' ELSE 'skip' END",
        f"CASE WHEN l.target_id IS NOT NULL AND NOT {DIFFERENT} THEN 'same_data' END",
    ),
)
def h4(t: Tables) -> DataFrame:
    folder = scratch_folder(t.spark, "h4")

    def keep(plan: DataFrame) -> None:
        plan.select("c_custkey", "target_id", "action", "skip_reason").write.parquet(folder)

    hooks.after_update(customer_plan(t), keep)
    return t.spark.read.parquet(folder)


@case("h5_filter_hook", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def h5(t: Tables) -> DataFrame:
    from rowferry.operators.filters import filter_hook

    return filter_hook(t.orders.select("o_orderkey", "o_totalprice"), lambda df: df.where("o_totalprice > 100000"))


@case(
    "h6_read_and_write_in_hook",
    X.with_ctes(X.CUSTOMER_TARGET, select="SELECT c_name FROM customer WHERE c_acctbal > 0 EXCEPT SELECT c_name FROM customer_target"),
)
def h6(t: Tables) -> DataFrame:
    folder = scratch_folder(t.spark, "h6")
    context = hooks.HookContext(
        t.spark, {"customer": t.customer}, {"customer": X.customer_target(t)}, lambda name, rows: rows.write.parquet(f"{folder}/{name}")
    )
    there = context.read_many(["customer"], from_source=False)["customer"]
    new = context.read("customer", True, "c_acctbal > 0").join(there, "c_name", "left_anti").select("c_name")
    context.write("new_names", new)
    return t.spark.read.parquet(f"{folder}/new_names")


@case("h7_hook_names_view", 'SELECT c_custkey, c_name AS "Title", c_acctbal AS "Balance" FROM customer WHERE c_acctbal > 1000')
def h7(t: Tables) -> DataFrame:
    names = {"c_name": "Title", "c_acctbal": "Balance"}
    rows = project.rename(t.customer.select("c_custkey", "c_name", "c_acctbal"), names)
    return hooks.in_source_names(rows, names, lambda df: df.where("c_acctbal > 1000"))
