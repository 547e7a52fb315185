"""Column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions import cells, keys, text
from suite.registry import Tables, case


@case(
    "k1_cell_normalisation",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN NULL WHEN '3-MEDIUM' THEN ' x' ELSE o_orderpriority END AS cell FROM orders""",
)
def k1(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    raw = F.when(p == "1-URGENT", "  ").when(p == "2-HIGH", " #n/a\r").when(p == "3-MEDIUM", " x\r\r").otherwise(p)
    return t.orders.select("o_orderkey", cells.normalize_cell(raw).alias("cell"))


@case(
    "k2_numeric_cast",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN 1200.0 END AS number, CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 1200 ELSE NULL END::BIGINT AS whole FROM orders""",
)
def k2(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    raw = F.when(s == "F", F.concat(F.lit(" "), F.col("o_totalprice").cast("string"), F.lit("\t"))).when(s == "O", "1.2e3").otherwise("12x")
    whole = F.when(s == "F", "NaN").when(s == "O", "1200").otherwise("9d")
    return t.orders.select("o_orderkey", cells.to_number(raw).alias("number"), cells.to_integer(whole).alias("whole"))


@case(
    "k3_boolean_cast",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN TRUE WHEN '2-HIGH' THEN FALSE WHEN '3-MEDIUM' THEN TRUE END AS flag FROM orders""",
)
def k3(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    raw = F.when(p == "1-URGENT", " YES").when(p == "2-HIGH", "off").when(p == "3-MEDIUM", "1").otherwise(p)
    return t.orders.select("o_orderkey", cells.to_boolean(raw).alias("flag"))


@case(
    "k4_european_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '31.02.' || strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def k4(t: Tables) -> DataFrame:
    s, d = F.col("o_orderstatus"), F.col("o_orderdate")
    raw = (
        F.when(s == "P", F.concat(F.lit("31.02."), F.date_format(d, "yyyy")))
        .when(s == "F", F.date_format(d, "d/M/yy"))
        .otherwise(F.date_format(d, "dd-MM-yyyy"))
    )
    return t.orders.select("o_orderkey", cells.european_date_text(raw).alias("day"))


@case(
    "k5_european_datetime",
    """SELECT event_id, CASE event_type WHEN 'error' THEN '01.01.2024 25:00' WHEN 'view' THEN strftime(ts, '%Y-%m-%dT00:00:00.000Z')
  WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:00.000Z') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') END AS at FROM events""",
)
def k5(t: Tables) -> DataFrame:
    k, ts = F.col("event_type"), F.col("ts")
    raw = (
        F.when(k == "error", "01.01.2024 25:00")
        .when(k == "view", F.date_format(ts, "d.M.yyyy"))
        .when(k == "click", F.date_format(ts, "dd/MM/yy'T'H:m"))
        .otherwise(F.date_format(ts, "dd-MM-yyyy HH:mm:ss"))
    )
    return t.events.select("event_id", cells.european_datetime_text(raw).alias("at"))


@case("k6_datetime_text", "SELECT event_id, strftime(ts, '%Y-%m-%d  %H:%M:%S.%g') AS at FROM events")
def k6(t: Tables) -> DataFrame:
    return t.events.select("event_id", cells.datetime_text(F.col("ts")).alias("at"))


@case("k8_truncate_to_length", "SELECT doc_id, left(text, 80) AS text, left(CAST(n_chars AS VARCHAR), 2) AS n FROM documents")
def k8(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", cells.truncate(F.col("text"), 80).alias("text"), cells.truncate(F.col("n_chars"), 2).alias("n"))


@case(
    "k11_row_hash",
    "SELECT min(o_orderkey) AS first_order, count(*) AS rows FROM orders GROUP BY o_custkey, o_orderstatus, o_orderpriority",
)
def k11(t: Tables) -> DataFrame:
    hashed = keys.row_hash(t.orders, ["o_orderkey", "o_totalprice", "o_orderdate"])
    classes = t.orders.groupBy(hashed.alias("hash")).agg(F.min("o_orderkey").alias("first_order"), F.count("*").alias("rows"))
    return classes.select("first_order", "rows")


@case(
    "k11_row_digest",
    """SELECT o_orderkey, sha256(o_custkey || '|' || replace(o_orderpriority, ' ', '') || '|' || o_orderstatus) AS digest FROM orders""",
)
def k11_digest(t: Tables) -> DataFrame:
    digest = keys.row_digest(t.orders, ["o_orderkey", "o_totalprice", "o_orderdate"])
    return t.orders.select("o_orderkey", digest.alias("digest"))


@case(
    "k12_row_ids",
    """SELECT upper(substr(sha256('orders|' || o_orderkey || '|' || o_orderstatus), 1, 18)) AS id, 'ID' || lpad(CAST(o_orderkey AS VARCHAR), 16, '0') AS counter FROM orders""",
)
def k12(t: Tables) -> DataFrame:
    return t.orders.select(keys.row_id("orders", "o_orderkey", "o_orderstatus").alias("id"), keys.counter_id(F.col("o_orderkey")).alias("counter"))


@case("k15_url_domain", "SELECT page_id, nullif(regexp_extract(url, '(?i)^https?://([^/?#]+)', 1), '') AS domain FROM pages")
def k15(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.url_domain(F.col("url")).alias("domain"))


@case("k16_accent_removal", f"SELECT doc_id, translate(text, '{text.ACCENTED}', '{text.PLAIN}') AS text FROM documents")
def k16(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.strip_accents(F.col("text")).alias("text"))


@case("k19_safe_file_name", r"""SELECT page_id, regexp_replace(url, '[<>:"/\\|?*]', '_', 'g') AS name FROM pages""")
def k19(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.safe_file_name(F.concat(F.lit("  "), F.col("url"), F.lit(" "))).alias("name"))


@case(
    "k20_base64",
    """SELECT doc_id, is64, decode(from_base64(b)) = source || lang || md5(text) AS same FROM (SELECT doc_id, source, lang, text,
  to_base64(encode(source || lang || md5(text))) AS b, length(to_base64(encode(source || lang || md5(text)))) >= 16 AS is64 FROM documents)""",
)
def k20(t: Tables) -> DataFrame:
    plain = F.concat("source", "lang", F.md5("text"))
    body = text.as_base64(F.concat(plain, F.lit("")))
    # A value that is base64 already stays as it is, so encoding twice changes nothing.
    again = text.as_base64(F.base64(F.encode(plain, "UTF-8")))
    rows = t.documents.select("doc_id", plain.alias("p"), again.alias("b"), body.alias("once"))
    return rows.select("doc_id", text.looks_like_base64(F.col("b")).alias("is64"), (F.decode(F.unbase64("b"), "UTF-8") == F.col("p")).alias("same"))


@case(
    "k21_loose_inequality",
    """SELECT o_orderkey, o_orderstatus = 'P' AS number_differs, o_orderstatus <> 'O' AS flag_differs, o_orderstatus = 'F' AS text_differs FROM orders""",
)
def k21(t: Tables) -> DataFrame:
    s, total = F.col("o_orderstatus"), F.col("o_totalprice")
    as_text = F.when(s == "P", None).otherwise(total.cast("string"))
    one = F.when(s == "O", "1").otherwise("false")
    blank = F.when(s == "F", "")
    return t.orders.select(
        "o_orderkey",
        cells.differs(as_text, total, T.DoubleType()).alias("number_differs"),
        cells.differs(one, F.lit(True), T.BooleanType()).alias("flag_differs"),
        cells.differs(blank, F.lit(None).cast("string"), T.StringType()).alias("text_differs"),
    )


@case("k22_null_token_on_write", "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS value FROM orders")
def k22(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    return t.orders.select("o_orderkey", cells.unwrite_null(F.when(p == "5-LOW", "#N/A").otherwise(p)).alias("value"))


@case(
    "k23_error_text",
    """SELECT conv_id, turn, CASE role WHEN 'user' THEN 'user; Unknown error' WHEN 'assistant' THEN role END AS errors FROM conversations""",
)
def k23(t: Tables) -> DataFrame:
    def entry(message):
        return F.struct(message.alias("message"))

    role = F.col("role")
    errors = (
        F.when(role == "user", F.array(entry(role), entry(F.lit(None).cast("string"))))
        .when(role == "assistant", F.array(entry(role)))
        .otherwise(F.array().cast("array<struct<message:string>>"))
    )
    return t.conversations.select("conv_id", "turn", text.error_text(errors).alias("errors"))
