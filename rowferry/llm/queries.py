"""One query per operator, on its whole table, with the digest columns of the contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm import ballhash, decontamination, language, longmatches, merkle, neardup, neighbours, packing, quality, secrets, substrings, urls, whitening
from rowferry.llm.common import crc_mod, load

Query = Callable[[SparkSession, str], DataFrame]
CASES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def case(fn: Query) -> Query:
    CASES[fn.__name__] = fn
    return fn


def tokenizer() -> str:
    """Where the vocabulary lies; the installation's own place, not a copy."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@case
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = load(spark, folder, "documents"), load(spark, folder, "labels")
    model = quality.train_on(docs, labels.where(crc_mod("doc_id", 3) != 1), label_col="quality")
    scored = quality.score(docs, model)
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@case
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = substrings.remove_repeats(load(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@case
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    line = lambda column: F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter(spans, lambda s: s["kind"] != "markov")
    return secrets.scan(load(spark, folder, "documents")).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(line(base), 256).alias("base_sha256"), line(spans).alias("spans")
    )


@case
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(load(spark, folder, "documents"), tokenizer())


@case
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(load(spark, folder, "pages"))


@case
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = language.train(docs, ~held_out)
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@case
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_hits(load(spark, folder, "documents"), load(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontamination.contaminated().alias("contaminated")
    )


@case
def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(load(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@case
def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = longmatches.remove_long_matches(load(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@case
def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(load(spark, folder, "documents"))


@case
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    leaves = merkle.document_leaves(docs, F.coalesce(crc_mod("doc_id", 7) == 0, F.lit(False)))
    return merkle.manifest(leaves).select(F.col("at").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


#: CRC-32 of the decimal text of doc_id, bit by bit with the reversed polynomial 0xEDB88320.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{amount}", "text")) + ")"


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves`` (k, pos, size, h)."""
    return f"""{name}(k, level, pos, size, h) AS (
    SELECT k, 0, pos, size, h FROM ({leaves})
    UNION ALL
    SELECT k, level + 1, pos // 2, max((size + 1) // 2), sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE size > 1 GROUP BY k, level, pos // 2)"""


def _folds(name: str, tree: str, leaves: str) -> str:
    """What each row of ``leaves`` (id, k, pos, h) leads to at every level of its tree."""
    return f"""{name}(id, k, pos, level, h) AS (
    SELECT id, k, pos, 0, h FROM ({leaves})
    UNION ALL
    SELECT f.id, f.k, f.pos, f.level + 1, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN (f.pos >> f.level) % 2 = 1 THEN s.h || f.h ELSE f.h || s.h END)
    FROM {name} f
    JOIN (SELECT DISTINCT k, level FROM {tree} WHERE size > 1) open ON open.k = f.k AND open.level = f.level
    LEFT JOIN {tree} s ON s.k = f.k AND s.level = f.level AND s.pos = xor(f.pos >> f.level, 1))"""


ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE base AS (
    SELECT doc_id, coalesce('=' || lang, '') AS k, {_LEAF.format(amount="n_chars")} AS leaf,
        CASE WHEN {_CRC} % 7 = 0 THEN {_LEAF.format(amount="(n_chars + 1)")} END AS claimed
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (ORDER BY k, doc_id NULLS FIRST, leaf) AS id, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY k) AS size
    FROM base),
{_tree("low", "SELECT k, pos, size, leaf AS h FROM placed")},
tops AS (SELECT k AS lang_k, 0 AS k, h, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS size FROM low WHERE size = 1),
{_tree("high", "SELECT k, pos, size, h FROM tops")},
{_folds("low_fold", "low", "SELECT id, k, pos, coalesce(claimed, leaf) AS h FROM placed")},
arrived AS (SELECT id, k, arg_max(h, level) AS h FROM low_fold GROUP BY id, k),
{_folds("high_fold", "high", "SELECT a.id, 0 AS k, t.pos, a.h FROM arrived a JOIN tops t ON t.lang_k = a.k")},
folded AS (SELECT id, arg_max(h, level) AS h FROM high_fold GROUP BY id),
low_proof AS (
    SELECT p.id, string_agg(s.h, '' ORDER BY s.level) AS h FROM placed p
    JOIN low s ON s.k = p.k AND s.size > 1 AND s.pos = xor(p.pos >> s.level, 1) GROUP BY p.id),
high_proof AS (
    SELECT t.lang_k, string_agg(s.h, '' ORDER BY s.level) AS h FROM tops t
    JOIN high s ON s.size > 1 AND s.pos = xor(t.pos >> s.level, 1) GROUP BY t.lang_k),
root AS (SELECT h FROM high WHERE size = 1)
SELECT p.doc_id, p.leaf, t.h AS subroot, root.h AS root, sha256(coalesce(l.h, '') || coalesce(u.h, '')) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM placed p CROSS JOIN root JOIN tops t ON t.lang_k = p.k JOIN folded f ON f.id = p.id LEFT JOIN low_proof l ON l.id = p.id LEFT JOIN high_proof u ON u.lang_k = p.k
"""


@case
def op12_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return ballhash.near_duplicates(load(spark, folder, "documents"))


@case
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load(spark, folder, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors)).withColumn("deviation", F.col("deviation").try_cast("bigint"))
