"""The corpus pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; between stages it is
written as Parquet and read again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm import decontamination, language, neardup, packing, secrets
from rowferry.llm.common import load, stored
from rowferry.llm.queries import tokenizer

#: A language is accepted from this posterior on.
MIN_LANGUAGE_SCORE = 0.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the documents whose language is identified; ``und`` and unsure ones go.

    The model is trained on the documents' own labels; ``lang`` becomes the identified language.
    """
    model = language.train(docs)
    return language.predict(docs, model, keep=("source", "n_chars")).where(F.col("score") >= MIN_LANGUAGE_SCORE).select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    kept = neardup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops the documents that benchmark passages contaminate; all others stay as they are."""
    found = decontamination.find_hits(docs, load(spark, folder, "benchmark"), keep=("lang", "source", "n_chars"))
    return found.where(~decontamination.contaminated()).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replaces secrets in the texts; ``n_chars`` follows the text."""
    scanned = secrets.redact(secrets.scan(docs, keep=("lang", "source", "n_chars")))
    changed = F.size("spans") > 0
    return scanned.select("doc_id", "text", "lang", "source", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Tokenises and packs what is left: a row per piece with its sequence and place there."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]
#: SQL cannot express the classifier, the models and the vocabulary; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = load(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
