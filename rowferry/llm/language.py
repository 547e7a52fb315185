"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of every labelled text: each task adds its texts to one table, and the
tables are added up. The model, one row of log-probabilities per language, is of fixed size for a
number of languages; it is broadcast, and texts are scored in numpy as sparse sums of its entries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import batches_of_texts, columns_of, over_batches, pick, record
from rowferry.llm.kernels import chunks

#: Buckets for the hashes of n-grams, and the lengths of the n-grams.
BUCKETS = 1 << 14
SIZES = (2, 3)
#: More labels than this are not languages; the model would not be small any more.
MAX_LANGUAGES = 512
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages
    prior: np.ndarray


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some texts, and the number of them in each."""
    parts = [" " + t.lower() + " " for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    point = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    # a run of anything but letters counts as its own characters, digits as one
    point = np.where((point >= 48) & (point < 58), np.uint32(48), point)
    two = point[:-1] * np.uint32(0x9E3779B1) ^ point[1:] * np.uint32(0x85EBCA77)
    three = (two[:-1] ^ (two[:-1] >> np.uint32(15))) * np.uint32(0x2C1B3C6D) ^ point[2:] * np.uint32(0x297A2D39)
    both = np.empty((len(point), 2), np.uint32)  # n-grams by the place they start
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    both[:-1, 0], both[:-2, 1] = (two * np.uint32(0x27D4EB2F)) >> shift, (three * np.uint32(0x27D4EB2F)) >> shift
    inside = np.ones(both.shape, bool)
    ends = np.cumsum(sizes)
    inside[ends - 1] = False
    inside[ends - 2, 1] = False
    return both[inside], sizes * 2 - 3


def train(docs: DataFrame, use: Column | None = None, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts all texts that have a language (and for which ``use`` holds) into a model.

    Null texts and null languages take no part. Without a single labelled text the model has no
    language, and every prediction is ``und``.
    """
    batches_of_texts(docs.sparkSession)
    labelled = docs if use is None else docs.where(use)
    labelled = pick(labelled, lang=lang_col, text=text_col).where(F.col("text").isNotNull() & F.col("lang").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in chunks(texts):
                grams, sizes = _grams(texts[lo:hi])
                row_lang = np.array(langs[lo:hi], object)
                for lang in set(langs[lo:hi]):
                    table = tables.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                    mine = row_lang == lang
                    table[:BUCKETS] += np.bincount(grams[np.repeat(mine, sizes)], minlength=BUCKETS)
                    table[BUCKETS] += mine.sum()
        for lang, table in tables.items():
            at = np.flatnonzero(table)
            yield record(lang=pa.array([lang] * len(at)), bucket=at, n=table[at])

    counted = labelled.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))
    rows = sorted(packed.limit(MAX_LANGUAGES + 1).collect(), key=lambda r: r["lang"])  # a row per language, of bounded size
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values")
    counts = np.zeros((len(rows), BUCKETS + 1))
    for i, row in enumerate(rows):
        for bucket, n in row["cells"]:
            counts[i, bucket] = n
    grams = counts[:, :BUCKETS] + 0.5
    log_probability = np.log(grams / grams.sum(1, keepdims=True)).T
    prior = np.log((counts[:, BUCKETS] + 1) / (counts[:, BUCKETS] + 1).sum()) if len(rows) else np.zeros(0)
    return Model([r["lang"] for r in rows], np.ascontiguousarray(log_probability, np.float32), prior)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, lang_pred and score (the posterior of lang_pred, 0 for ``und``) of every row, and
    the columns to ``keep``.

    Whole texts are scored. Null texts, and texts without a letter, are ``und``. Equal scores go to
    the language that sorts first. Repeated rows and null ids stay as they are.
    """
    spark = batches_of_texts(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # at most MAX_LANGUAGES x BUCKETS numbers
    chosen = pick(docs, doc_id=id_col, text=text_col, **{name: name for name in keep})

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = shared.value
        texts = batch.column(1).to_pylist()
        lang: list[str] = []
        score = np.zeros(len(texts))
        for lo, hi in chunks(texts, 1 << 19):
            part = [t or "" for t in texts[lo:hi]]
            grams, sizes = _grams(part)
            starts = np.cumsum(sizes) - sizes
            if not own.languages:
                lang += [UNKNOWN] * len(part)
                continue
            total = np.empty((len(part), len(own.languages)))
            for k in range(len(own.languages)):
                # every text has at least one n-gram, as it is read with a space on both sides
                total[:, k] = np.add.reduceat(own.log_probability[:, k][grams].astype(np.float64), starts) + own.prior[k]
            best = total.argmax(1)
            chance = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
            for i, text in enumerate(part):
                known = _LETTER.search(text) is not None
                lang.append(own.languages[best[i]] if known else UNKNOWN)
                score[lo + i] = chance[i] if known else 0.0
        rest = {name: batch.column(name) for name in keep}
        yield record(doc_id=batch.column(0), text=batch.column(1), **rest, lang_pred=pa.array(lang, pa.string()), score=score)

    return chosen.mapInArrow(over_batches(run), f"{columns_of(chosen)}, lang_pred string, score double")
