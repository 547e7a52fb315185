"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL.

Features of a text: its words, pairs of words, and the same for the outlines of words (runs of
letters, capitals, digits and signs as one character each), hashed into buckets; a pair of equal
words is one feature of its own. A text's value of a feature is its share among the text's
features, so long and short texts compare. Scoring is a sparse dot product per text.

Training follows the regularised leader, one labelled text after another, on a sample bounded by
``SAMPLE_ROWS``; its features are made on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import batches_of_texts, over_batches, pick, record, sampled, stored
from rowferry.llm.kernels import PLAIN, U, Words, chunks, mix, span_hashes

BUCKETS = 1 << 18
#: Labelled texts, those with the smallest hashes, that the model is fitted on.
SAMPLE_ROWS = 5000
EPOCHS = 3
#: Values are shares times this; the learner's step size and its two regularisers.
SCALE, ALPHA, BETA, L1, L2 = 20.0, 0.3, 1.0, 0.002, 0.01

_OUTLINE = np.arange(256, dtype=np.uint8)
_OUTLINE[97:123] = _OUTLINE[128:] = 97
_OUTLINE[65:91] = 65
_OUTLINE[48:58] = 48


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def _features(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of some texts, and the number of them in each."""
    words = Words(texts, PLAIN)
    h = words.hashes()
    n = np.diff(words.first)
    shape = _OUTLINE[words.bytes]
    change = np.concatenate(([True], shape[1:] != shape[:-1]))
    change[words.start] = True
    at = np.cumsum(change) - 1
    short = np.concatenate((shape[change], np.zeros(8, np.uint8)))
    start = at[words.start]
    outline = span_hashes(short, start, at[words.start + words.length - 1] - start + 1, 1)
    text = np.repeat(np.arange(len(texts)), n)
    pair = text[1:] == text[:-1]
    row, kinds = [], []
    for of, salt in ((h, 3), (outline, 5)):
        two = mix(of[:-1] * U(salt) + of[1:])
        two[h[:-1] == h[1:]] = U(0x1234567 * salt)
        row += [text, text[1:][pair]]
        kinds += [of, two[pair]]
    row, kind = np.concatenate(row), np.concatenate(kinds) >> U(64 - BUCKETS.bit_length() + 1)
    count = np.bincount(row, minlength=len(texts))
    order = np.argsort(row, kind="stable")
    return kind[order].astype(np.int64), count


def train_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits the model on the texts of labelled ids.

    At most ``sample_rows`` pairs of id and label are drawn from ``labels`` alone, those with the
    smallest hashes; they are broadcast (their number is the bound), so that of ``docs`` only the
    chosen texts move. Null ids and labels take no part; ids without a text are left out.
    """
    known = pick(labels, id=id_col, label=label_col).where(F.col("id").isNotNull() & F.col("label").isNotNull())
    chosen = known.select(F.col("id").alias("_id"), F.col("label").cast("int").alias("label")).distinct()
    chosen = chosen.orderBy(F.xxhash64(F.col("_id").cast("string")), "_id", "label").limit(sample_rows)
    batches_of_texts(docs.sparkSession)
    texts = pick(docs, id=id_col, text=text_col)
    return train(stored(texts.join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("id", "text", "label"), "labelled"), "id", "text", "label", sample_rows)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits the model on rows of text and label (0 or 1); null labels and texts take no part.

    The order, and the sample if there are more than ``sample_rows`` rows, follow a hash of id and
    text. Without any row all scores are one half. The driver receives the features of the sample as
    Arrow arrays, eight bytes for each feature that a text has.
    """
    batches_of_texts(labelled.sparkSession)
    rows = pick(labelled, id=id_col, text=text_col, label=label_col).where(F.col("label").isNotNull() & F.col("text").isNotNull())
    order = F.xxhash64(F.col("id").cast("string"), "text")
    ranked = rows.select("text", F.col("label").cast("int").alias("label"), order.alias("rank"))
    sample = sampled(ranked, "rank", sample_rows).groupBy("rank", "label").agg(F.min("text").alias("text")).select("text", "label", "rank")

    def features(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(0).to_pylist()
        buckets, values = [], []
        for lo, hi in chunks(texts):
            kind, count = _features(texts[lo:hi])
            ends = np.cumsum(count)
            for end, n in zip(ends.tolist(), count.tolist()):
                own, times = np.unique(kind[end - n : end], return_counts=True)
                buckets.append(own.astype(np.int32).tobytes())
                values.append((times * (SCALE / max(n, 1))).astype(np.float32).tobytes())
        yield record(label=batch.column(1), rank=batch.column(2), bucket=pa.array(buckets, pa.binary()), value=pa.array(values, pa.binary()))

    found = sample.mapInArrow(over_batches(features), "label int, rank bigint, bucket binary, value binary").toArrow()
    of = lambda name, kind: [np.frombuffer(b.as_buffer(), kind) for b in found.column(name)]
    rank, label = found.column("rank").to_pylist(), found.column("label").to_pylist()
    examples = list(zip(of("bucket", np.int32), of("value", np.float32), label))
    return _follow([examples[i] for i in sorted(range(len(examples)), key=lambda i: (rank[i], label[i]))])


def _follow(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        return np.where(np.abs(own) <= L1, 0.0, (np.sign(own) * L1 - own) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    ones = sum(label for *_, label in examples)
    balance = (len(examples) / max(1, 2 * (len(examples) - ones)), len(examples) / max(1, 2 * ones))
    for _ in range(EPOCHS):
        for bucket, value, label in examples:
            at, x = np.append(bucket, BUCKETS), np.append(value.astype(np.float64), 1.0)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x * balance[label]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    everything = weights(np.arange(BUCKETS + 1))
    return Model(everything[:BUCKETS].astype(np.float32), float(everything[BUCKETS]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and score (0 to 1) of every row, from the whole text alone.

    Null and empty texts get the score of no features. Repeated rows and null ids stay as they are.
    """
    spark = batches_of_texts(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers
    chosen = pick(docs, doc_id=id_col, text=text_col)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(1).to_pylist()
        out = np.empty(len(texts))
        for lo, hi in chunks(texts):
            kind, count = _features(texts[lo:hi])
            edge = np.concatenate(([0.0], np.cumsum(shared.value.weights[kind], dtype=np.float64)))
            end = np.cumsum(count)
            out[lo:hi] = (edge[end] - edge[end - count]) * SCALE / np.maximum(count, 1) + shared.value.bias
        yield record(doc_id=batch.column(0), text=batch.column(1), score=1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return chosen.mapInArrow(over_batches(run), f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, text string, score double")
