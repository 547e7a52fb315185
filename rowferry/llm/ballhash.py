"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius. Two fingerprints within the
radius share a variant, and all that share one lie within the radius of each other, so a variant
never has more members than its own ball has points, whatever the data. Copies are one fingerprint
before anything is emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import NO_ID, batches_of_texts, over_batches, pick, record, stored
from rowferry.llm.neardup import components

#: Words of a shingle, seed of its hash, bits of a fingerprint, largest distance of a link.
SHINGLE, SEED, BITS, RADIUS = 3, 42, 64, 2
#: Shingles that are turned into bits at a time.
BLOCK = 1 << 16
#: Bytes hold the count of a bit over so many shingles.
_RUN = 255


def _ones(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """How many hashes of each stretch have each bit, highest bit first. Eight bytes, each a
    count of one bit, are added as one number."""
    n = np.diff(np.append(start, len(hashes)))
    runs = -(-n // _RUN)
    first = np.cumsum(runs) - runs
    at = np.repeat(start, runs) + (np.arange(runs.sum()) - np.repeat(first, runs)) * _RUN
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
    part = np.add.reduceat(bits, at, axis=0).view(np.uint8)
    return np.add.reduceat(part, first, axis=0, dtype=np.int64)


def fingerprints(texts: list[bytes | None], size: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text: bit set if over half of its shingles' hashes have it set.

    Shingles count as often as they occur. Of fewer than ``size`` words the whole sequence is the
    only shingle; without words the fingerprint is zero. A long text goes through in blocks.
    """
    ones, shingles = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    waiting: list[int] = []
    owner: list[int] = []
    start: list[int] = []

    def flush() -> None:
        if waiting:
            ones_of = _ones(np.array(waiting, np.uint64), np.array(start))
            np.add.at(ones, owner, ones_of)
        for pending in (waiting, owner, start):
            pending.clear()

    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.lower().split() if text else []
        if not words:
            continue
        count = max(len(words) - size + 1, 1)
        shingles[i] = count
        for lo in range(0, count, BLOCK):
            part = words[lo : lo + BLOCK + size - 1]
            owner.append(i)
            start.append(len(waiting))
            if len(part) <= size:
                waiting.append(digest(b" ".join(part), SEED))
            else:
                waiting += [digest(b" ".join(s), SEED) for s in zip(*(part[k:] for k in range(size)))]
            if len(waiting) >= BLOCK:
                flush()
    flush()
    return np.packbits(2 * ones > shingles[:, None], axis=1).view(">u8").reshape(-1).astype(np.uint64)


def masks(reach: int) -> list[int]:
    """All patterns of at most ``reach`` set bits, as signed numbers."""
    found = [sum(1 << b for b in chosen) for n in range(reach + 1) for chosen in combinations(range(BITS), n)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints in column ``fp`` whose links connect all that differ in
    at most ``radius`` bits. ``radius`` is even, so that all members of a variant link with each
    other: each is paired with the next one only."""
    if radius % 2:
        raise ValueError("the radius must be even")
    variants = classes.select("fp", F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks(radius // 2)])).alias("mask"))
    meeting = variants.select(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), F.col("fp").alias("b"))
    pairs = meeting.withColumn("a", F.lag("b").over(Window.partitionBy("variant").orderBy("b"))).where(F.col("a").isNotNull())
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint and component of every document under links of near fingerprints.

    One row per row of ``docs``: doc_id (an integer), fingerprint (16 hex digits), component_id (the
    smallest doc_id that links reach, its own included). Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z
    lower-cased. Null and empty texts have fingerprint zero and link like any other. Rows that share
    an id stay rows of their own. Null ids link by their text and come last: component_id is null
    only where no row of the component has an id. Columns other than the two named are not read.
    """
    batches_of_texts(docs.sparkSession)
    id_type = docs.select(docs[f"`{id_col}`"]).schema[0].dataType.simpleString()

    def sketch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        yield record(doc_id=batch.column(0), fp=fingerprints(texts).view(np.int64))

    rows = stored(pick(docs, doc_id=id_col, text=text_col).mapInArrow(over_batches(sketch), f"doc_id {id_type}, fp bigint"), "fingerprints")
    rank = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    classes = stored(rows.groupBy("fp").agg(F.min(rank).alias("rank")), "classes")
    labels = components(links(classes, radius)).withColumnRenamed("node", "_node")
    known = classes.join(labels, F.col("fp") == F.col("_node"), "left").select("fp", "rank", F.coalesce("label", "fp").alias("label"))
    smallest = known.groupBy("label").agg(F.min("rank").alias("smallest")).withColumnRenamed("label", "_label")
    reached = known.join(smallest, F.col("label") == F.col("_label")).select(F.col("fp").alias("_fp"), "smallest")
    component = F.when(F.col("smallest") < NO_ID, F.col("smallest")).cast(id_type)
    return rows.join(reached, F.col("fp") == F.col("_fp")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))
