"""Near-duplicates by HyperMinHash.

1. Sketches. The hashes of a document's shingles are dealt into buckets by their first bits. Of the
   smallest in each bucket a register keeps the number of leading zeros and a few mantissa bits.
2. Classes. Documents with equal shingle sets (by size and two sums over the set) are one class;
   from here on a class is one row, however many copies it has.
3. Bands. ``ROWS`` registers make a band (empty buckets borrow a register by a fixed rule), and
   classes that agree in a band meet. Were bands independent, a pair at the threshold would share none
   of ``BANDS`` with probability (1 - 0.75^4)^32, about 5 in a million. Borrowed registers make them
   depend on each other, so few shingles miss more often (README has figures).
   Small sets therefore meet exactly as well: two sets that link share a shingle among the first of
   each, in an order of all shingles, if so many are taken that the rest is too few for a link (prefix
   filter; rarest shingles first). That gives all pairs with a set of ``SMALL`` shingles or fewer.
4. First round: every class of a band's bucket is compared with the bucket's smallest. That makes one
   pair per class and band and joins groups of near copies. A pair goes on if the Jaccard
   estimate from the registers, corrected for chance collisions, is not more than ``SIGMAS`` standard
   errors below the threshold; then the full sets decide.
5. Second round: buckets whose classes are in more than one component hold links that the first
   round did not see. Inside a task their registers are compared across components, in blocks of
   bounded size; pairs whose estimate passes are checked on full sets.
6. Components are followed by joins until nothing changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import NO_ID, batches_of_texts, over_batches, pick, record, stored
from rowferry.llm.kernels import LOWER, U, Words, chunks, mix, windows

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
BUCKET_BITS, MANTISSA_BITS = 8, 10
BANDS, ROWS = 32, 4
SIGMAS = 5.0
#: Pairs with a set of so many shingles or fewer are found exactly.
SMALL = 24
#: Classes of one bucket that a task compares with as many others.
BLOCK = 1024
_BUCKETS = 1 << BUCKET_BITS
_EMPTY = np.uint16(0xFFFF)


def shingle_sets(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted, and the number of them.

    A text with fewer words than a shingle has its whole sequence as one; one without words none.
    """
    h, n = words.hashes(), np.diff(words.first)
    texts = len(n)
    grams = windows(h, size)
    row = np.repeat(np.arange(texts), n)
    ok = row[: len(grams)] == row[size - 1 :] if len(grams) else np.empty(0, bool)
    row, grams = row[: len(grams)][ok], grams[ok]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        whole = np.array([windows(h[words.first[i] : words.first[i + 1]], int(n[i]))[0] for i in short], U)
        row, grams = np.concatenate((row, short)), np.concatenate((grams, whole))
    order = np.lexsort((grams, row))
    row, grams = row[order], grams[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])
    return grams[keep], np.bincount(row[keep], minlength=texts)


def registers(sets: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Registers of each set: in the high bits the leading zeros (more are smaller), in the low bits
    the mantissa, so that the smallest register is that of the smallest hash."""
    out = np.full((len(count), _BUCKETS), _EMPTY)
    h = mix(sets)
    rest = h << U(BUCKET_BITS)
    high = np.frexp(np.maximum(rest >> U(11), U(1)).astype(np.float64))[1].astype(np.int64)  # 53 bits at most
    mantissa = (rest >> U(11)) << (U(64) - np.maximum(high, 1).astype(U)) << U(1) >> U(64 - MANTISSA_BITS)
    value = ((high.astype(U) << U(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    row = np.repeat(np.arange(len(count)), count)
    np.minimum.at(out.reshape(-1), row * _BUCKETS + (h >> U(64 - BUCKET_BITS)).astype(np.int64), value)
    return out


_PROBES = (mix(np.arange(_BUCKETS * 64, dtype=U)) >> U(64 - BUCKET_BITS)).astype(np.int64).reshape(_BUCKETS, 64)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit even key of every band of every row; empty buckets take the first filled one of a
    fixed sequence of buckets."""
    full = regs.copy()
    for k in range(64):
        row, at = np.nonzero(full == _EMPTY)
        if not len(row):
            break
        full[row, at] = regs[row, _PROBES[at, k]]
    row, at = np.nonzero(full == _EMPTY)
    full[row, at] = regs[row].min(1)
    part = full[:, : BANDS * ROWS].reshape(len(regs), BANDS, ROWS).astype(U)
    key = (part << (U(16) * np.arange(ROWS, dtype=U))).sum(2, dtype=U)
    return mix(key ^ mix(np.arange(BANDS, dtype=U) + U(1))) & ~U(1)


def chance_collision(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability that registers of two sets of these sizes agree though their hashes differ."""
    k = np.arange(1, 54)[:, None]
    at_least = lambda n: 1 - (1 - 2.0 ** (1 - k)) ** (n / _BUCKETS)
    exactly = lambda n: at_least(n) - (1 - (1 - 2.0**-k) ** (n / _BUCKETS))
    return (exactly(a) * exactly(b)).sum(0) * 2.0**-MANTISSA_BITS


def may_link(equal: np.ndarray, filled: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether the corrected Jaccard estimate leaves a link possible.

    ``equal`` of the ``filled`` buckets (those not empty in both) agree. Buckets are drawn from the
    union without putting back, so the error is that of a hypergeometric share. Small sets go on
    whatever the estimate.
    """
    j = percent / 100
    chance = chance_collision(a, b)
    estimate = (equal / np.maximum(filled, 1) - chance) / (1 - chance)
    union = (a + b) / (1 + j)
    error = np.sqrt(j * (1 - j) / np.maximum(filled, 1) * np.clip((union - filled) / np.maximum(union - 1, 1), 0, 1))
    fits = np.minimum(a, b) * 100 >= percent * np.maximum(a, b)
    return fits & ((np.minimum(a, b) <= SMALL) | (estimate >= j - SIGMAS * error - 0.02))


def _compare(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    filled = (x != _EMPTY) | (y != _EMPTY)
    return ((x == y) & filled).sum(-1), filled.sum(-1)


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node that links reach, for every node of ``edges`` (a, b)."""
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("before"), F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        new = stored(low.join(jump, "low").select("node", "before", F.least("low", "far").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.where("before != label").isEmpty():
            return labels


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two full sets are similar enough."""
    both = np.concatenate((x, y))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))

    def check(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sides = zip(batch.column(2), batch.column(3))
        keep = [_linked(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U), percent) for x, y in sides]
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(over_batches(check), "a bigint, b bigint")


def _prefixes(small: DataFrame, percent: int) -> DataFrame:
    """Odd keys (key, node) under which all sets meet that may link, from (node, n, small).

    Shingles are ordered by the number of sets that have them, then by hash. Those that no other set
    has come first; they lead nowhere and are only counted.
    """
    parts = small.select("node", "n", F.explode("small").alias("shingle"))
    often = parts.groupBy("shingle").agg(F.count("*").alias("sets")).where("sets > 1").withColumnRenamed("shingle", "_shingle")
    shared = parts.join(often, F.col("shingle") == F.col("_shingle")).groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("shared"))
    least = F.ceil(F.col("n") * percent / 100)
    first = F.slice("shared", 1, F.greatest(F.size("shared") + 1 - least, F.lit(0)).cast("int"))
    return shared.select(F.explode(first).alias("at"), "node").select(F.xxhash64("at.shingle").bitwiseOR(F.lit(1).cast("bigint")).alias("key"), "node")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The component of every document under links of similar shingle sets.

    Returns one row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id that
    links reach, its own included) and kept (doc_id = component_id). Words are ``[^\\x20\\x09-\\x0D]+``
    with A-Z lower-cased. Documents without words (null texts too) link with nothing. Rows that
    share an id are one document to the links. Rows with a null id link by their text and are never
    the smallest unless alone, with component_id null and kept true for the only text of such a
    component. Columns other than the two named ones are not read.
    """
    batches_of_texts(docs.sparkSession)
    reach = SMALL * 100 // percent  # the largest set that links with a small one
    id_type = docs.select(docs[f"`{id_col}`"]).schema[0].dataType.simpleString()
    named = F.col("doc_id").cast("bigint")
    keyed = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce(named, F.lit(NO_ID)).alias("rank"), F.coalesce(named, F.xxhash64("text", F.lit("no id"))).alias("node"), "text")

    def sketch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(3).to_pylist()
        for lo, hi in chunks(texts):
            sets, count = shingle_sets(Words(texts[lo:hi], LOWER))
            regs = registers(sets, count)
            end = np.cumsum(count)
            sums = [np.concatenate(([U(0)], np.cumsum(mix(sets ^ U(salt))))) for salt in (17, 92821)]
            one, two = (s[end] - s[end - count] for s in sums)
            yield record(
                doc_id=batch.column(0).slice(lo, hi - lo), rank=batch.column(1).slice(lo, hi - lo), node=batch.column(2).slice(lo, hi - lo), n=count.astype(np.int64),
                one=one.view(np.int64), two=two.view(np.int64), regs=pa.array([r.tobytes() for r in regs], pa.binary()),
                small=pa.array([sets[e - c : e].view(np.int64) if c <= reach else None for e, c in zip(end.tolist(), count.tolist())], pa.list_(pa.int64())),
            )

    sketches = stored(keyed.mapInArrow(over_batches(sketch), f"doc_id {id_type}, rank bigint, node bigint, n bigint, one bigint, two bigint, regs binary, small array<bigint>"), "sketches")
    filled = sketches.where("n > 0")
    classes = filled.groupBy("n", "one", "two").agg(F.min(F.struct("rank", "node")).alias("first")).select("n", "one", "two", F.col("first.rank").alias("rank"), F.col("first.node").alias("rep"))
    classes = stored(classes, "classes")
    digest = lambda df, mark: df.select(*[F.col(c).alias(mark + c) for c in ("n", "one", "two")], "rep")
    same = lambda mark: (F.col("n") == F.col(mark + "n")) & (F.col("one") == F.col(mark + "one")) & (F.col("two") == F.col(mark + "two"))
    reps = stored(filled.join(digest(classes, "_"), same("_") & (F.col("node") == F.col("rep"))).select("node", "n", "regs", "small").dropDuplicates(["node"]), "representatives")

    def bands(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows:
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, _BUCKETS)
            yield record(key=band_keys(regs).reshape(-1).view(np.int64), node=np.repeat(batch.column(0).to_numpy(), BANDS))

    dealt = reps.select("node", "regs").mapInArrow(over_batches(bands), "key bigint, node bigint")
    dealt = dealt.unionByName(_prefixes(reps.where(F.col("small").isNotNull()).select("node", "n", "small"), percent))
    shared = dealt.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("pivot")).where("members > 1")
    buckets = stored(dealt.join(shared.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key")).drop("_key"), "buckets")
    wanted = buckets.select(F.col("node").alias("_node")).distinct()

    def full_sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(1).to_pylist()
        for lo, hi in chunks(texts):
            sets, count = shingle_sets(Words(texts[lo:hi], LOWER))
            end = np.cumsum(count)
            yield record(node=batch.column(0).slice(lo, hi - lo), n=count.astype(np.int64), hashes=pa.array([sets[e - c : e].tobytes() for e, c in zip(end.tolist(), count.tolist())], pa.binary()))

    found = keyed.where(F.col("text").isNotNull()).select("node", "text").join(wanted, F.col("node") == F.col("_node")).select("node", "text").mapInArrow(over_batches(full_sets), "node bigint, n bigint, hashes binary")
    # of rows that share an id, the set of the class that stands for it
    sets = stored(found.join(reps.select(F.col("node").alias("_node"), F.col("n").alias("_n")), (F.col("node") == F.col("_node")) & (F.col("n") == F.col("_n"))).select("node", "hashes").dropDuplicates(["node"]), "sets")

    def estimate(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, _BUCKETS) for i in (2, 3))
            keep = may_link(*_compare(x, y), batch.column(4).to_numpy().astype(float), batch.column(5).to_numpy().astype(float), percent)
            yield batch.select([0, 1]).filter(pa.array(keep))

    star = buckets.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    of = lambda end, regs, n: reps.select(F.col("node").alias(end), F.col("regs").alias(regs), F.col("n").alias(n))
    likely = star.join(of("a", "x", "m"), "a").join(of("b", "y", "n"), "b").select("a", "b", "x", "y", "m", "n").mapInArrow(over_batches(estimate), "a bigint, b bigint")
    links = stored(_verified(likely, sets, percent), "first-links")
    labels = components(links)

    mine = F.coalesce(F.col("label"), F.col("node"))
    labelled = buckets.join(labels.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select("key", "node", "members", mine.alias("label"))
    split = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select(F.col("key").alias("_key"))
    mixed = stored(labelled.join(split, F.col("key") == F.col("_key")).drop("_key"), "mixed")
    groups = max(1, mixed.count() // 6000)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    # a block meets every other block of its bucket once, and itself
    dealt = mixed.withColumn("block", own).select("*", other.alias("_other")).withColumns({"low": F.least("block", "_other"), "high": F.greatest("block", "_other")})
    dealt = dealt.join(sets.withColumnRenamed("node", "_rep"), F.col("node") == F.col("_rep"))
    dealt = dealt.withColumn("group", F.when(blocks == 1, F.pmod(F.xxhash64("key"), F.lit(groups))).otherwise(F.xxhash64("key", "low", "high").bitwiseOR(F.lit(1 << 62))))

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "low", "high"], kind="stable")
        node, label, block = (pdf[c].to_numpy() for c in ("node", "label", "block"))
        full = [np.frombuffer(x, U) for x in pdf["hashes"]]
        n = np.array([len(x) for x in full])
        regs = registers(np.concatenate(full), n)
        meeting = pdf.groupby(["key", "low", "high"], sort=False).ngroup().to_numpy()
        keys = band_keys(regs).view(np.int64)
        one_block = (pdf["low"] == pdf["high"]).to_numpy()
        edge = np.flatnonzero(np.concatenate(([True], meeting[1:] != meeting[:-1], [True])))
        found = []
        for lo, hi, key in zip(edge[:-1], edge[1:], pdf["key"].to_numpy()[edge[:-1]]):
            for i in range(lo, hi - 1):
                rows = np.arange(i + 1, hi)
                rows = rows[label[rows] != label[i]]
                if not one_block[lo]:
                    rows = rows[block[rows] != block[i]]
                if not len(rows):
                    continue
                equal, filled = _compare(regs[rows], regs[i])
                rows = rows[may_link(equal, filled, np.full(len(rows), float(n[i])), n[rows].astype(float), percent)]
                # a pair that shares several bands is looked at in the first of them
                if not key & 1:
                    rows = rows[keys[i][(keys[rows] == keys[i]).argmax(1)] == key]
                found += [(node[i], node[j]) for j in rows.tolist() if _linked(full[i], full[j], percent)]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs.min(1), "b": pairs.max(1)}) if len(pairs) else pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    more = dealt.select("group", "key", "low", "high", "block", "node", "label", "hashes").groupBy("group").applyInPandas(across, "a bigint, b bigint")
    more = stored(more, "second-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    known = classes.join(labels.withColumnRenamed("node", "_node"), F.col("rep") == F.col("_node"), "left").select("n", "one", "two", "rank", F.coalesce("label", "rep").alias("label"))
    # rows that share an id are one document: their classes are joined through it
    smallest = known.groupBy("label").agg(F.min("rank").alias("smallest"))
    known = known.join(smallest.withColumnRenamed("label", "_label"), F.col("label") == F.col("_label")).select(F.col("n").alias("_n"), F.col("one").alias("_one"), F.col("two").alias("_two"), "smallest")
    out = sketches.drop("regs", "small").join(known, same("_"), "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.when(F.col("smallest") < NO_ID, F.col("smallest")).cast(id_type))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
