"""Nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. In a shard, every pivot has an inverted file
of the vectors that have it among their nearest, with its place there. A query adds up, over its own
nearest pivots, the footrule distance of places; pivots that a vector lacks count as the place after
the last. The vectors of smallest footrule distance are ranked again by the exact inner product.

Every vector is indexed. Shards of vectors meet blocks of queries, both of bounded size, and each
meeting returns its best; these are merged per query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import find_package, pick, stored

NEAREST = 20
#: Pivots, those vectors with the smallest hashes of their ids, and how many represent a vector.
PIVOTS, PREFIX = 128, 48
#: Vectors in a shard and queries in a block, at most about.
SHARD, BLOCK = 8192, 2048
#: Part of a shard, and number of vectors at least, that is ranked again exactly.
AGAIN, AGAIN_LEAST = 0.3, 500


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the pivots with the largest cosine, nearest first, equals by number."""
    likeness = vectors @ pivots.T
    return np.argsort(-likeness, axis=1, kind="stable")[:, :prefix]


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray, prefix: int, k: int) -> pd.DataFrame:
    """The best ``k`` of one shard for every query of a block."""
    prefix = min(prefix, len(pivots))
    near, asked = nearest_pivots(vectors, pivots, prefix), nearest_pivots(queries, pivots, prefix)
    pivot = near.ravel()
    order = np.argsort(pivot, kind="stable")
    files = np.searchsorted(pivot[order], np.arange(len(pivots) + 1))
    who, place = order // prefix, (order % prefix).astype(np.float32)
    again = min(len(ids), max(AGAIN_LEAST, int(AGAIN * len(ids)), k + 1))
    found = []
    for q in range(len(query_ids)):
        # from the distance of a vector that has none of the query's pivots, what each shared one saves
        saved = np.zeros(len(ids), np.float32)
        for at, p in enumerate(asked[q]):
            a, b = files[p], files[p + 1]
            saved[who[a:b]] += (prefix - at) + (prefix - place[a:b]) - np.abs(place[a:b] - at)
        top = np.argpartition(-saved, again - 1)[:again] if again < len(ids) else np.arange(len(ids))
        score = vectors[top] @ queries[q]
        other = ids[top] != query_ids[q]
        top, score = top[other], score[other]
        if len(top) > k:
            # all that tie with the k-th stay until ids decide
            limit = np.partition(score, len(score) - k)[len(score) - k]
            top, score = top[score >= limit], score[score >= limit]
        best = np.lexsort((ids[top], -score))[:k]
        found.append((np.full(len(best), query_ids[q]), ids[top][best], score[best]))
    parts = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), parts)))


def search(vectors: DataFrame, is_query: Column, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, prefix: int = PREFIX, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """The ``k`` nearest rows found for every row for which ``is_query`` (on vec_id) holds.

    Returns query_id, rank from 1, vec_id, score (inner product in double precision), ties to the
    smaller vec_id. Rows with a null id take no part, nor do vectors that are null, zero, hold null
    or non-finite components, or differ in length from most (of equally common lengths, the
    longest). Rows that repeat an id are candidates each, but never for a query of that id. An
    empty table gives no rows.
    """
    spark = find_package(vectors.sparkSession)
    rows = pick(vectors, vec_id=id_col, vector=vector_col).where(F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == sizes["size"])
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(pivots).collect()
    matrix = np.array([r["vector"] for r in chosen])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    shards, n_queries = -(-sizes["n"] // shard), rows.where(is_query).count()
    blocks = max(1, -(-n_queries // block))
    # a row's parts follow a hash of id and vector, so a retried task deals alike
    deal = F.xxhash64("vec_id", "vector")
    dealt = rows.select("vec_id", "vector", F.pmod(deal, F.lit(shards)).cast("int").alias("shard"))
    asked = rows.where(is_query).dropDuplicates(["vec_id"]).select("vec_id", "vector", F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.lit(blocks)).cast("int").alias("block"))
    left = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        return search_shard(a["vec_id"].to_numpy(), np.stack(a["vector"].to_numpy()), b["vec_id"].to_numpy(), np.stack(b["vector"].to_numpy()), matrix, prefix, k)

    best = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(meet, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = stored(best, "nearest").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")
