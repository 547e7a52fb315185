"""Merkle manifest of a dataset by butterfly exchange.

Leaves are ordered by range, numbered, and dealt to aligned blocks, each of which hashes its own
levels. From there on blocks swap subtree roots: in round r the blocks whose numbers differ in digit
r alone (in base ``fanout``) meet, and each works out the common ancestor for itself and keeps its
siblings. After the last round every block knows the root and the upper part of all its proofs;
nothing is handed down. Block numbers that do not exist take part without data, so that a meeting
always has ``fanout`` members and the ragged edge needs no rule of its own. The roots of the groups
are the leaves of one more tree, built the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import batches_of_texts, columns_of, over_batches, record, stored

#: Children of a node; levels that a block hashes by itself; rounds between two written tables.
FANOUT, LEVELS, ROUNDS = 2, 12, 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<place int, others array<string>>"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields one after the other: ``-`` for null, else UTF-8 length, colon, value."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def digest(parts: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def climb(leaves: list[bytes], fanout: int, steps: int | None) -> list[list[bytes]]:
    """All levels over the leaves, these first: so many steps, or until one node remains."""
    levels = [leaves]
    while len(levels[-1]) > 1 if steps is None else len(levels) <= steps:
        last = levels[-1]
        levels.append([digest(last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return levels


def siblings(levels: list[list[bytes]], at: int, fanout: int) -> Iterator[tuple[int, list[bytes]]]:
    """Place in its run and the other nodes of the run, level by level, for leaf ``at``."""
    for level in levels[:-1]:
        low = at - at % fanout
        run = level[low : low + fanout]
        yield at - low, run[: at - low] + run[at - low + 1 :]
        at //= fanout


def fold(node: bytes, steps: Sequence[tuple[int, list[bytes]]]) -> bytes:
    """The root that a node and its siblings lead to."""
    for place, others in steps:
        node = digest([*others[:place], node, *others[place:]])
    return node


def _numbered(nodes: DataFrame) -> DataFrame:
    """Rows of ``nodes`` (tree, at, node, claimed) with their position in the tree and its size.

    Rows are sorted by range and written once; every task numbers its own rows, and the counts of
    tasks and trees, a row for each pair, give the positions."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, length = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            code = batch.column(0).dictionary_encode()
            own = code.indices.to_numpy()
            start = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
            runs = np.diff(np.append(start, len(own)))
            place = np.arange(len(own)) - np.repeat(start, runs)
            first, final = batch.column(0)[0].as_py(), batch.column(0)[len(own) - 1].as_py()
            if first == last:
                place[: runs[0]] += length
            length, last = int(place[-1]) + 1, final
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(own), part, np.int32)), pa.array(place)], names=[*batch.schema.names, "part", "place"])

    order = ["tree", "at", "node"]
    ordered = stored(nodes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(count, columns_of(nodes) + ", part int, place bigint"), "ordered")
    sizes = ordered.groupBy("tree", "part").agg(F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col("tree").alias("_tree"), F.col("part").alias("_part"), F.coalesce(before, F.lit(0)).alias("start"), F.sum("n").over(tree).alias("size"))
    return ordered.join(starts, (F.col("tree") == F.col("_tree")) & (F.col("part") == F.col("_part"))).select(*order, "claimed", (F.col("start") + F.col("place")).alias("pos"), "size")


def _blocks(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row per aligned block: tree, block, blocks of the tree, its members in order, its node."""
    size = fanout**levels
    dealt = _numbered(nodes).select("tree", F.floor(F.col("pos") / size).alias("block"), F.ceil(F.col("size") / size).alias("blocks"), F.struct("pos", "at", "node", "claimed").alias("member"))
    grouped = dealt.groupBy("tree", "block", "blocks").agg(F.array_sort(F.collect_list("member")).alias("members"))

    def hash_up(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        node = [climb(leaves, fanout, None if blocks == 1 else levels)[-1][0].decode() for leaves, blocks in zip(_leaves(batch.column(3)), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node, pa.string())], names=[*batch.schema.names, "node"])

    return stored(grouped.mapInArrow(over_batches(hash_up), columns_of(grouped) + ", node string"), "blocks")


def _leaves(members: pa.Array, field: str = "node") -> Iterator[list[bytes]]:
    """The hex digests of each block's members."""
    data = [h and h.hex().encode() for h in members.flatten().field(field).to_pylist()]
    end = 0
    for n in members.value_lengths().to_pylist():
        end += n
        yield data[end - n : end]


def butterfly(heads: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Root and upper siblings of every block from ``heads`` (tree, block, blocks, node).

    Rounds double (by ``fanout``) what a block knows; a round is one shuffle of a row per block. Of
    the meeting's nodes each block keeps those that are not its own, with its place among them.
    """
    if (most := heads.agg(F.max("blocks")).first()[0]) is None:
        most = 0
    rounds = 0
    while fanout**rounds < most:
        rounds += 1
    powers = [fanout**r for r in range(rounds + 1)]
    full = F.coalesce(*[F.when(F.col("blocks") <= p, F.lit(p)) for p in powers]).cast("bigint")
    state = heads.select("tree", "block", "blocks", full.alias("full"), "node", F.lit(None).cast(f"array<{_STEP}>").alias("above"))
    state = state.withColumn("above", F.coalesce("above", F.array().cast(f"array<{_STEP}>")))
    edge = state.where((F.col("block") == 0) & (F.col("full") > F.col("blocks")))
    absent = edge.select("tree", F.explode(F.sequence("blocks", F.col("full") - 1)).alias("block"), "blocks", "full", F.lit(None).cast("string").alias("node"), "above")
    state = state.unionByName(absent)
    for r in range(rounds):
        digit = F.floor(F.col("block") / powers[r]) % fanout
        running = F.col("full") > powers[r]
        meeting = Window.partitionBy("tree", "meeting").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        met = state.withColumn("meeting", F.when(running, F.col("block") - digit * powers[r]).otherwise(F.col("block")))
        met = met.withColumn("nodes", F.collect_list(F.when(F.col("node").isNotNull(), F.struct("block", "node"))).over(meeting))
        others = F.transform(F.filter("nodes", lambda m: m["block"] != F.col("block")), lambda m: m["node"])
        place = F.size(F.filter("nodes", lambda m: m["block"] < F.col("block")))
        step = F.struct(place.alias("place"), others.alias("others")).cast(_STEP)
        ancestor = F.when(F.size("nodes") > 0, F.sha2(F.array_join(F.transform("nodes", lambda m: m["node"]), ""), 256))
        state = met.select(
            "tree", "block", "blocks", "full", F.when(running, ancestor).otherwise(F.col("node")).alias("node"), F.when(running, F.concat("above", F.array(step))).otherwise(F.col("above")).alias("above")
        )
        if r % ROUNDS == ROUNDS - 1:
            state = stored(state, "butterfly")
    return state.where(F.col("block") < F.col("blocks")).select("tree", "block", F.col("node").alias("root"), "above")


def _steps(row: list[dict]) -> list[tuple[int, list[bytes]]]:
    return [(s["place"], [h.encode() for h in s["others"]]) for s in row]


def manifest(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS, with_proofs: bool = False) -> DataFrame:
    """The trees over ``leaves`` (tree, at, node, claimed) and what a claimed leaf leads to.

    ``tree`` is text and never null, ``at`` orders a tree's leaves (nulls first, equal ones by node),
    ``node`` is the binary digest of a leaf and ``claimed`` one to be verified in its place (null: the
    leaf itself). Trees are ordered by ``tree`` and their roots are the leaves of the last tree.
    Returns a row per leaf: tree, at, leaf, subroot, root, proof_sha256 (all siblings joined and
    hashed), folded_root, verified; with ``with_proofs`` also ``proof``, the siblings level by level.
    An empty table has no rows. Equal rows are leaves of their own.
    """
    batches_of_texts(leaves.sparkSession)
    lower = _blocks(leaves, fanout, levels)
    heads = stored(butterfly(lower.select("tree", "block", "blocks", "node"), fanout), "heads")
    tops = heads.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("at"), F.unhex("root").alias("node"), F.lit(None).cast("binary").alias("claimed"))
    upper = _blocks(tops, fanout, levels)
    crowns = butterfly(upper.select("tree", "block", "blocks", "node"), fanout)

    def roots(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = batch.to_pydict()
        tree, root, proof = [], [], []
        for members, blocks, nodes, top, above in zip(rows["members"], rows["blocks"], _leaves(batch.column(0)), rows["root"], rows["above"]):
            levels_of = climb(nodes, fanout, None if blocks == 1 else levels)
            for i, member in enumerate(members):
                own = [{"place": p, "others": [h.decode() for h in o]} for p, o in siblings(levels_of, i, fanout)]
                tree.append(member["at"])
                root.append(top)
                proof.append(own + above)
        kind = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))]))
        yield record(tree=pa.array(tree, pa.string()), root=pa.array(root, pa.string()), proof=pa.array(proof, kind))

    crowned = upper.join(crowns.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "root", "above"), (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_block")))
    top = stored(crowned.select("members", "blocks", "root", "above").mapInArrow(over_batches(roots), f"tree string, root string, proof array<{_STEP}>"), "crowns")
    suffix = heads.select("tree", F.col("block").alias("_block"), F.col("root").alias("subroot"), "above").join(top.withColumnRenamed("tree", "_tree"), F.col("tree") == F.col("_tree"))
    suffix = suffix.select("_tree", "_block", "subroot", "root", F.concat("above", "proof").alias("above"))
    whole = lower.join(suffix, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_block"))).select("tree", "members", "blocks", "subroot", "root", "above")
    at_type = leaves.select("at").schema[0].dataType.simpleString()

    def verify(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tree, blocks, subroot, root, above = (batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5))
        claims = _leaves(batch.column(1), "claimed")
        at = batch.column(1).flatten().field("at")
        lo = 0
        for b, (nodes, claimed) in enumerate(zip(_leaves(batch.column(1)), claims)):
            levels_of, upper_steps, top = climb(nodes, fanout, None if blocks[b] == 1 else levels), _steps(above[b]), root[b].encode()
            steps = [[*siblings(levels_of, i, fanout), *upper_steps] for i in range(len(nodes))]
            folded = [fold(c or n, s) for n, c, s in zip(nodes, claimed, steps)]
            texts = lambda values: pa.array([v.decode() for v in values], pa.string())
            columns = {
                "tree": pa.array([tree[b]] * len(nodes), pa.string()), "at": at.slice(lo, len(nodes)), "leaf": texts(nodes),
                "subroot": pa.array([subroot[b]] * len(nodes), pa.string()), "root": pa.array([root[b]] * len(nodes), pa.string()),
                "proof_sha256": texts([digest([h for _, others in s for h in others]) for s in steps]),
                "folded_root": texts(folded), "verified": pa.array([f == top for f in folded], pa.bool_()),
            }
            if with_proofs:
                columns["proof"] = pa.array([[[h.decode() for h in others] for _, others in s] for s in steps], pa.list_(pa.list_(pa.string())))
            lo += len(nodes)
            yield record(**columns)

    shape = f"tree string, at {at_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return whole.mapInArrow(over_batches(verify), shape + (", proof array<array<string>>" if with_proofs else ""))


def document_leaves(docs: DataFrame, altered: Column | None = None, amount_col: str = "n_chars", group_col: str = "lang", id_col: str = "doc_id", fields: Sequence[str] = FIELDS) -> DataFrame:
    """A leaf per row of ``docs``, one tree per value of ``group_col`` (null first), ordered by ``id_col``.

    Where ``altered`` holds, the claimed leaf has 1 added to ``amount_col`` (nulls stay). Columns other
    than the named ones are not read; integers of any size are exact.
    """
    of = {name: docs[f"`{name}`"] for name in {*fields, group_col, id_col, amount_col}}
    leaf = F.unhex(leaf_digest([of[f] for f in fields]))
    changed = F.unhex(leaf_digest([(of[f].cast("decimal(38,0)") + F.lit(1)).cast("decimal(38,0)") if f == amount_col else of[f] for f in fields]))
    claimed = F.lit(None).cast("binary") if altered is None else F.when(altered, changed)
    tree = F.coalesce(F.concat(F.lit("="), of[group_col].cast("string")), F.lit(""))
    return stored(docs.select(tree.alias("tree"), of[id_col].alias("at"), leaf.alias("node"), claimed.alias("claimed")), "leaves")
