"""Removal of long repeated byte strings with run-length compressed indexes.

Every string of ``LENGTH`` bytes that starts at two places or more is repeated.

1. Sampling. Of the ``GRAM``-byte grams in a window of ``LENGTH`` bytes the one with the smallest hash
   is the window's anchor, so equal windows have equal anchors. Consecutive windows with one anchor
   form a segment. A row per segment tells which anchors recur.
2. If all segments of an anchor, two or more, are equal, all their windows repeat, and so nothing
   needs to be compared: copies add no runs to a transform. Otherwise its different segments, each once and with its number of copies, go to the
   index shard of the anchor, where all places that can match meet.
3. A shard's index is the run-length compressed Burrows-Wheeler transform of its segments, with
   suffix positions sampled at both ends of every run. Matches of neighbours in suffix order are
   compared only there; streamed along the text, every other position's matching length is one less
   than the one before. Long enough lengths mark repeated windows.
4. Anchors with more than ``CROWD`` segments would make a shard too large. Their different segments are cut into
   blocks of at most ``BLOCK`` windows by the place of the anchor, so that equal windows are in blocks
   with equal cores (the bytes that all windows of such a block share). Blocks with a core of their own
   hold no repeated window; if all blocks of a core are equal, all their windows repeat. Only the
   windows of the different blocks of a core, each block once and with its number of copies, are
   compared by 128 bits of hash, in an aggregate with partial sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import NO_ID, batches_of_texts, join_counted, over_batches, pick, record, stored
from rowferry.llm.kernels import U, chunks, list_column, mix, sliding_min, span_hashes

LENGTH = 400
GRAM = 32
#: Bytes of segments in an index shard, about; segments of one anchor that are indexed.
SHARD_BYTES = 1 << 21
CROWD = 6000
#: Windows in a block of a crowded anchor; about the root of half the windows of a segment, where rows
#: for blocks and rows for windows at the two ends of a passage come to the least.
BLOCK = 16
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_COPIES, _INDEX, _HASH = 0, 1, 2


class Bytes:
    """Some texts as one buffer; ``first`` holds where each begins, a byte apart."""

    def __init__(self, texts: list):
        self.parts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t or b"" for t in texts]
        self.data = np.frombuffer(b"\0".join([*self.parts, b"\0" * 16]), np.uint8)
        self.size = np.fromiter(map(len, self.parts), np.int64, len(self.parts))
        self.first = np.cumsum(self.size + 1) - self.size - 1


def _anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every gram, and the anchor of every window of ``length`` bytes, windows across
    texts included."""
    eight = np.ndarray((len(data) - 7,), U, data, 0, (1,))
    h = mix(eight * U(0x9E3779B97F4A7C15))
    size = 8
    while size < GRAM:
        h = mix(h[: len(h) - size] * U(0xBF58476D1CE4E5B9) + h[size:])
        size *= 2
    return h, sliding_min(h, length - GRAM + 1)


def _segments(texts: Bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, text number, first window and number of windows of every segment, whether the anchor
    stands in it twice or more (only then can two of its own windows be equal), and all gram hashes.

    A segment has at most ``length`` windows, so its bytes are not more than twice the length.
    """
    h, low = _anchors(texts.data, length)
    change = np.ones(len(low), bool)
    change[1:] = low[1:] != low[:-1]
    windows = np.maximum(texts.size - length + 1, 0)
    own = windows > 0
    change[texts.first[own]] = True
    start = np.flatnonzero(change)
    text = np.searchsorted(texts.first, start, "right") - 1
    end = np.concatenate((start[1:], [len(low)]))
    end = np.minimum(end, texts.first[text] + windows[text]) if len(text) else end
    ok = end > start
    start, end, text = start[ok], end[ok], text[ok]
    pieces = -(-(end - start) // length)
    part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start, end, text = np.repeat(start, pieces) + part * length, np.repeat(end, pieces), np.repeat(text, pieces)
    n = np.minimum(end - start, length)
    # places of anchors: a gram that is the smallest of the window it begins or ends
    reach = length - GRAM
    smallest = h[: len(low)] == low
    place = np.union1d(np.flatnonzero(smallest), np.flatnonzero(h[reach : reach + len(low)] == low) + reach)
    values, number = np.unique(h[place], return_inverse=True)
    scale = len(h) + 1
    key = np.sort(number * scale + place)
    own = np.searchsorted(values, low[start]) * scale
    return low[start], text, start, n, np.searchsorted(key, own + start + n + reach) - np.searchsorted(key, own + start) > 1, h


def _blocks(texts: Bytes, grams: np.ndarray, anchor: np.ndarray, start: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of some segments in blocks: the windows' places; per block its segment, its number
    of windows, the place of its first window, and its core.

    The windows of a block have one and the same first anchor, and its distance from where they start
    is the same but for less than ``BLOCK``. The core's hash covers that distance too.
    """
    segment = np.repeat(np.arange(len(n)), n)
    spots = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
    values, number = np.unique(anchor, return_inverse=True)
    place, scale = np.flatnonzero(np.isin(grams, values)), len(grams) + 1
    key = np.sort(np.searchsorted(values, grams[place]) * scale + place)
    own = number[segment] * scale
    at = key[np.searchsorted(key, own + spots)] - own  # the first anchor in the window
    step = (at - spots) // BLOCK
    new = np.ones(len(spots), bool)
    new[1:] = (at[1:] != at[:-1]) | (step[1:] != step[:-1]) | (segment[1:] != segment[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.concatenate((first, [len(spots)])))
    step = step[first]
    core = span_hashes(texts.data, at[first] - step * BLOCK, np.full(len(first), length - BLOCK + 1), 3)
    return spots, segment[first], size, spots[first], mix(core + step.astype(U))


def _common(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes from a and from b on are equal, at most ``most``."""
    eight = np.ndarray((len(data) - 7,), np.uint64, data, 0, (1,))
    out, rows, done = most.copy(), np.arange(len(a)), 0
    while len(rows):
        rows = rows[most[rows] > done]
        x = eight[a[rows] + done] ^ eight[b[rows] + done]
        low = x & (~x + U(1))  # the lowest bit that differs
        byte = np.where(x == 0, 8, np.log2(np.maximum(low, U(1)).astype(np.float64)).astype(np.int64) // 8)
        out[rows] = np.minimum(most[rows], done + byte)
        rows = rows[x == 0]
        done += 8
    return out


class RunLengthIndex:
    """Run-length compressed Burrows-Wheeler transform of some byte strings.

    Each string ends with a terminator of its own, smaller than all bytes. Kept are the runs and the
    suffix positions at their ends.
    """

    def __init__(self, strings: list[bytes]):
        joined = b"\0".join([*strings, b"\0" * 16])
        self.data = np.frombuffer(joined, np.uint8)
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        self.first = np.cumsum(size + 1) - size - 1
        self.n = int((size + 1).sum())
        self.end = np.repeat(self.first + size, size + 1)
        self.sa = self._sorted(len(strings))
        before = np.concatenate(([0], self.data[: self.n - 1].astype(np.int16) + 1))
        before[self.first] = 0
        bwt = before[self.sa]
        head = np.ones(self.n, bool)
        head[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] == 0)
        rows = np.flatnonzero(head)
        self.runs = len(rows)
        self.symbol = bwt[rows]
        self.head = self.sa[rows]
        self.tail = self.sa[np.concatenate((rows[1:], [self.n])) - 1]

    def _sorted(self, n_strings: int) -> np.ndarray:
        n, here = self.n, np.arange(self.n)
        left = self.end - here  # bytes before the terminator
        # seven bytes, those past the terminator zero, and how many there are: a terminator comes before a zero byte
        count = np.minimum(left, 7)
        past = ((7 - count) * 8).astype(U)
        key = np.ndarray((n,), ">u8", self.data, 0, (1,)).astype(U) >> U(8) >> past << past << U(3) | count.astype(U)
        key = key.view(np.int64)
        sa = np.argsort(key, kind="stable")  # equal keys with terminators stay in the order of strings
        ordered = key[sa]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1])) | (left[sa] < 7)
        del key, ordered, count, past, left
        rank = np.empty(n, np.int64)
        rank[sa] = np.maximum.accumulate(np.where(new, here, 0))
        todo = np.flatnonzero(~(new & np.concatenate((new[1:], [True]))))
        size = 7
        while len(todo):
            own = sa[todo]
            group, after = rank[own], rank[own + size]
            order = np.argsort(group * (n + 1) + after)
            own, group, after = own[order], group[order], after[order]
            sa[todo] = own
            new = np.concatenate(([True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])))
            rank[own] = todo[np.maximum.accumulate(np.where(new, np.arange(len(todo)), 0))]
            todo = todo[~(new & np.concatenate((new[1:], [True])))]
            size *= 2
        return sa

    def matching(self) -> np.ndarray:
        """For every position the length of its longest match at any other position.

        Neighbours in suffix order are compared at the run ends alone. Inside a run both neighbours
        are preceded by the same byte, so the length is that of the position before, less one.
        """
        a, b = self.tail[:-1], self.head[1:]
        common = _common(self.data, a, b, np.minimum(self.end[a] - a, self.end[b] - b))
        out = np.zeros(self.n, np.int64)
        here = np.arange(self.n)
        for place, value in ((self.head, np.concatenate(([0], common))), (self.tail, np.concatenate((common, [0])))):
            known = np.full(self.n, -1, np.int64)
            known[place] = value
            last = np.maximum.accumulate(np.where(known >= 0, here, 0))
            np.maximum(out, known[last] - (here - last), out=out)
        return out


def repeated_windows(strings: list[bytes], copies: np.ndarray, length: int) -> list[np.ndarray]:
    """For every string the runs of windows (first, last; exclusive) that another place has as well."""
    index = RunLengthIndex(strings)
    long = index.matching() >= length
    out = []
    for first, text, n in zip(index.first.tolist(), strings, copies.tolist()):
        windows = len(text) - length + 1
        own = np.ones(windows, np.int8) if n > 1 else long[first : first + windows].view(np.int8)
        out.append(np.flatnonzero(np.diff(np.concatenate(([0], own, [0])))).astype(np.int32))
    return out


def remove_long_matches(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every document without the bytes that a repeated string of ``length`` bytes covers.

    Returns one row per row of ``docs``: doc_id, n_bytes, n_removed, spans (removed byte ranges,
    array<struct<first, last>>, last exclusive) and kept (binary, the other bytes). Texts are read as
    UTF-8; null texts are empty. Repeated rows are places of their own, so equal rows repeat each
    other, also with equal or null ids. Columns other than the two named ones are not read.
    """
    batches_of_texts(docs.sparkSession)
    id_type = docs.select(docs[f"`{id_col}`"]).schema[0].dataType.simpleString()
    keyed = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("key"), F.unhex(F.md5("text")).alias("same"), "text")

    def sample(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, same, rows = batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_pylist()
        for lo, hi in chunks(rows, 1 << 18):
            texts = Bytes(rows[lo:hi])
            anchor, text, start, n, twice, _ = _segments(texts, length)
            content = span_hashes(texts.data, start, n + length - 1)
            yield record(anchor=anchor.view(np.int64), content=content.view(np.int64), twice=twice, key=keys[lo:hi][text], same=same.slice(lo, hi - lo).take(pa.array(text)))

    found = stored(keyed.select("key", "same", "text").mapInArrow(over_batches(sample), "anchor bigint, content bigint, twice boolean, key bigint, same binary"), "segments")
    groups = found.groupBy("anchor").agg(F.count("*").alias("n"), (F.min("content") != F.max("content")).alias("mixed"), F.max("twice").alias("twice")).where("n > 1 or twice")
    way = F.when((F.col("n") > 1) & ~F.col("mixed"), _COPIES).when(F.col("n") <= crowd, _INDEX).otherwise(_HASH)
    recurring = stored(groups.select(F.col("anchor").alias("_anchor"), "n", way.alias("way")), "recurring")
    indexed = recurring.where(F.col("way") == _INDEX).agg(F.sum("n")).first()[0] or 0
    shards = max(1, int(indexed * 1.5 * length) // shard_bytes)
    wanted = found.select("anchor", "key", "same").join(recurring.select("_anchor", "way"), F.col("anchor") == F.col("_anchor"))
    lists = wanted.groupBy("key", "same").agg(F.collect_set(F.struct("anchor", "way")).alias("anchors"))
    lists = lists.select(F.col("key").alias("_key"), F.col("same").alias("_same"), F.transform("anchors", lambda p: p["anchor"]).alias("anchors"), F.transform("anchors", lambda p: p["way"]).alias("ways"))
    marked = keyed.join(lists, (F.col("key") == F.col("_key")) & (F.col("same") == F.col("_same")), "left").select("doc_id", "key", "same", "text", "anchors", "ways")

    def locate(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        listed = pc.is_valid(batch.column(4))
        plain = batch.filter(pc.invert(listed))
        if plain.num_rows:
            parts = [(t or "").encode("utf-8", "surrogatepass") for t in plain.column(3).to_pylist()]
            n = len(parts)
            yield record(
                doc_id=plain.column(0), key=plain.column(1), same=plain.column(2), n_bytes=np.fromiter(map(len, parts), np.int64, n), n_removed=np.zeros(n, np.int64), spans=pa.array([[]] * n, _SPANS),
                kept=pa.array(parts, pa.binary()), late=pa.nulls(n, pa.binary()), **{c: list_column([], np.zeros(n, np.int64), t) for c, t in _LISTS},
            )
        batch = batch.filter(listed)
        rows, anchors, ways = (batch.column(i).to_pylist() for i in (3, 4, 5))
        for lo, hi in chunks(rows, 1 << 18):
            texts = Bytes(rows[lo:hi])
            anchor, text, start, n, _, grams = _segments(texts, length)
            known = np.concatenate([np.array(a, np.int64) for a in anchors[lo:hi]])
            kind = np.concatenate([np.array(a, np.int8) for a in ways[lo:hi]])
            known, at = np.unique(known, return_index=True)
            spot = np.minimum(np.searchsorted(known, anchor.view(np.int64)), len(known) - 1)
            way = np.where(known[spot] == anchor.view(np.int64), kind[at][spot], -1)
            copy = np.flatnonzero(way == _COPIES)
            removed = _cover(len(texts.data), start[copy], start[copy] + n[copy], length)
            seg = np.flatnonzero((way == _INDEX) | (way == _HASH))
            content = span_hashes(texts.data, start[seg], n[seg] + length - 1)
            late = np.zeros(hi - lo, bool)
            late[text[seg]] = True
            n_removed, spans, kept = _result(texts, removed)
            per_seg = np.bincount(text[seg], minlength=hi - lo)
            raw = texts.data.tobytes()
            yield record(
                doc_id=batch.column(0).slice(lo, hi - lo), key=batch.column(1).slice(lo, hi - lo), same=batch.column(2).slice(lo, hi - lo), n_bytes=texts.size, n_removed=n_removed, spans=spans,
                kept=pa.array([None if x else k for x, k in zip(late, kept)], pa.binary()), late=pa.array([p if x else None for x, p in zip(late, texts.parts)], pa.binary()),
                anchor=list_column(anchor[seg].view(np.int64), per_seg), content=list_column(content.view(np.int64), per_seg), start=list_column(start[seg] - texts.first[text[seg]], per_seg),
                segment=list_column([raw[s : s + k] for s, k in zip(start[seg].tolist(), (n[seg] + length - 1).tolist())], per_seg, pa.binary()),
                crowded=list_column(way[seg] == _HASH, per_seg, pa.bool_()),
            )

    spans = "spans array<struct<first:bigint,last:bigint>>"
    located = stored(
        marked.mapInArrow(
            over_batches(locate),
            f"doc_id {id_type}, key bigint, same binary, n_bytes bigint, n_removed bigint, {spans}, kept binary, late binary, anchor array<bigint>, content array<bigint>, start array<bigint>, segment array<binary>, crowded array<boolean>",
        ),
        "located",
    )
    late = located.where(F.col("late").isNotNull())
    places = late.select("key", "same", F.explode(F.arrays_zip("anchor", "content", "start")).alias("s")).select("key", "same", "s.*")
    distinct = late.select(F.explode(F.arrays_zip("anchor", "content", "segment", "crowded")).alias("s")).groupBy("s.anchor", "s.content", "s.segment", "s.crowded").agg(F.count("*").alias("copies"))
    distinct = stored(distinct, "distinct")
    dealt = distinct.where(~F.col("crowded")).select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "content", "segment", "copies")

    def index(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["anchor", "content"], kind="stable")
        pdf["windows"] = repeated_windows(list(map(bytes, pdf["segment"])), pdf["copies"].to_numpy(), length)
        return pdf.loc[pdf["windows"].map(len) > 0, ["anchor", "content", "windows"]]

    repeats = dealt.groupBy("shard").applyInPandas(index, "anchor bigint, content bigint, windows array<int>")
    repeats = repeats.unionByName(_crowded(distinct.where("crowded"), length)).select(F.col("anchor").alias("_anchor"), F.col("content").alias("_content"), "windows")
    found_in = places.join(repeats, (F.col("anchor") == F.col("_anchor")) & (F.col("content") == F.col("_content"))).select("key", "same", F.transform("windows", lambda w: w + F.col("start")).alias("windows"))
    per_doc = found_in.groupBy("key", "same").agg(F.flatten(F.collect_set("windows")).alias("windows")).withColumnsRenamed({"key": "_key", "same": "_same"})
    final = late.select("doc_id", "key", "same", "late", "spans").join(per_doc, (F.col("key") == F.col("_key")) & (F.col("same") == F.col("_same")), "left")

    def finish(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, done, windows = (batch.column(i).to_pylist() for i in (1, 2, 3))
        for lo, hi in chunks(rows):
            texts = Bytes(rows[lo:hi])
            removed = np.zeros(len(texts.data), bool)
            for i in range(lo, hi):
                base = int(texts.first[i - lo])
                for span in done[i] or ():
                    removed[base + span["first"] : base + span["last"]] = True
                if windows[i]:
                    runs = np.array(windows[i], np.int64).reshape(-1, 2)
                    size = int(texts.size[i - lo])
                    removed[base : base + size] |= _cover(size, runs[:, 0], runs[:, 1], length)
            n_removed, spans_of, kept = _result(texts, removed)
            yield record(doc_id=batch.column(0).slice(lo, hi - lo), n_bytes=texts.size, n_removed=n_removed, spans=spans_of, kept=pa.array(kept, pa.binary()))

    ready = located.where(F.col("late").isNull()).select("doc_id", "n_bytes", "n_removed", "spans", "kept")
    rest = final.select("doc_id", "late", "spans", "windows").mapInArrow(over_batches(finish), f"doc_id {id_type}, n_bytes bigint, n_removed bigint, {spans}, kept binary")
    return ready.unionByName(rest)


def _crowded(segments: DataFrame, length: int) -> DataFrame:
    """Repeated windows (anchor, content, windows) of the different segments of crowded anchors.

    Equal blocks become one row with their number before anything else. A core that a third of all
    blocks share has as many rows as it has different blocks, and these are dealt by the whole block
    or its windows, never by the core alone.
    """

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = batch.column(2).to_pylist()
        for lo, hi in chunks(rows, 1 << 18):
            texts = Bytes(rows[lo:hi])
            grams, _ = _anchors(texts.data, length)
            spots, block, size, begin, core = _blocks(texts, grams, batch.column(0).slice(lo, hi - lo).to_numpy().view(U), texts.first, texts.size - length + 1, length)
            of = lambda i: batch.column(i).slice(lo, hi - lo).take(pa.array(block))  # noqa: B023, E731
            ends = [span_hashes(texts.data, begin, size + length - 1, seed).view(np.int64) for seed in (1, 2)]
            hashes = [list_column(span_hashes(texts.data, spots, np.full(len(spots), length), seed).view(np.int64), size) for seed in (1, 2)]
            yield record(anchor=of(0), content=of(1), copies=of(3), core=core.view(np.int64), union1=ends[0], union2=ends[1], begin=(begin - texts.first[block]).astype(np.int32), hash1=hashes[0], hash2=hashes[1])

    union = ("core", "union1", "union2")
    shape = "anchor bigint, content bigint, copies bigint, core bigint, union1 bigint, union2 bigint, begin int, hash1 array<bigint>, hash2 array<bigint>"
    blocks = stored(segments.select("anchor", "content", "segment", "copies").mapInArrow(over_batches(cut), shape), "blocks")
    different = stored(blocks.groupBy(*union).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"), F.first("hash1").alias("hash1"), F.first("hash2").alias("hash2")), "different")
    cores = different.groupBy("core").agg(F.count("*").alias("blocks"), F.sum("copies").alias("places")).where("places > 1")
    known = stored(join_counted(different, cores, ("core",), "blocks", different.count()), "cores")
    windows = known.where("blocks > 1").select(*union, "copies", "rows", F.posexplode(F.arrays_zip("hash1", "hash2")).alias("nth", "w")).select(*union, "copies", "rows", "nth", "w.*")
    windows = stored(windows, "windows")
    often = windows.groupBy("hash1", "hash2").agg(F.sum("copies").alias("n"), F.count("*").alias("times")).where("n > 1").drop("n")
    again = join_counted(windows, often, ("hash1", "hash2"), "times", windows.count()).groupBy(*union, "rows").agg(F.collect_list("nth").alias("nths"))
    whole = known.where("blocks = 1").select(*union, "rows", F.sequence(F.lit(0), F.size("hash1") - 1).alias("nths"))
    places = blocks.select("anchor", "content", *union, "begin")
    found = join_counted(places, again.unionByName(whole), union, "rows", blocks.count())
    found = found.select("anchor", "content", F.flatten(F.transform("nths", lambda i: F.array(F.col("begin") + i, F.col("begin") + i + 1))).alias("windows"))
    return found.groupBy("anchor", "content").agg(F.flatten(F.collect_list("windows")).alias("windows"))


_LISTS = (("anchor", pa.int64()), ("content", pa.int64()), ("start", pa.int64()), ("segment", pa.binary()), ("crowded", pa.bool_()))


def _cover(size: int, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Which of ``size`` bytes lie in a window that starts in one of the ranges."""
    delta = np.zeros(size + 1, np.int32)
    np.add.at(delta, first, 1)
    np.add.at(delta, last + length - 1, -1)
    return np.cumsum(delta[:size]) > 0


def _result(texts: Bytes, removed: np.ndarray):
    total = np.concatenate(([0], np.cumsum(removed)))
    n_removed = total[texts.first + texts.size] - total[texts.first]
    spans, kept = [], []
    for first, size, n, part in zip(texts.first.tolist(), texts.size.tolist(), n_removed.tolist(), texts.parts):
        if not n:
            spans.append([])
            kept.append(part)
            continue
        own = removed[first : first + size]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0])))).tolist()
        spans.append([{"first": s, "last": e} for s, e in zip(edge[::2], edge[1::2])])
        kept.append(b"".join([part[a:b] for a, b in zip([0, *edge[1::2]], [*edge[::2], size])]))
    return n_removed, pa.array(spans, _SPANS), kept
