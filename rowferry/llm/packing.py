"""Best-fit packing of tokenised documents into sequences by large-item matching.

Only lengths decide where a piece goes, and there are at most ``capacity`` of them. So the plan is
made on the histogram of lengths: one entry stands for all pieces of a length, and a plan row for
all sequences that are filled alike. Its size depends on the capacity, not on the documents.

Plan: lengths above a third of the capacity are large, at most two of them share a sequence. From
the longest on, each takes the longest large partner that still fits. Smaller lengths, longest
first, go where the gap they leave is smallest; new sequences open only when no gap is left.

Pieces then take their places: the n-th piece of a length takes the n-th place planned for it. The
n-th is counted inside each partition and shifted by the counts of the partitions before, so a
length that a third of all documents have is still counted in parallel.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import batches_of_texts, pick, record, stored
from rowferry.llm.kernels import U, chunks, span_hashes

CAPACITY = 2048
#: Id that ends every document.
END = 0

# Classes of bytes for cutting text where the tokenizer cuts it anyway.
_SPACE, _LETTER, _DIGIT, _SIGN, _GLUE = range(5)


def _classes() -> np.ndarray:
    out = np.full(256, _GLUE, np.uint8)  # not ASCII, control characters, apostrophe: never cut there
    out[33:127] = _SIGN
    out[48:58] = _DIGIT
    out[97:123] = out[65:91] = _LETTER
    out[39] = _GLUE
    out[[32, *range(9, 14)]] = _SPACE
    return out


_CLASS = _classes()
#: Words of ASCII and two-byte Latin letters need no normal form, only lower case.
_PLAIN_WORD = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# The vocabulary writes a byte as the character of its number, and those that do not print from 256 on.
_HIDDEN = [*range(33), *range(127, 161), 173]
_AS_CHARACTERS = {b: 256 + i for i, b in enumerate(_HIDDEN)}
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Encoder:
    """Ids of whole texts, worked out once per distinct piece of text.

    The vocabulary splits text at white space, between letters, digits and signs, and after each
    digit, and ids depend on nothing across such a cut. Texts are cut there by array operations (never
    beside an apostrophe or an unclear character); each distinct piece is encoded by the library
    and remembered in a hash table of fixed size, which starts anew when it is full.
    """

    SLOTS = 1 << 22

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.full.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(self.SLOTS, U)
        self.slots = np.full(self.SLOTS, -1, np.int32)
        self.ids = np.empty(1 << 20, np.uint32)
        self.used = 1
        self.ids[0] = END
        self.place, self.count = np.zeros(self.SLOTS // 2, np.int64), np.zeros(self.SLOTS // 2, np.int32)
        self.count[0] = 1
        self.n = 1  # entry 0 is the end of a document

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of ids of each."""
        special = [i for i, t in enumerate(texts) if b"<|" in t and any(s in t for s in self.special)]
        if special:
            return self._with_special(texts, set(special))
        data = b" ".join(texts).translate(_LOWER) + b" " * 9
        start, length = _pieces(np.frombuffer(data, np.uint8))
        entry = self._entries(data, start, length)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.searchsorted(start, np.cumsum(sizes + 1))
        entry = np.insert(entry, ends, 0)
        count = self.count[entry].astype(np.int64)
        total = np.cumsum(count)
        at = np.arange(total[-1]) + np.repeat(self.place[entry] - total + count, count)
        last = total[ends + np.arange(len(ends))]
        return self.ids[at], np.diff(np.concatenate(([0], last)))

    def _with_special(self, texts: list[bytes], special: set[int]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for i, text in enumerate(texts):
            if i in special:
                own = np.array([*self.full.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, END], np.uint32)
            else:
                own = self.encode([text])[0]
            ids.append(own)
            sizes.append(len(own))
        return np.concatenate(ids), np.array(sizes)

    def _entries(self, data: bytes, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        h = span_hashes(np.frombuffer(data, np.uint8), start, length) | U(1)
        entry = self._find(h)
        new = np.flatnonzero(entry < 0)
        if len(new):
            fresh, first = np.unique(h[new], return_index=True)
            if self.n + len(fresh) > self.SLOTS // 2:
                self._clear()
                fresh, first = np.unique(h, return_index=True)
                new = np.arange(len(h))
                if len(fresh) >= self.SLOTS // 2:
                    raise ValueError(f"a batch has more than {self.SLOTS // 2} distinct pieces")
            s, n = start[new[first]].tolist(), length[new[first]].tolist()
            self._add(fresh, [data[a : a + b] for a, b in zip(s, n)])
            entry[new] = self._find(h[new])
        return entry

    def _find(self, h: np.ndarray) -> np.ndarray:
        mask = U(self.SLOTS - 1)
        at = (h >> U(20)) & mask
        entry = self.slots[at]
        rows = np.flatnonzero((self.keys[at] != h) & (entry >= 0))
        while len(rows):
            at[rows] = (at[rows] + U(1)) & mask
            entry[rows] = self.slots[at[rows]]
            rows = rows[(self.keys[at[rows]] != h[rows]) & (entry[rows] >= 0)]
        return entry

    def _add(self, keys: np.ndarray, words: list[bytes]) -> None:
        model, plain = self.full.model.tokenize, _PLAIN_WORD.fullmatch
        ids: list[int] = []
        ends = []
        for word in words:
            if plain(word):
                text = word.decode()
                if not text.isascii():
                    text = text.lower().encode().decode("latin-1").translate(_AS_CHARACTERS)
                ids += [t.id for t in model(text)]
            else:
                ids += self.full.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
            ends.append(len(ids))
        entries = np.arange(self.n, self.n + len(keys))
        ends = np.array(ends)
        self.count[entries] = np.diff(ends, prepend=0)
        self.place[entries] = self.used + ends - self.count[entries]
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.n += len(keys)
        mask = U(self.SLOTS - 1)
        at = (keys >> U(20)) & mask
        while len(keys):
            free = np.flatnonzero(self.slots[at] < 0)
            own, first = np.unique(at[free], return_index=True)
            self.slots[own], self.keys[own] = entries[free[first]], keys[free[first]]
            rest = np.ones(len(keys), bool)
            rest[free[first]] = False
            keys, entries, at = keys[rest], entries[rest], (at[rest] + U(1)) & mask


def _pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # Latin letters of two bytes, but for the two signs among them
    tail = data[lead + 1]
    lead = lead[(tail != 0x97) & (tail != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    before, here = kind[:-1], kind[1:]
    cut = (here != _SPACE) & ((before == _SPACE) | ((before < _GLUE) & (here < _GLUE) & ((before != here) | (here == _DIGIT))))
    cut = np.concatenate(([kind[0] != _SPACE], cut))
    start = np.flatnonzero(cut)
    # a piece ends at the next piece or at white space, whichever comes first
    ends = np.flatnonzero(np.concatenate(((kind[1:] == _SPACE) & (kind[:-1] != _SPACE), [False])) | np.concatenate((cut[1:], [False]) ) & np.concatenate((kind[:-1] != _SPACE, [False]))) + 1
    return start, ends[: len(start)] - start


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Cuts every document's ids (its own and the end) into pieces of at most ``capacity``.

    Columns: doc_id, piece, start, length, ids_crc32, with ``with_ids`` also ids, and part and
    place, by which the pieces of a length are counted. A null text counts as empty.
    """
    batches_of_texts(docs.sparkSession)
    extra = ", ids array<bigint>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, to_ids = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), encoder(tokenizer)
        for batch in batches:
            ids_of, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in chunks(texts, 4 << 20):
                ids, sizes = to_ids.encode([(t or "").encode("utf-8", "surrogatepass") for t in texts[lo:hi]])
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(lo, hi), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                length = np.minimum(capacity, np.repeat(sizes, pieces) - piece * capacity)
                first = np.repeat(np.cumsum(sizes) - sizes, pieces) + piece * capacity
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                sorted_length = length[order]
                run_start = np.searchsorted(sorted_length, sorted_length)
                place = np.empty(len(row), np.int64)
                place[order] = np.arange(len(row)) - run_start + seen[sorted_length]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = {"doc_id": ids_of.take(pa.array(row)), "piece": piece.astype(np.int32), "start": piece * capacity, "length": length, "ids_crc32": np.array(crc, np.int64), "part": np.full(len(row), part, np.int32), "place": place}
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate((first, [len(ids)])).astype(np.int32)), pa.array(ids.astype(np.int64)))
                yield record(**columns)

    chosen = pick(docs, doc_id=id_col, text=text_col)
    return chosen.mapInArrow(run, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint{extra}")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences to fill, from the number of pieces of each length.

    Returns (number of sequences, [(length, copies in each), ..]) rows.
    """
    left = {n: c for n, c in histogram.items() if c}
    large = sorted(n for n in left if 3 * n > capacity)
    groups: list[tuple[int, list[tuple[int, int]]]] = []
    while large:
        a = large[-1]
        at = bisect_left(large, capacity - a + 1) - 1  # the longest that fits beside it
        b = large[at] if at >= 0 else None
        if b is None or (b == a and left[a] == 1):
            if b == a and at > 0:
                b = large[at - 1]
            else:
                groups.append((left.pop(a), [(a, 1)]))
                large.pop()
                continue
        if b == a:
            groups.append((left[a] // 2, [(a, 2)]))
            left[a] %= 2
        else:
            n = min(left[a], left[b])
            groups.append((n, [(a, 1), (b, 1)]))
            left[a] -= n
            left[b] -= n
        for n in {a, b}:
            if not left[n]:
                del left[n]
                large.remove(n)
    by_gap: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    gaps: list[int] = []

    def put(gap: int, group: tuple[int, list[tuple[int, int]]]) -> None:
        if gap not in by_gap:
            by_gap[gap] = []
            insort(gaps, gap)
        by_gap[gap].append(group)

    for count, parts in groups:
        put(capacity - sum(n * k for n, k in parts), (count, parts))
    for size in sorted(left, reverse=True):
        todo = left[size]
        while todo:
            at = bisect_left(gaps, size)
            if at == len(gaps):
                gap, count, parts = capacity, todo, []
            else:
                gap = gaps[at]
                count, parts = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap]
                    gaps.pop(at)
            each = min(gap // size, todo)
            full = min(count, todo // each)
            put(gap - each * size, (full, [*parts, (size, each)]))
            todo -= full * each
            if parts and count > full:
                put(gap, (count - full, parts))
    return [group for gap in gaps for group in by_gap[gap]]


def _places(groups: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Plan rows by length and by the first count they take: base sequence, copies, offset."""
    rows, taken, base = [], {}, 0
    for count, parts in groups:
        offset = 0
        for length, copies in parts:
            first = taken.get(length, 0)
            rows.append((length, first, base, copies, offset))
            taken[length] = first + count * copies
            offset += length * copies
        base += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "base", "copies", "offset"), table.T))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Packs whole documents into sequences of at most ``capacity`` ids.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.
    Every row of ``docs`` is packed, also repeated ids and rows with null id; null text is empty
    and becomes the end id alone. Only documents longer than the capacity are cut. An empty table
    gives no rows. Columns other than the two named ones are not read.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, id_col, text_col, with_ids), "pieces")
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(F.col("part").alias("_part"), F.col("length").alias("_length"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_shift"))
    ranked = pieces.join(shift, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length"))).drop("_part", "_length")
    places = _places(plan(histogram, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = 1 << 44  # more pieces of one length than there can be
        key = places["length"] * scale + places["first"]
        for batch in batches:
            length, place, shifted = (batch.column(n).to_numpy() for n in ("length", "place", "_shift"))
            rank = place + shifted
            at = np.searchsorted(key, length * scale + rank, "right") - 1
            step, copies = rank - places["first"][at], places["copies"][at]
            kept = {n: batch.column(n) for n in batch.schema.names if n not in ("part", "place", "_shift")}
            yield record(**kept, sequence_id=places["base"][at] + step // copies, offset=places["offset"][at] + step % copies * length)

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name not in ("part", "place", "_shift")]
    return ranked.mapInArrow(run, ", ".join([*kept, "sequence_id bigint", "offset bigint"]))
