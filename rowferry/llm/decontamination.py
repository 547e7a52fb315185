"""Benchmark decontamination with an FM-index per shard of documents.

A shard is what one Arrow batch holds of the documents. Its index covers the runs of words that all
occur in the benchmark and are long enough for a window; no other word can be part of a hit, so
nothing is lost. On the runs' suffix array rest the Burrows-Wheeler transform, a wavelet matrix for
ranks, and every ``SAMPLE``-th suffix position. All windows of the benchmark are searched backwards
at once; occurrences are located by walking to the next sampled position; their spans are merged.

The benchmark is a query set: its windows go to the shards in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import batches_of_texts, columns_of, over_batches, pick, record, stored
from rowferry.llm.kernels import LETTERS, U, Words, chunks, spread

#: Words of a window; a shorter item is one window.
WINDOW = 13
#: Distance of the sampled suffix positions.
SAMPLE = 32
#: Characters of benchmark text that go to the shards at a time.
BLOCK_CHARS = 16 << 20


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    sa = np.argsort(text, kind="stable")
    ordered = text[sa]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = start
    size = 1
    last = np.concatenate((new[1:], [True]))
    todo = np.flatnonzero(~(new & last))  # places in sa whose suffix is not yet alone
    while len(todo):
        own = sa[todo]
        at = own + size
        after = np.where(at < n, rank[np.minimum(at, n - 1)], -1)
        group = rank[own]
        order = np.argsort(group * (n + 1) + after + 1, kind="stable")
        own, group, after = own[order], group[order], after[order]
        sa[todo] = own
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])))
        start = todo[np.maximum.accumulate(np.where(new, np.arange(len(todo)), 0))]
        rank[own] = start
        last = np.concatenate((new[1:], [True]))
        todo = todo[~(new & last)]
        size *= 2
    return sa


class FMIndex:
    """Backward search over an array of symbols from 0 to ``alphabet - 1``; 0 separates runs."""

    def __init__(self, text: np.ndarray, alphabet: int, sample: int = SAMPLE):
        text, alphabet = np.concatenate((text + 1, [0])), alphabet + 1  # one end, smaller than all symbols
        self.n = len(text)
        sa = suffix_array(text)
        bwt = text[sa - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet))))
        self.levels = []
        for level in reversed(range(max(1, int(alphabet - 1).bit_length()))):
            bit = (bwt >> level) & 1
            ones = np.concatenate(([0], np.cumsum(bit))).astype(np.int32)
            self.levels.append((level, ones, self.n - int(ones[-1])))
            bwt = np.concatenate((bwt[bit == 0], bwt[bit == 1]))
        kept = sa % sample == 0
        self.kept = kept
        self.kept_rank = np.concatenate(([0], np.cumsum(kept)))
        self.position = sa[kept]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before place ``at`` of the transform."""
        low = np.zeros(len(symbol), np.int64)
        at = at.astype(np.int64)
        for level, ones, zeros in self.levels:
            bit = (symbol >> level) & 1
            up, base = ones[at].astype(np.int64), ones[low].astype(np.int64)
            at = np.where(bit, zeros + up, at - up)
            low = np.where(bit, zeros + base, low - base)
        return at - low

    def step(self, row: np.ndarray) -> np.ndarray:
        """Rows of the suffixes that are one symbol longer."""
        symbol, at = np.zeros(len(row), np.int64), row.astype(np.int64)
        low = np.zeros(len(row), np.int64)  # where the symbol's block begins, level by level
        for level, ones, zeros in self.levels:
            up, base = ones[at].astype(np.int64), ones[low].astype(np.int64)
            bit = ones[at + 1] > ones[at]
            symbol |= bit.astype(np.int64) << level
            at = np.where(bit, zeros + up, at - up)
            low = np.where(bit, zeros + base, low - base)
        return self.first[symbol] + at - low

    def search(self, patterns: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of the suffixes that begin with each pattern (rows of an array)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        rows = np.arange(len(patterns))
        for k in range(patterns.shape[1]):
            rows = rows[(k < length[rows]) & (low[rows] < high[rows])]
            if not len(rows):
                break
            symbol = patterns[rows, length[rows] - 1 - k] + 1
            low[rows] = self.first[symbol] + self.rank(symbol, low[rows])
            high[rows] = self.first[symbol] + self.rank(symbol, high[rows])
        return low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions in the text of the suffixes in these rows."""
        row, steps = row.copy(), np.zeros(len(row), np.int64)
        todo = np.flatnonzero(~self.kept[row])
        while len(todo):
            row[todo] = self.step(row[todo])
            steps[todo] += 1
            todo = todo[~self.kept[row[todo]]]
        return (self.position[self.kept_rank[row]] + steps) % self.n


@dataclass(frozen=True)
class Queries:
    """Distinct windows of a block of items as rows of word numbers (from 1 on), and their items."""

    words: np.ndarray  # sorted hashes of the words; word number k + 1
    patterns: np.ndarray
    length: np.ndarray
    items: list[list]

    @classmethod
    def of(cls, item_ids: list, texts: list, window: int) -> Queries:
        words = Words(texts, LETTERS)
        h = words.hashes()
        known, number = np.unique(h, return_inverse=True)
        found: dict[tuple, set] = {}
        for i, item in enumerate(item_ids):
            own = (number[words.first[i] : words.first[i + 1]] + 1).tolist()
            width = min(window, len(own))
            for p in range(len(own) - width + 1 if width else 0):
                found.setdefault(tuple(own[p : p + width]), set()).add(item)
        keys = sorted(found)
        patterns = np.zeros((len(keys), window), np.int64)
        for r, key in enumerate(keys):
            patterns[r, : len(key)] = key
        return cls(known, patterns, np.array([len(k) for k in keys], np.int64), [sorted(found[k], key=str) for k in keys])

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Numbers of words by hash; 0 for words that no item has."""
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        table = np.zeros(1 << 16, bool)  # most words fail on 16 bits of their hash
        table[(self.words & U(0xFFFF)).astype(np.int64)] = True
        maybe = np.flatnonzero(table[(h & U(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.words, h[maybe]), len(self.words) - 1)
        out = np.zeros(len(h), np.int64)
        out[maybe] = np.where(self.words[at] == h[maybe], at + 1, 0)
        return out


def _hits(words: Words, queries: Queries) -> tuple[np.ndarray, list[set]]:
    """Which words of the shard are hit, and the items that occur in each text."""
    n, texts = len(words.start), len(words.first) - 1
    hit, items = np.zeros(n, bool), [set() for _ in range(texts)]
    if not n or not len(queries.patterns):
        return hit, items
    number = queries.numbers(words.hashes())
    row = np.repeat(np.arange(texts), np.diff(words.first))
    known = np.flatnonzero(number)
    new = np.concatenate(([True], (np.diff(known) != 1) | (row[known][1:] != row[known][:-1]))) if len(known) else np.empty(0, bool)
    run = np.cumsum(new) - 1
    size = np.bincount(run) if len(known) else np.empty(0, np.int64)
    long = size >= queries.length.min()
    kept = known[long[run]]
    if not len(kept):
        return hit, items
    edge = np.flatnonzero(new[long[run]])
    text = np.insert(number[kept], edge, 0)  # a separator before every run
    place = np.insert(kept, edge, -1)
    index = FMIndex(text, len(queries.words) + 1)
    low, high = index.search(queries.patterns, queries.length)
    found = np.flatnonzero(high > low)
    count = (high - low)[found]
    rows = np.arange(count.sum()) + np.repeat(low[found] - np.cumsum(count) + count, count)
    pattern = np.repeat(found, count)
    at = place[index.locate(rows)]
    for width in np.unique(queries.length[found]):
        mark = np.zeros(n, bool)
        mark[at[queries.length[pattern] == width]] = True
        hit |= spread(mark, int(width), n)
    pairs = np.unique(np.stack((row[at], pattern), 1), axis=0)
    for i, p in pairs.tolist():
        items[i].update(queries.items[p])
    return hit, items


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Occurrences of benchmark windows in every document.

    Returns one row per row of ``docs``: doc_id, text, the columns to ``keep``, n_words, n_hit, items
    (ids as text, sorted) and spans (hit word ranges, array<struct<first, last>>, last exclusive). Words are
    ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. Items with fewer words than a window are
    one window; items without words, null items and null documents have none. Items with a null id
    take no part. Repeated rows and null document ids stay as they are.
    """
    batches_of_texts(docs.sparkSession)
    chosen = pick(docs, doc_id=id_col, text=text_col, **{name: name for name in keep})
    items = pick(benchmark, item=item_col, text=item_text_col).where(F.col("item").isNotNull() & F.col("text").isNotNull())
    items = items.select(F.col("item").cast("string").alias("item"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    chosen_names = chosen.columns
    spans_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    schema = f"{columns_of(chosen)}, n_words bigint, n_hit bigint, items array<string>, spans array<struct<first:bigint,last:bigint>>"

    def searched(source: DataFrame, block: int) -> DataFrame:
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        pairs = sorted((r["item"], r["text"]) for r in own.collect())  # about ``block_chars`` of query text
        queries = docs.sparkSession.sparkContext.broadcast(Queries.of([p[0] for p in pairs], [p[1] for p in pairs], window))

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = batch.column(1).to_pylist()
            before = [batch.column(name).to_pylist() for name in ("items", "spans")] if "spans" in batch.schema.names else None
            for lo, hi in chunks(texts, 8 << 20):
                words = Words(texts[lo:hi], LETTERS)
                hit, found = _hits(words, queries.value)
                spans, names = [], []
                for i in range(hi - lo):
                    a, b = int(words.first[i]), int(words.first[i + 1])
                    if before:
                        found[i].update(before[0][lo + i])
                        for span in before[1][lo + i]:
                            hit[a + span["first"] : a + span["last"]] = True
                    names.append(sorted(found[i]))
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[a:b].view(np.int8), [0])))) if names[-1] else np.empty(0, np.int64)
                    spans.append([{"first": s, "last": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())])
                total = np.concatenate(([0], np.cumsum(hit)))
                part = batch.slice(lo, hi - lo)
                yield record(**{name: part.column(name) for name in chosen_names}, n_words=np.diff(words.first), n_hit=total[words.first[1:]] - total[words.first[:-1]], items=pa.array(names, pa.list_(pa.string())), spans=pa.array(spans, spans_type))

        return source.mapInArrow(over_batches(run), schema)

    out = chosen
    for block in range(blocks):  # each pass adds its items and spans to the rows
        out = searched(out, block)
        if block % 8 == 7 and block + 1 < blocks:
            out = stored(out, "searched")
    return out


def contaminated() -> Column:
    """Hit words make up a twentieth of the document or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def remove_spans(found: DataFrame) -> DataFrame:
    """The rows of :func:`find_hits` with clean_text: the whole text but for the hit words."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
        out = []
        for text, own in zip(texts, spans):
            if own:
                words = Words([text], LETTERS)
                raw, parts, at = words.raw, [], 0
                for span in own:
                    parts.append(raw[at : words.start[span["first"]]])
                    at = int(words.start[span["last"] - 1] + words.length[span["last"] - 1])
                text = b"".join([*parts, raw[at:]]).decode("utf-8", "surrogatepass")
            out.append(text)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "clean_text"])

    return found.mapInArrow(over_batches(run), f"{columns_of(found)}, clean_text string")
