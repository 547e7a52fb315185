"""Removal of repeated passages by phrase automata.

A passage repeats where a window of ``WINDOW`` words also starts in a document with a smaller id.

1. Sampling. Of the phrases of ``PHRASE`` words in a window the one with the smallest hash is the
   window's phrase, so equal windows have equal phrases. Consecutive windows with one phrase form a
   segment; a row per segment is what the corpus is searched with, not a row per word.
2. Confirmation. Phrases of two documents or more recur. A segment that an earlier document has
   word for word is removed as a whole; in the first documents of the different segments of a
   phrase, windows have to be compared.
3. Automata. Documents with recurring phrases are dealt into blocks. The phrases of a block are
   compiled into an Aho-Corasick automaton of word numbers, so automata are sharded with the
   documents, and none grows with the corpus. The block's documents are streamed through it, which
   locates every occurrence word by word. A hit counts only where the window's sampled phrase has the
   same hash, so hashes decide and automata locate; documents without recurring phrases are left out.
4. Windows around the occurrences are compared across documents as (phrase, window) hashes of 64
   bits each; the smallest id of each is found by an aggregate with partial sums, so a passage that a
   third of all documents share is one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import NO_ID, batches_of_texts, over_batches, pick, record, stored
from rowferry.llm.kernels import PLAIN, U, Words, chunks, inside, list_column, mix, sliding_min, spread, windows

WINDOW = 50
PHRASE = 16
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def segments(phrase: np.ndarray, row: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of every run of windows with one phrase in one text.

    ``whole`` marks the windows that lie in one text; a run is no longer than half a window, so its
    ends hold all that is between them.
    """
    ok = np.flatnonzero(whole)
    if not len(ok):
        return ok, ok
    new = np.concatenate(([True], (phrase[ok][1:] != phrase[ok][:-1]) | (row[ok][1:] != row[ok][:-1]) | (np.diff(ok) != 1)))
    start = np.flatnonzero(new)
    place = np.arange(len(ok)) - np.repeat(start, np.diff(np.concatenate((start, [len(ok)]))))
    new |= place % (WINDOW // 2) == 0
    start = np.flatnonzero(new)
    end = np.concatenate((start[1:], [len(ok)])) - 1
    return ok[start], ok[end]


def _sampled(words: Words, window: int, phrase: int):
    """Hashes of words, phrases and windows, and the phrase of each window."""
    h = words.hashes()
    parts, full = windows(h, phrase), windows(h, window)
    low = sliding_min(parts, window - phrase + 1)
    return h, parts, full, low


def _contents(words: Words, low: np.ndarray, full: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of every segment, and a hash of its words."""
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))[: len(low)]
    a, b = segments(low, row, inside(words.first, window, len(words.start)))
    return a, b, mix(full[a] * U(3) + mix(full[b] + (b - a).astype(U)))


def remove_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document without the words that repeat an earlier document.

    Returns one row per row of ``docs``: doc_id, n_words, n_removed, spans (removed word ranges,
    array<struct<first, last>>, last exclusive) and kept_text (the other words, one space between).
    Words are ``[^\\x20\\x09-\\x0D]+``. Null texts have no words and an empty kept_text. Documents with
    one id do not count as earlier than each other; rows with a null id come after all others.
    Windows are judged on the input. Columns other than the two named ones are not read.
    """
    spark = batches_of_texts(docs.sparkSession)
    id_type = docs.select(docs[f"`{id_col}`"]).schema[0].dataType.simpleString()
    chosen = pick(docs, doc_id=id_col, text=text_col)
    keyed = chosen.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("key"), F.unhex(F.md5("text")).alias("same"), "text")

    def sample(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, same, texts = batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_pylist()
        for lo, hi in chunks(texts):
            words = Words(texts[lo:hi], PLAIN)
            _, _, full, low = _sampled(words, window, phrase)
            a, _, content = _contents(words, low, full, window)
            row = np.searchsorted(words.first, a, "right") - 1
            yield record(phrase=low[a].view(np.int64), content=content.view(np.int64), key=keys[lo:hi][row], same=same.slice(lo, hi - lo).take(pa.array(row)))

    found = stored(keyed.select("key", "same", "text").mapInArrow(over_batches(sample), "phrase bigint, content bigint, key bigint, same binary"), "segments")
    groups = found.groupBy("phrase").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    recurring = groups.where("first < last").select(F.col("phrase").alias("_phrase"))
    # a segment that an earlier document has as well is removed as a whole; windows have to be
    # compared only in the first document of each of several different segments of a phrase
    wanted = stored(found.join(recurring, F.col("phrase") == F.col("_phrase")).select("phrase", "content", "key", "same"), "recurring")
    firsts = wanted.groupBy("phrase", "content").agg(F.min("key").alias("owner"))
    mixed = firsts.groupBy("phrase").agg((F.count("*") > 1).alias("mixed")).withColumnRenamed("phrase", "_phrase")
    firsts = firsts.join(mixed, F.col("phrase") == F.col("_phrase")).select("_phrase", F.col("content").alias("_content"), "owner", "mixed")
    wanted = wanted.join(firsts, (F.col("phrase") == F.col("_phrase")) & (F.col("content") == F.col("_content"))).where("mixed or key > owner")
    lists = wanted.groupBy("key", "same").agg(F.collect_set(F.struct("phrase", "content", (F.col("key") == F.col("owner")).alias("compare"))).alias("s"))
    lists = lists.select(F.col("key").alias("_key"), F.col("same").alias("_same"), "s.phrase", "s.content", "s.compare")
    marked = keyed.join(lists, (F.col("key") == F.col("_key")) & (F.col("same") == F.col("_same")), "left").select("doc_id", "key", "same", "text", "phrase", "content", "compare")

    def locate(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        has_phrases = pc.is_valid(batch.column(4))
        plain = batch.filter(pc.invert(has_phrases))
        if plain.num_rows:  # no recurring phrase: nothing to locate
            split = [(t or "").encode("utf-8", "surrogatepass").split() for t in plain.column(3).to_pylist()]
            none = np.zeros(len(split) + 1, np.int32)
            yield record(
                doc_id=plain.column(0), key=plain.column(1), same=plain.column(2), n_words=np.fromiter(map(len, split), np.int64, len(split)), n_removed=np.zeros(len(split), np.int64),
                spans=pa.array([[]] * len(split), _SPANS), kept_text=pa.array([b" ".join(w).decode("utf-8", "surrogatepass") for w in split], pa.string()), text=pa.nulls(len(split), pa.string()),
                **{n: pa.ListArray.from_arrays(pa.array(none), pa.array([], t)) for n, t in (("place", pa.int32()), ("phrase", pa.int64()), ("content", pa.int64()))},
            )
        batch = batch.filter(has_phrases)
        ids, keys, same = (batch.column(i) for i in range(3))
        texts, listed = batch.column(3).to_pylist(), [batch.column(i).to_pylist() for i in (4, 5, 6)]
        for lo, hi in chunks(texts):
            words = Words(texts[lo:hi], PLAIN)
            n = hi - lo
            removed, (at, p, w) = _stream(words, *[x[lo:hi] for x in listed], window, phrase)
            out = _result(words, removed, n)
            place = np.searchsorted(at, words.first)
            later = np.diff(place) > 0  # these texts are not ready
            yield record(
                doc_id=ids.slice(lo, n), key=keys.slice(lo, n), same=same.slice(lo, n), n_words=np.diff(words.first),
                n_removed=out[0], spans=out[1], kept_text=pa.array([None if x else k for x, k in zip(later, out[2])], pa.string()),
                text=pa.array([t if x else None for x, t in zip(later, texts[lo:hi])], pa.string()),
                place=list_column((at - words.first[np.searchsorted(words.first, at, "right") - 1]).astype(np.int32), np.diff(place)),
                phrase=list_column(p.view(np.int64), np.diff(place)), content=list_column(w.view(np.int64), np.diff(place)),
            )

    spans = "spans array<struct<first:bigint,last:bigint>>"
    located = stored(
        marked.mapInArrow(over_batches(locate), f"doc_id {id_type}, key bigint, same binary, n_words bigint, n_removed bigint, {spans}, kept_text string, text string, place array<int>, phrase array<bigint>, content array<bigint>"),
        "located",
    )
    late = located.where(F.col("text").isNotNull())
    rows = late.select("key", "same", F.explode(F.arrays_zip("place", "phrase", "content")).alias("w")).select("key", "same", "w.*")
    earliest = rows.groupBy("phrase", "content").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last")
    earliest = earliest.select(F.col("phrase").alias("_phrase"), F.col("content").alias("_content"), "first")
    repeats = rows.join(earliest, (F.col("phrase") == F.col("_phrase")) & (F.col("content") == F.col("_content"))).where("key > first")
    per_doc = repeats.groupBy("key", "same").agg(F.collect_set("place").alias("places")).withColumnsRenamed({"key": "_key", "same": "_same"})
    final = late.select("doc_id", "key", "same", "text", "spans").join(per_doc, (F.col("key") == F.col("_key")) & (F.col("same") == F.col("_same")), "left")

    def finish(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, done, places = (batch.column(i).to_pylist() for i in (1, 2, 3))
        for lo, hi in chunks(texts):
            words = Words(texts[lo:hi], PLAIN)
            removed = np.zeros(len(words.start), bool)
            for i in range(lo, hi):
                base, n = int(words.first[i - lo]), int(words.first[i - lo + 1] - words.first[i - lo])
                for span in done[i] or ():
                    removed[base + span["first"] : base + span["last"]] = True
                if places[i]:
                    marks = np.zeros(n, bool)
                    marks[places[i]] = True
                    removed[base : base + n] |= spread(marks, window, n)
            out = _result(words, removed, hi - lo)
            yield record(doc_id=batch.column(0).slice(lo, hi - lo), n_words=np.diff(words.first), n_removed=out[0], spans=out[1], kept_text=pa.array(out[2], pa.string()))

    ready = located.where(F.col("text").isNull()).select("doc_id", "n_words", "n_removed", "spans", "kept_text")
    rest = final.select("doc_id", "text", "spans", "places").mapInArrow(over_batches(finish), f"doc_id {id_type}, n_words bigint, n_removed bigint, {spans}, kept_text string")
    return ready.unionByName(rest)


def _stream(words: Words, phrases: list, contents: list, compare: list, window: int, phrase: int):
    """Words that repeat with whole segments, and the windows (place, phrase, content) to compare.

    For each text its recurring segments are listed: the phrase, the content, and whether their
    windows have to be compared.
    """
    removed = np.zeros(len(words.start), bool)
    h, parts, full, low = _sampled(words, window, phrase)
    number = np.unique(h, return_inverse=True)[1].tolist()
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    wanted = np.unique(np.concatenate([np.array(p, np.int64) for p in phrases])).view(U)
    order = np.argsort(parts, kind="stable")
    at = np.minimum(np.searchsorted(parts[order], np.sort(wanted)), len(order) - 1)
    for a in order[at].tolist():
        automaton.add_word(tuple(number[a : a + phrase]), int(parts[a]))
    automaton.make_automaton()
    first, last, content = _contents(words, low, full, window)
    content = content.view(np.int64)
    windows_at = []
    reach = window - phrase
    for i in range(len(phrases)):
        a, b = int(words.first[i]), int(words.first[i + 1])
        if b - a < window:
            continue
        hits = [(end - phrase + 1, value) for end, value in automaton.iter(tuple(number[a:b]))]
        place = np.array([h[0] for h in hits], np.int64)
        value = np.array([h[1] for h in hits], U)
        # windows around the occurrences whose phrase is the located one
        start = np.repeat(place, reach + 1) + np.tile(np.arange(-reach, 1), len(place))
        value = np.repeat(value, reach + 1)
        ok = (start >= 0) & (start <= b - a - window)
        start, value = start[ok] + a, value[ok]
        start = np.unique(start[low[start] == value])
        segment = content[np.searchsorted(first, start, "right") - 1]
        listed = np.array(contents[i], np.int64)
        rank = np.argsort(listed)
        spot = rank[np.minimum(np.searchsorted(listed[rank], segment), len(listed) - 1)]
        known, open_ = listed[spot] == segment, np.array(compare[i], bool)[spot]
        marks = np.zeros(b - a, bool)
        marks[start[known & ~open_] - a] = True
        removed[a:b] = spread(marks, window, b - a)
        windows_at.append(start[known & open_])
    at = np.concatenate([np.empty(0, np.int64), *windows_at])
    return removed, (at, low[at], full[at])


def _result(words: Words, removed: np.ndarray, n: int):
    total = np.concatenate(([0], np.cumsum(removed)))
    n_removed = total[words.first[1 : n + 1]] - total[words.first[:n]]
    spans, kept = [], []
    for i in range(n):
        a, b = words.first[i], words.first[i + 1]
        own = removed[a:b]
        if n_removed[i]:
            edge = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0]))))
            spans.append([{"first": s, "last": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())])
        else:
            spans.append([])
        kept.append(words.joined(~removed, i).decode("utf-8", "surrogatepass"))
    return n_removed, pa.array(spans, _SPANS), kept
