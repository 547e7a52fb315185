"""Secret scan: fixed patterns, and character Markov models of random strings and ordinary words.

The patterns find what has a known form. The models find the rest: two first-order chains over
character classes, one trained on labelled secrets, one on labelled ordinary identifiers; a run of
token characters is reported when the log-likelihood ratio of the two, summed over its characters,
passes a threshold. Both chains are tables of fixed size.

Labels come from the documents: what the patterns find is labelled a secret, words are labelled
ordinary. ``SAMPLE_DOCS`` bounds the training sample; scanning has no bound.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import batches_of_texts, columns_of, over_batches, pick, record, sampled
from rowferry.llm.kernels import chunks

# The patterns of the contract and the lengths below which a match is dropped.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "markov")

#: Documents, with the smallest hashes of their text, that train the models: so many of those that may
#: hold a labelled string, and so many of all.
SAMPLE_DOCS = 4000
_LABELLED = "(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"
#: Shortest run of token characters that the models judge.
MIN_RUN = 12
#: Summed log-likelihood ratio, and its mean per character, from which a run is reported.
MIN_RATIO, MIN_MEAN = 12.0, 0.4

# A state per character of a token; one more stands before the first.
_TOKEN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_STATES = len(_TOKEN) + 1
_STATE = np.zeros(256, np.uint8)
_STATE[np.frombuffer(_TOKEN, np.uint8)] = np.arange(1, _STATES)
_CLASSES = ("start", "upper", "lower", "digit", "sign")
_CLASS = np.array([0] + [1] * 26 + [2] * 26 + [3] * 10 + [4] * 5)
# What follows what in names and numbers that a corpus may not show: mostly the same kind again.
_FOLLOWS = np.array([[0, 0.3, 0.4, 0.2, 0.1]] + [[0, *np.where(np.arange(1, 5) == k, 0.6, np.where(np.arange(1, 5) == 4, 0.2, 0.1))] for k in range(1, 5)])
_FOLLOWS /= _FOLLOWS.sum(1, keepdims=True)
_HEX = np.zeros(256, bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
_RUN = re.compile("[A-Za-z0-9+/_=-]{2,}")
_KEYS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")


def _runs(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if len(mask) and mask[0]:
        edge = np.concatenate(([0], edge))
    if len(edge) % 2:
        edge = np.concatenate((edge, [len(mask)]))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns in one text, for a check by hand."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= MIN_HEX]
    return sorted(out)


def _found(texts: list[str]) -> tuple[list[list[tuple[int, int, int]]], bytes, np.ndarray, np.ndarray]:
    """Pattern spans of each text in code points; the bytes of all; starts of the texts in them."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    lower = data.lower()
    hits = set()
    for key in _KEYS:  # which texts have a word that an assignment needs; only there the pattern runs
        at = lower.find(key)
        while at >= 0:
            i = int(np.searchsorted(first, at, "right")) - 1
            hits.add(i)
            at = lower.find(key, int(first[i + 1]))
    for i in hits:
        spans[i] += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(texts[i]) if len(m[2]) >= MIN_ASSIGN]
    at = data.find(b"AKIA")
    while at >= 0:
        i = int(np.searchsorted(first, at, "right")) - 1
        spans[i] += [(m.start(), 1, m.end()) for m in ACCESS.finditer(texts[i]) if len(m[0]) >= MIN_ACCESS]
        at = data.find(b"AKIA", int(first[i + 1]))
    array = np.frombuffer(data, np.uint8)
    for s, e in zip(*(x.tolist() for x in _runs(_HEX[array], MIN_HEX))):
        i = int(np.searchsorted(first, s, "right")) - 1
        spans[i].append((*_points(parts[i], s - int(first[i]), 2, e - s),))
    return spans, data, first, array


def _points(text: bytes, start: int, kind: int, length: int) -> tuple[int, int, int]:
    """A span of ASCII bytes as (start, kind, end) in code points."""
    at = len(text[:start].decode("utf-8", "surrogatepass"))
    return at, kind, at + length


def train(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Log-likelihood ratios, secret to ordinary, of each character after each other.

    Two transition tables are counted over the sample by the tasks and added up. Secrets are the
    strings that the patterns find (of an assignment its value); ordinary are all other runs of token
    characters. Half of the secret chain is uniform, so that it fits random strings of any alphabet
    and holds where few strings are labelled.
    """
    batches_of_texts(docs.sparkSession)
    texts = pick(docs, text=text_col).where(F.col("text").isNotNull()).withColumn("rank", F.xxhash64("text"))
    both = sampled(texts.where(F.col("text").rlike(_LABELLED)), "rank", sample_docs).unionByName(sampled(texts, "rank", sample_docs))
    sample = both.groupBy("rank").agg(F.min("text").alias("text")).select("text")
    size = _STATES * _STATES

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tables = np.zeros(2 * size, np.int64)
        rows = batch.column(0).to_pylist()
        for lo, hi in chunks(rows):
            own = rows[lo:hi]
            spans = _found(own)[0]
            for text, secret in zip(own, spans):
                strings = [(1, ASSIGN.match(text, s)[2] if kind == 0 else text[s:e]) for s, kind, e in secret]
                at = 0
                for s, _, e in [*sorted(secret), (len(text), 0, 0)]:
                    strings += [(0, w) for w in _RUN.findall(text, at, max(at, s))]
                    at = max(at, e)
                for label in (0, 1):
                    data = ("\n" + "\n".join(s for k, s in strings if k == label)).encode("ascii", "replace")
                    state = _STATE[np.frombuffer(data, np.uint8)].astype(np.int64)
                    pair = state[:-1] * _STATES + state[1:]
                    tables[label * size :][:size] += np.bincount(pair[state[1:] > 0], minlength=size)
        at = np.flatnonzero(tables)
        yield record(cell=at, n=tables[at])

    counted = sample.mapInArrow(over_batches(count), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    tables = np.zeros(2 * size)
    for row in counted.collect():  # at most two tables of 67 x 67
        tables[row["cell"]] = row["n"]
    ordinary, secret = tables.reshape(2, _STATES, _STATES)
    # a random string follows no order: its chain is shrunk to the plain frequencies of characters
    even = np.full(_STATES, 1 / (_STATES - 1))
    even[0] = 0
    plain = (secret.sum(0) + 200 * even) / (secret.sum() + 200)
    secret = ((secret + 200 * plain) / (secret.sum(1, keepdims=True) + 200) + even) / 2
    # half of the ordinary chain knows kinds of characters only, so that words never seen stay ordinary
    kinds = np.zeros((len(_CLASSES), len(_CLASSES)))
    np.add.at(kinds, (_CLASS[:, None], _CLASS[None, :]), ordinary)
    kinds = 0.9 * (kinds + _FOLLOWS) / (kinds + _FOLLOWS).sum(1, keepdims=True) + 0.1 * _FOLLOWS
    of_kind = np.bincount(_CLASS, minlength=len(_CLASSES))
    by_kind = (kinds / of_kind)[_CLASS][:, _CLASS]
    ordinary = (ordinary / np.maximum(ordinary.sum(1, keepdims=True), 1) + by_kind) / 2
    ordinary[:, 1:] += 1e-6
    ratio = np.zeros((_STATES, _STATES))
    ratio[:, 1:] = np.log(secret[:, 1:]) - np.log(ordinary[:, 1:])
    return np.clip(ratio, -6, 6)


def scan(docs: DataFrame, ratio: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """All secret spans of every text.

    Returns one row per row of ``docs``: doc_id, text, the columns to ``keep``, and spans
    array<struct<kind, start, end>> in code points, sorted by start and then kind. Spans of the patterns always stay; of a run that the
    models report, what lies outside them is added. Null and empty texts have no spans;
    repeated rows give repeated rows; null ids stay null. ``ratio`` is what :func:`train` returns,
    by default trained on ``docs``.
    """
    batches_of_texts(docs.sparkSession)
    ratio = train(docs, text_col) if ratio is None else ratio
    chosen = pick(docs, doc_id=id_col, text=text_col, **{name: name for name in keep})
    kind_of = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, out = batch.column(1).to_pylist(), []
        for lo, hi in chunks(texts, 4 << 20):
            own = [t or "" for t in texts[lo:hi]]
            spans, data, first, array = _found(own)
            state = _STATE[array]
            start, end = _runs(state > 0, MIN_RUN)
            if len(start):
                length = end - start
                at = np.arange(length.sum()) + np.repeat(start - np.cumsum(length) + length, length)
                before = state[at - 1]
                edges = np.cumsum(length) - length
                before[edges] = 0
                each = ratio[before, state[at]]
                score, total = np.add.reduceat(each, edges), np.concatenate(([0.0], np.cumsum(each)))
                rest: list[tuple[int, tuple[int, int, int]]] = []
                for k in np.flatnonzero((score >= MIN_RATIO) & (score >= MIN_MEAN * length)):
                    s = int(start[k])
                    i = int(np.searchsorted(first, s, "right")) - 1
                    span = _points(data[int(first[i]) : int(first[i + 1])], s - int(first[i]), 3, int(length[k]))
                    place = span[0]
                    for a, _, b in [*sorted(x for x in spans[i] if x[1] < 3 and x[0] < span[2] and x[2] > span[0]), (span[2], 3, span[2])]:
                        lo_, hi_ = (int(edges[k]) + x - span[0] for x in (place, max(a, place)))
                        # what a pattern leaves of the run has to look random by itself
                        if hi_ > lo_ and total[hi_] - total[lo_] >= MIN_MEAN * (hi_ - lo_):
                            rest.append((i, (place, 3, a)))
                        place = max(place, b)
                for i, span in rest:
                    spans[i].append(span)
            out += [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(x)] for x in spans]
        yield record(**dict(zip(batch.schema.names, batch.columns)), spans=pa.array(out, pa.list_(kind_of)))

    return chosen.mapInArrow(over_batches(run), f"{columns_of(chosen)}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(scanned: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The rows of :func:`scan` with the text between the spans kept and each span, or overlapping
    spans together, replaced by ``mask``."""
    # fold over the spans: what is written so far, and the place up to which the text is used
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc, span):
        gap = F.substring("text", acc["at"] + 1, F.greatest(span["start"] - acc["at"], F.lit(0)))
        new = F.when(span["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"])
        return F.struct(new.alias("out"), F.greatest(acc["at"], span["end"]).alias("at"))

    folded = F.aggregate("spans", zero, step, lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text"))))
    return scanned.withColumn("text", F.when(F.size("spans") > 0, folded).otherwise(F.col("text")))
