"""Array helpers that several operators use inside their tasks: words, their hashes, windows.

All hashes are fixed functions of the content, so a retried task gives the same rows. Whole texts
are read; a batch of texts is one buffer, so the number of array calls does not grow with the
number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_GOLD = U(0x9E3779B97F4A7C15)
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
#: Characters of texts that are worked on at once; a longer text is a chunk of its own.
CHUNK = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    h = (h ^ (h >> U(30))) * _M1
    h = (h ^ (h >> U(27))) * _M2
    return h ^ (h >> U(31))


def _byte_table(lower: bool, keep) -> bytes:
    out = bytearray(range(256))
    for b in range(256):
        if lower and 65 <= b <= 90:
            out[b] = b + 32
        if not keep(out[b]):
            out[b] = 32
    return bytes(out)


#: Words of anything but space and \t\n\v\f\r, as they are.
PLAIN = _byte_table(False, lambda b: b != 32 and not 9 <= b <= 13)
#: The same with A-Z lower-cased.
LOWER = _byte_table(True, lambda b: b != 32 and not 9 <= b <= 13)
#: Words of digits, letters and whatever is not ASCII, A-Z lower-cased.
LETTERS = _byte_table(True, lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)


def chunks(texts: list, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``size`` characters; a longer text is alone."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if total and total + n > size:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)


class Words:
    """The words of some texts in one buffer.

    ``raw`` holds the bytes as given, ``start`` and ``length`` the place of each word in it;
    the words of text i are ``first[i]:first[i + 1]``. A null text has no words.
    """

    def __init__(self, texts: list, table: bytes = PLAIN):
        parts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t or b"" for t in texts]
        self.raw = b" ".join(parts)
        seen = self.raw.translate(table)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.offset = np.concatenate(([0], np.cumsum(sizes + 1)))[: len(parts) + 1]
        mask = np.frombuffer(seen, np.uint8) != 32
        edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).view(np.int8)))
        self.start, end = edge[::2], edge[1::2]
        self.length = end - self.start
        self.first = np.searchsorted(self.start, self.offset)
        self.bytes = np.frombuffer(seen + b"\0" * 8, np.uint8)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of every word."""
        return span_hashes(self.bytes, self.start, self.length, seed)

    def joined(self, word_mask: np.ndarray, i: int) -> bytes:
        """The marked words of text i, as they are, with one space between."""
        lo, hi = self.first[i], self.first[i + 1]
        keep = np.flatnonzero(word_mask[lo:hi]) + lo
        raw, start, length = self.raw, self.start[keep].tolist(), self.length[keep].tolist()
        return b" ".join([raw[s : s + n] for s, n in zip(start, length)])


def span_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of spans of a byte array that has eight spare bytes at its end."""
    eight = np.ndarray((max(len(data) - 7, 0),), np.uint64, data, 0, (1,))
    h = mix(length.astype(U) + U((seed + 1) * int(_GOLD) % (1 << 64)))
    at, left, rows = start, length, None
    while len(at):
        word = eight[at] & (U(0xFFFFFFFFFFFFFFFF) >> ((U(8) - np.minimum(left, 8).astype(U)) * U(8)))
        if rows is None:
            h = mix(h ^ word)
        else:
            h[rows] = mix(h[rows] ^ word)
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` numbers; runs across texts are for the caller to leave out."""
    if len(h) < width:
        return np.empty(0, U)
    out, done, power, size = None, 0, h, 1
    while True:
        if width & size:
            part = power[done : len(h) - width + 1 + done]
            out = part if out is None else mix(out * _GOLD + part)
            done += size
        size *= 2
        if size > width:
            return mix(out + U(width))
        power = mix(power[: len(power) - size // 2] * _M1 + power[size // 2 :] + U(size))


def inside(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """For every start of a run of ``width`` items whether the run stays in one text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return text[: n - width + 1] == text[width - 1 :] if n >= width else np.empty(0, bool)


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every run of ``width`` numbers."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, h.dtype)
    low, size = h, 1
    while size * 2 <= width:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    return np.minimum(low[:n], low[width - size : width - size + n])


def spread(marks: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n items a run of ``width`` items covers, given the starts of the runs as a mask."""
    delta = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(marks)
    delta[at] += 1
    np.add.at(delta, at + width, -1)
    return np.cumsum(delta[:n]) > 0


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow list column from all values and the number of values of each row."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values, kind))
