"""Vectorised word and shingle hashing over whole texts, shared by the corpus operators.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` after A-Z is lower-cased; the UTF-8
bytes of other characters never fall in that range, so working on bytes equals working on text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: For each byte whether it belongs to a word.
_INSIDE = bytes(b not in (32, *range(9, 14)) for b in range(256))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (xor-shift-multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of one text: byte bounds, a 64-bit hash of each, and the lowered bytes."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray


class WordHasher:
    """Hashes every word of a text; powers of the base are kept between calls."""

    def __init__(self) -> None:
        self._grow(1 << 14)

    def _grow(self, n: int) -> None:
        self._pow, self._inv = _powers(_BASE, n), _powers(_INVERSE, n)

    def __call__(self, text: str) -> Words:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        n = len(data)
        if n + 1 > len(self._pow):
            self._grow(2 * n + 2)
        upper = (data >= 65) & (data <= 90)
        data = data + (upper.astype(np.uint8) << 5)
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._pow[:n], out=total[1:])
            poly = (total[end] - total[start]) * self._inv[start]
        return Words(start, end, mix64(poly + (end - start).astype(np.uint64)), data)

    def many(self, texts: list[str]) -> tuple[Words, np.ndarray]:
        """The words of all texts, each set between line ends, and where each text begins: the same
        hashes as one by one, with one pass of array work for many short texts."""
        coded = [t.encode("utf-8", "surrogatepass") for t in texts]
        joined = b"\n".join((b"", *coded, b"")).lower()
        data = np.frombuffer(joined, dtype=np.uint8)
        n = len(data)
        if n + 1 > len(self._pow):
            self._grow(2 * n + 2)
        inside = np.frombuffer(joined.translate(_INSIDE), dtype=np.uint8)
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        start, end = edge[::2], edge[1::2]
        total = data.astype(np.uint64)
        with np.errstate(over="ignore"):
            total += np.uint64(1)
            total *= self._pow[:n]
            np.cumsum(total, out=total)
            poly = (total[end - 1] - total[start - 1]) * self._inv[start]
            hashed = mix64(poly + (end - start).astype(np.uint64))
        begin = np.cumsum([1, *(len(c) + 1 for c in coded)])[:-1]
        return Words(start, end, hashed, data), begin


def sequence_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; of the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return words
    width = min(width, n)
    with np.errstate(over="ignore"):
        out = words[: n - width + 1].copy()
        for i in range(1, width):
            out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + words[i : n - width + 1 + i])
        return out + np.uint64(width)


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """The distinct shingles of a text in ascending order of their hash."""
    return np.unique(sequence_hash(words, width))


def span_hash(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of words ``[start, end)``, equal for equal runs anywhere."""
    n = len(words)
    power, inverse = _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(words * power[:n], out=total[1:])
        return mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def slices(frame, text_col: str, max_chars: int) -> Iterator:
    """Cut a pandas batch into runs of rows of about ``max_chars`` characters (one row at least)."""
    sizes = frame[text_col].str.len().fillna(0).to_numpy(dtype=np.int64) if len(frame) else np.zeros(0, np.int64)
    begin, seen = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and seen + size > max_chars:
            yield frame.iloc[begin:i]
            begin, seen = i, 0
        seen += size
    if begin < len(frame):
        yield frame.iloc[begin:]
