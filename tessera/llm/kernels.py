"""Vectorised text kernels over Arrow string buffers.

A batch of texts is one UTF-8 byte buffer with offsets, so words, lines, hashes
and n-grams of thousands of documents come from a few numpy passes. Byte classes
are exact for UTF-8 because every class used here treats all bytes >= 0x80 alike.
Batches are cut into slices of a few MB, which bounds memory whatever the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
#: Range hashes are two polynomials modulo the prime 2**31 - 1, which, unlike a power of two, has no texts that collide for every base.
_PRIME, _BITS = U((1 << 31) - 1), U(31)
_BASES = (1_103_515_245, 2_023_406_815)
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93)) >> U(33)


def byte_class(pattern: str) -> np.ndarray:
    """True for each byte below 0x80 that the one-character pattern matches, and for all others if it matches U+00E9."""
    import re

    p = re.compile(pattern)
    return np.array([bool(p.fullmatch(chr(b) if b < 128 else "é")) for b in range(256)])


NOT_SPACE = byte_class(r"[^\x20\x09-\x0D]")

LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: For texts whose A-Z count as a-z.
WORD_LIKE = byte_class(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")[LOWER]


def _folded(x: np.ndarray) -> np.ndarray:
    """A smaller number that is equal modulo the prime."""
    return (x & _PRIME) + (x >> _BITS)


def _power_table(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for base in _BASES:
        pair = []
        for step in (base, pow(base, -1, int(_PRIME))):
            table = np.ones(max(n, 1), dtype=np.uint32)
            done = 1
            while done < n:
                part = _folded(_folded(table[: min(done, n - done)].astype(U) * U(pow(step, done, int(_PRIME)))))
                table[done : done + len(part)] = np.where(part >= _PRIME, part - _PRIME, part)
                done *= 2
            pair.append(table)
        out.append((pair[0], pair[1]))
    return out


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of the bases and of their inverses; only those for a slice are kept, those of a longer text go with it."""
    if n > SLICE_BYTES + 1:
        return _power_table(n)
    if not _POWERS:
        _POWERS.extend(_power_table(SLICE_BYTES + 1))
    return _POWERS


class Slice:
    """Some consecutive texts: ``buf`` uint8, ``off`` int64 with a text's bytes at off[i]:off[i+1]."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, first: int):
        self.buf, self.off, self.first, self.rows = buf, off, first, len(off) - 1

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each text."""
        total = np.zeros(len(mask) + 1, dtype=np.float64 if mask.dtype.kind == "f" else np.int64)
        np.cumsum(mask, out=total[1:])
        return total[self.off[1:]] - total[self.off[:-1]]

    def spans(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of wanted bytes within texts: starts, ends, and run number at which each text begins."""
        n = len(self.buf)
        if not n:
            z = np.zeros(0, dtype=np.int64)
            return z, z, np.zeros(self.rows + 1, dtype=np.int64)
        inner = self.off[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        start = wanted.copy()
        start[1:] &= ~wanted[:-1]
        start[inner] = wanted[inner]
        end = wanted.copy()
        end[:-1] &= ~wanted[1:]
        end[inner - 1] = wanted[inner - 1]
        s = np.flatnonzero(start)
        return s, np.flatnonzero(end) + 1, np.searchsorted(s, self.off)

    def prefix(self, lower: bool) -> list[np.ndarray]:
        """Running sums for ``hashes``."""
        value = BYTE_VALUE[LOWER[self.buf] if lower else self.buf]
        out = []
        for up, _ in _powers(len(value)):
            total = np.zeros(len(value) + 1, dtype=U)
            np.cumsum(_folded(value * up[: len(value)]), out=total[1:])
            out.append(total)
        return out

    @staticmethod
    def hashes(prefix: list[np.ndarray], s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte ranges s:e, equal for equal bytes wherever they stand."""
        out = (e - s).astype(U)
        for total, (_, down) in zip(prefix, _powers(len(prefix[0]))):
            x = _folded(_folded(total[e] - total[s])) * down[s]
            x = _folded(_folded(x))
            out = mix(out ^ np.where(x >= _PRIME, x - _PRIME, x)) * U(_BASE)
        return mix(out)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts (null as empty) in slices of about ``limit`` bytes; a longer text is a slice of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield Slice(data[off[at] : off[to]], off[at : to + 1] - off[at], at)
        at = to


def owners(bounds: np.ndarray) -> np.ndarray:
    """For run boundaries per text, the text of every run."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def windows(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive runs of one text, and the first run of each window."""
    if len(h) < n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    m = len(h) - n + 1
    total = h[:m].copy()
    for k in range(1, n):
        total = total * U(_BASE) + h[k : k + m]
    at = np.flatnonzero(owner[:m] == owner[n - 1 :])
    return mix(total[at]), at


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in any of the ranges."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def repeats(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    ordered = np.sort(keys)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return np.zeros(len(keys), dtype=bool)
    return again[np.minimum(np.searchsorted(again, keys), len(again) - 1)] == keys


def expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers repeated ``counts`` times, and the running number within each row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
