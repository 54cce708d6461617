"""Word hashes of whole batches of texts, with numpy.

A word is a maximal run of letters and digits, lower-cased.  Its hash is a
polynomial in its characters' scrambled codes modulo 2^64, from differences of
one running sum, scrambled once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 20  # characters hashed at once

_BASE = 0x9E3779B97F4A7C15
_tables: list = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (multiply and shift)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _table() -> np.ndarray:
    """Code point -> scrambled code, 0 where no letter or digit."""
    if not _tables:
        keep = np.fromiter((chr(i).isalnum() for i in range(0x110000)), dtype=bool, count=0x110000)
        _tables.append(np.where(keep, mix(np.arange(1, 0x110001, dtype=np.uint64)) | np.uint64(1),
                                np.uint64(0)))
    return _tables[0]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_tables) < 2 or len(_tables[1][0]) < n:
        size = max(n, PIECE + 4096)
        both = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(size, b, dtype=np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        del _tables[1:]
        _tables.append(tuple(both))
    return _tables[1]


def _hashed(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, start places) of the words of a lower-cased text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = _table()[points]
    inside = np.zeros(len(code) + 2, dtype=np.int8)
    inside[1:-1] = code != 0
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    power, inverse = _powers(len(code) + 1)
    total = np.zeros(len(code) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(code * power[:len(code)], out=total[1:])
        return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64)), start


def _pieces(text: str) -> Iterator[str]:
    """Pieces of about PIECE characters, cut at blanks."""
    lo = 0
    while len(text) - lo > PIECE:
        cut = max(text.rfind(c, lo, lo + PIECE) for c in " \n")
        if cut <= lo:
            cut = min((i for i in (text.find(c, lo + PIECE) for c in " \n") if i >= 0), default=len(text))
        yield text[lo:cut]
        lo = cut
    yield text[lo:]


def word_hashes(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, hashes end to end, number of words of each row) for
    runs of rows that together have about PIECE characters."""
    lo = 0
    while lo < len(texts):
        group, chars = [], 0
        while lo + len(group) < len(texts) and (not group or chars + len(texts[lo + len(group)] or "") <= PIECE):
            group.append((texts[lo + len(group)] or "").lower())
            chars += len(group[-1]) + 1
        if len(group) == 1 and chars > PIECE:
            parts = [_hashed(p)[0] for p in _pieces(group[0])]
            flat = np.concatenate(parts)
            sizes = np.array([len(flat)], dtype=np.int64)
        else:
            flat, start = _hashed("\n".join(group))
            ends = np.cumsum([len(t) + 1 for t in group])
            sizes = np.diff(np.searchsorted(start, ends), prepend=0).astype(np.int64)
        yield lo, lo + len(group), flat, sizes
        lo += len(group)
