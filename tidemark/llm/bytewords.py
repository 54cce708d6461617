"""Words of whole Arrow batches, found and hashed as UTF-8 bytes with numpy.

All separators here are ASCII, so a text is cut at the same places whether one
looks at its bytes or its code points, and no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tidemark.llm.wordhash import mix

BLOCK = 1 << 20  # bytes hashed at once
STEP = 1 << 18   # words handled at once where that saves memory
END = 10         # the byte put behind every row: a line feed, always a separator

# Two bases, for two fingerprints that know nothing of each other.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def byte_set(chars: bytes) -> np.ndarray:
    """Which byte values are in ``chars``."""
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


@lru_cache(maxsize=8)
def _powers(size: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
        x = np.full(size, b, dtype=np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of a base and of its inverse modulo 2^64."""
    return _powers(1 << max(12, int(n).bit_length()), which)


class Rows:
    """Rows of one chunk: ``buf`` holds their texts, each followed by END,
    and 8 more of these, so that 8 bytes can be read from any place on;
    ``first`` is the place of each row's first byte, ``columns`` the other
    columns as Arrow arrays."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, list[pa.Array]]]):
        sizes = np.concatenate([p[1] for p in parts])
        last = np.cumsum(sizes + 1) - 1
        self.first = last - sizes
        self.buf = np.full(int(last[-1]) + 9 if len(last) else 8, END, dtype=np.uint8)
        at = 0
        for data, size, _ in parts:
            stop = at + len(data) + len(size)
            inner = np.ones(stop - at, dtype=bool)
            inner[np.cumsum(size + 1) - 1] = False
            self.buf[at:stop][inner] = data
            at = stop
        self.columns = [pa.chunked_array(c).combine_chunks() for c in zip(*(p[2] for p in parts))]

    def __len__(self) -> int:
        return len(self.first)

    def row_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1


def _bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values end to end, their sizes); NULL is empty."""
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, dtype=kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, np.diff(at)


def chunks(batches: Iterator[pa.RecordBatch], limit: int, text: int = 0) -> Iterator[Rows]:
    """Consecutive rows with at most ``limit`` bytes of text together (one
    longer text is a chunk of its own).  ``text`` is the text's column."""
    parts, have = [], 0
    for b in batches:
        lo = 0
        raw, sizes = _bytes(b.column(text)) if b.num_rows else (None, np.zeros(0, np.int64))
        to = np.cumsum(sizes + 1)
        while lo < b.num_rows:
            done = int(to[lo - 1]) if lo else 0
            hi = int(np.searchsorted(to, done + limit - have, side="right"))
            if hi <= lo and not parts:
                hi = lo + 1
            if hi > lo:
                a, z = done - lo, int(to[hi - 1]) - hi
                others = [b.column(i).slice(lo, hi - lo) for i in range(b.num_columns) if i != text]
                parts.append((raw[a:z], sizes[lo:hi], others))
                have += int(to[hi - 1]) - done
                lo = hi
            if lo < b.num_rows or have >= limit:
                yield Rows(parts)
                parts, have = [], 0
    if parts:
        yield Rows(parts)


def words(buf: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the maximal runs of bytes outside ``apart``;
    the last byte of ``buf`` must be in it."""
    inside = np.zeros(len(buf) + 1, dtype=np.int8)
    inside[1:] = ~apart[buf]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    del inside, step
    return starts, ends, hashed(buf, starts, ends)


def hashed(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """The words' hashes: polynomials in the scrambled bytes modulo 2^64,
    from differences of one running sum; ``which`` of two fingerprints."""
    hashes = np.empty(len(starts), dtype=np.uint64)
    code = mix(np.arange(1 + 256 * which, 257 + 256 * which, dtype=np.uint64)) | np.uint64(1)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(starts):
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK, side="right")))
            a, z = int(starts[lo]), int(ends[hi - 1])
            power, inverse = powers(z - a + 1, which)
            total = np.zeros(z - a + 1, dtype=np.uint64)
            np.cumsum(code[buf[a:z]] * power[:z - a], out=total[1:])
            s, e = starts[lo:hi] - a, ends[lo:hi] - a
            hashes[lo:hi] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
            lo = hi
    return hashes


def ngrams(hashes: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Fingerprints of the n words from each place on, from prefix
    polynomials of the word hashes; there are len - n + 1."""
    count = max(0, len(hashes) - n + 1)
    out = np.empty(count, dtype=np.uint64)
    power, inverse = powers(min(STEP, count) + n, which)
    total = np.zeros(min(STEP, count) + n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for lo in range(0, count, STEP):
            hi = min(lo + STEP, count)
            part = hashes[lo:hi + n - 1]
            np.cumsum(part * power[:len(part)], out=total[1:len(part) + 1])
            out[lo:hi] = mix((total[n:hi - lo + n] - total[:hi - lo]) * inverse[:hi - lo] + np.uint64(n))
    return out


def same_bytes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and words b (numbers of words) are equal byte by byte."""
    x, y, size = starts[a], starts[b], ends[a] - starts[a]
    equal = size == ends[b] - y
    todo = np.flatnonzero(equal & (x != y))
    eight = np.ndarray((len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))  # 8 bytes from each place on
    for at in range(0, 64, 8):
        if not len(todo):
            return equal
        left = size[todo] - at
        todo, left = todo[left > 0], left[left > 0]
        shift = (np.maximum(0, 8 - left) * 8).astype(np.uint64)
        unlike = ((eight[x[todo] + at] ^ eight[y[todo] + at]) << shift) != 0
        equal[todo[unlike]] = False
        todo = todo[~unlike]
    for i in todo[size[todo] > 64]:
        equal[i] = bool(np.array_equal(buf[x[i]:x[i] + size[i]], buf[y[i]:y[i] + size[i]]))
    return equal


def groups(hashes: np.ndarray, same) -> np.ndarray:
    """For each element the number of one element equal to it, the same for
    all equal ones.  Elements of one hash are compared by ``same(a, b)``;
    those that differ from their group's first go round again."""
    lead = np.arange(len(hashes), dtype=np.int32 if len(hashes) < 1 << 31 else np.int64)
    rest = None
    while rest is None or len(rest):
        order = np.argsort(hashes if rest is None else hashes[rest], kind="stable").astype(lead.dtype)
        order = order if rest is None else rest[order]
        h = hashes[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        del h
        at = np.flatnonzero(new).astype(lead.dtype)
        first = order[np.repeat(at, np.diff(np.append(at, len(order))))]
        ok = np.empty(len(order), dtype=bool)
        for lo in range(0, len(order), STEP):
            ok[lo:lo + STEP] = same(order[lo:lo + STEP], first[lo:lo + STEP])
        lead[order[ok]] = first[ok]
        rest = np.sort(order[~ok])
    return lead


def least_places(x: np.ndarray, w: int) -> np.ndarray:
    """For each place the leftmost least of the w values from there on."""
    at, have = np.arange(len(x)), 1
    while have < w:
        step = min(have, w - have)
        one, two = at[:-step], at[step:]
        at = np.where(x[one] <= x[two], one, two)
        have += step
    return at
