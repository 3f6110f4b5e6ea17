"""Words, word hashes and n-gram sets of a batch of texts, computed on the UTF-8 bytes with numpy."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes hashed at once

_RNG = np.random.default_rng(20240917)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
#: A random odd 64-bit value for each byte; A-Z share those of a-z.
_VALUE = (_RNG.integers(0, 2**63, 256, dtype=np.uint64) * 2 + 1)[_FOLD]
_BASE = int(_RNG.integers(0, 2**61, dtype=np.uint64)) * 8 + 5
STEPS = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * 2 + 1

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of a word between ASCII white space.
NOT_SPACE = ~SPACE
#: Bytes of a word of ASCII letters, digits and anything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        table = np.full(max(n, CHUNK + 1), base, dtype=np.uint64)
        table[0] = 1
        _powers[name] = np.multiply.accumulate(table)
    return _powers[name][:n]


def release() -> None:
    """Give memory that a finished task has used back to the system; the Python worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads each bit over all."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    rows = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), rows


def slices(rows: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer row stands alone."""
    a, n = 0, len(rows) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(rows, rows[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = b


def _cuts(data: np.ndarray, start: int, end: int, inside: np.ndarray, row_starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Chunks of about ``CHUNK`` bytes that cut no word."""
    while start < end:
        stop = start + CHUNK
        if stop >= end:
            yield start, end
            return
        while True:
            gaps = np.flatnonzero(~inside[data[start:stop]])
            last = int(row_starts[np.searchsorted(row_starts, stop, "right") - 1])
            cut = max(start + int(gaps[-1]) if len(gaps) else start, last)
            if cut > start or stop >= end:
                break
            stop = min(end, stop + CHUNK)
        yield start, cut if cut > start else end
        start = cut if cut > start else end


def words(data: np.ndarray, rows: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of ``inside`` bytes, A-Z lower-cased) and their n + 1 offsets by row."""
    n = len(rows) - 1
    found, counts = [], np.zeros(n, np.int64)
    inverse = pow(_BASE, -1, 2**64)
    for a, b in _cuts(data, int(rows[0]), int(rows[-1]), inside, rows):
        part = data[a:b]
        value = np.cumsum(_VALUE[part] * _power("up", _BASE, b - a), dtype=np.uint64)
        value = np.concatenate((np.zeros(1, np.uint64), value))
        word = inside[part]
        first = word.copy()
        first[1:] &= ~word[:-1]
        begins = rows[np.searchsorted(rows, a) : np.searchsorted(rows, b)] - a
        first[begins] = word[begins]
        starts = np.flatnonzero(first)
        last = word.copy()
        last[:-1] &= ~word[1:]
        begins = begins[begins > 0] - 1
        last[begins] = word[begins]
        ends = np.flatnonzero(last) + 1
        found.append(mix((value[ends] - value[starts]) * _power("down", inverse, b - a + 1)[starts]))
        counts += np.bincount(np.searchsorted(rows, starts + a, "right") - 1, minlength=n)[:n]
    return np.concatenate(found) if found else np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum(counts)))


def ngrams(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` following words of a row, and each one's row; a row of fewer words has one of them all."""
    counts = np.diff(offsets)
    row = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes) - width + 1
    parts, of = [], []
    if n > 0:
        whole = row[:n] == row[width - 1 :]
        total = np.zeros(n, np.uint64)
        for k in range(width):
            total += hashes[k : k + n] * STEPS[k]
        parts.append(mix(total[whole]))
        of.append(row[:n][whole])
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        total = counts[short].astype(np.uint64) * STEPS[63]
        for k in range(width - 1):
            there = counts[short] > k
            total[there] += hashes[offsets[short][there] + k] * STEPS[k]
        parts.append(mix(total))
        of.append(short)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(of)


def ngram_sets(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each row, sorted by hash, and their n + 1 offsets by row."""
    grams, row = ngrams(hashes, offsets, width)
    order = None
    if len(offsets) <= 1 << 16:  # one sort of row and hash; its 48 bits of the hash nearly always tell all apart
        key = (row.astype(np.uint64) << np.uint64(48)) | (grams >> np.uint64(16))
        order = np.argsort(key)
        key, tried = key[order], grams[order]
        if np.any((key[1:] == key[:-1]) & (tried[1:] != tried[:-1])):
            order = None
    if order is None:
        order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[new], row[new]
    return grams, np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(offsets) - 1))))


def set_ids(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit id of each row's set, the same for equal sets; 0 for an empty one."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams ^ STEPS[62]), dtype=np.uint64)))
    size = np.diff(offsets).astype(np.uint64)
    return np.where(size > 0, mix((sums[offsets[1:]] - sums[offsets[:-1]]) + size * STEPS[61]), np.uint64(0))


def split_by(shard: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """The parts of parallel arrays for each shard number."""
    order = np.argsort(shard, kind="stable")
    ids, starts = np.unique(shard[order], return_index=True)
    arrays = tuple(x[order] for x in arrays)
    for k, a, b in zip(ids, starts, np.append(starts, len(order))[1:], strict=True):
        yield int(k), tuple(x[a:b] for x in arrays)
