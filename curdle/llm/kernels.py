"""Vectorised numpy kernels over the Arrow string buffers that Spark hands to a task.

All functions work on one *slice* of documents: a ``uint8`` array with the
concatenated UTF-8 texts and an ``offsets`` array (documents + 1). Hashes are
polynomials modulo 2^64 taken from running sums, so every window of words costs
the same whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: ASCII white space that separates words: space and \t \n \v \f \r.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes of text worked on at once; a longer document is a slice of its own.
SLICE_BYTES = 1 << 18

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(x) | 1 for x in _rng.integers(2**40, 2**63, 4, dtype=np.uint64)]
_INVERSES = [pow(b, -1, 2**64) for b in _BASES]
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power_table(base: int, inverse: bool, n: int) -> np.ndarray:
    have = _powers.get((base, inverse))
    if have is None or len(have) < n:
        size = max(SLICE_BYTES + 1, n)
        step = np.full(size, (_INVERSES if inverse else _BASES)[base], dtype=np.uint64)
        step[0] = 1
        table = np.multiply.accumulate(step)
        if size > 4 * SLICE_BYTES:
            return table
        _powers[base, inverse] = have = table
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seed(n: int) -> np.uint64:
    """The ``n``-th constant for independent re-hashing."""
    return mix(np.array([n * 0x9E3779B97F4A7C15 % 2**64], dtype=np.uint64))[0]


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch's text column into slices (first row, last row, bytes, offsets); a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, row + 1), len(column))
        yield row, last, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` that do not cross a document border."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    return (
        np.flatnonzero(inside & (~before | border[:n])),
        np.flatnonzero(inside & (~after | border[1:])) + 1,
    )


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0) -> np.ndarray:
    """64-bit hash of each byte span."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[data] * _power_table(base, False, len(data))[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * _power_table(base, True, len(data) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of every document: starts, ends, hashes, and the first word of each document (documents + 1)."""
    starts, ends = runs(~SEPARATOR[data], offsets)
    return starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def window_hashes(symbols: np.ndarray, n: int, base: int = 1) -> np.ndarray:
    """Hash of every ``n`` consecutive symbols (windows over document borders included; mask them with ``whole``)."""
    count = len(symbols) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum(symbols * _power_table(base, False, len(symbols))[: len(symbols)], out=total[1:])
    return mix((total[n:] - total[:count]) * _power_table(base, True, len(symbols))[:count])


def whole(n_windows: int, n: int, first: np.ndarray) -> np.ndarray:
    """True for the windows of ``n`` symbols that lie in one document (or line); ``first`` are its borders."""
    if n_windows <= 0:
        return np.zeros(0, dtype=bool)
    end = np.repeat(first[1:], np.diff(first))[:n_windows]
    return np.arange(n_windows) + n <= end


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of each ``n``-word shingle; an owner with 1 to n - 1 words has its whole word sequence as the one shingle."""
    owner_of_word = np.repeat(np.arange(len(first) - 1), np.diff(first))
    h = window_hashes(hashes, n)
    good = whole(len(h), n, first)
    owner, value = owner_of_word[: len(h)][good], h[good]
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for i in range(n - 1):
            has = count[short] > i
            extra[has] = mix(extra[has] * np.uint64(_BASES[2]) + hashes[first[short[has]] + i] + seed(n))
        owner, value = np.concatenate([owner, short]), np.concatenate([value, extra])
        order = np.argsort(owner, kind="stable")
        owner, value = owner[order], value[order]
    return owner, value


def distinct(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, value) pairs, sorted."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    keep = np.ones(len(owner), dtype=bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[keep], value[keep]


def as_long(x: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def list_of_long(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """An Arrow list column from flat values and a length for each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).view(np.int64)))
