"""Vectorised byte and word kernels over Arrow batches, used inside mapInArrow functions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of a very long text that a kernel works on at a time.
WINDOW = 1 << 20
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, n at least of each."""
    if "up" not in _powers or len(_powers["up"]) < n:
        m = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(m, base, U)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser: every bit of the result depends on every bit of h."""
    h = h ^ (h >> U(33))
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """len + 1 sums; span_hash() takes any substring's hash from them."""
    up, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, U)
    np.cumsum((buf.astype(U) + U(1)) * up[: len(buf)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [start, stop), equal for equal bytes wherever they lie."""
    _, down = powers(len(sums))
    return mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(U))


def raw_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column (null: empty), without decoding."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    else:
        col = col.cast(pa.large_binary()).fill_null(b"")
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offs


def slices(col: pa.Array, most: int = 1 << 20, rows: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of at most `rows` rows and about `most` bytes (a longer text is a run of its own): first row, last row + 1, bytes, offsets from 0."""
    buf, offs = raw_column(col)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        j = min(j, n, i + rows)
        yield i, j, buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def stretches(col: pa.Array, most: int, reach: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int, int]]:
    """As slices(), but a text of more than 4 * WINDOW bytes comes in stretches: also the byte of its text that a stretch begins at,
    and how many positions are the stretch's own; the `reach` bytes behind them come along."""
    for i, j, buf, offs in slices(col, most):
        if j - i > 1 or len(buf) <= 4 * WINDOW:
            yield i, j, buf, offs, 0, len(buf)
            continue
        for a in range(0, len(buf), WINDOW):
            part = buf[a : a + WINDOW + reach]
            yield i, j, part, np.array([0, len(part)]), a, min(WINDOW, len(buf) - a)


def word_hashes(buf: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hashes of one text's words, its bytes taken through `table` first: those of span_hash(), but WINDOW bytes at a time."""
    out, open_sum, open_len = [], 0, 0
    for a in range(0, len(buf), WINDOW):
        part = table[buf[a : a + WINDOW]]
        starts, ends, _ = words(part, np.array([0, len(part)]))
        if not len(starts):
            starts = ends = np.zeros(0, np.int64)
        sums = prefix_hash(part)
        raw, n = (sums[ends] - sums[starts]) * powers(len(sums))[1][starts], (ends - starts).astype(U)
        if open_len and len(starts) and starts[0] == 0:
            raw[:1] = raw[:1] * U(pow(_BASE, open_len, 1 << 64)) + U(open_sum)
            n[:1] += U(open_len)
        elif open_len:
            raw, n = np.append(U(open_sum), raw), np.append(U(open_len), n)
        open_len = 0
        if len(ends) and ends[-1] == len(part):
            open_sum, open_len, raw, n = int(raw[-1]), int(n[-1]), raw[:-1], n[:-1]
        out.append(mix(raw + n))
    if open_len:
        out.append(mix(np.array([open_sum], U) + U(open_len)))
    return np.concatenate(out) if out else np.zeros(0, U)


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of anything but ASCII white space, and each document's first word."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    ink = ~SPACE[buf]
    before = np.empty(len(buf), bool)
    before[0] = False
    before[1:] = ink[:-1]
    inner = offs[:-1][offs[:-1] < len(buf)]
    before[inner] = False
    after = np.empty(len(buf), bool)
    after[-1] = False
    after[:-1] = ink[1:]
    after[offs[1:][offs[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def shingles(buf: np.ndarray, offs: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `size` lower-cased words, in order, and each document's first one.

    A document with fewer words has its whole sequence as one; one without words has none.
    """
    if len(offs) == 2 and len(buf) > 4 * WINDOW:
        w = word_hashes(buf, LOWER)
        first = np.array([0, len(w)])
    else:
        low = LOWER[buf]
        starts, ends, first = words(low, offs)
        w = span_hash(prefix_hash(low), starts, ends)
    n_words = np.diff(first)
    count = np.where(n_words == 0, 0, np.maximum(1, n_words - size + 1))
    at = np.zeros(len(offs), np.int64)
    np.cumsum(count, out=at[1:])
    if len(offs) == 2 and count[0] > WINDOW:
        lots = [(i, min(i + WINDOW, count[0])) for i in range(0, count[0], WINDOW)]
        return np.concatenate([_runs(w[i : j + size - 1], np.arange(j - i), np.full(j - i, size)) for i, j in lots]), at
    return _runs(w, np.repeat(first[:-1] - at[:-1], count) + np.arange(at[-1]), np.repeat(np.minimum(n_words, size), count)), at


def _runs(w: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hashes of the runs of `length` word hashes from `begin` on."""
    out = np.zeros(len(begin), U)
    for k in range(int(length.max()) if len(length) else 0):
        out = out * U(0xD6E8FEB86659FD93) + np.where(k < length, w[np.minimum(begin + k, len(w) - 1)], U(0))
    return mix(out + length.astype(U))


def sets(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each document, sorted, and where each document's begin."""
    parts = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    out = np.zeros(len(at), np.int64)
    np.cumsum([len(p) for p in parts], out=out[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, U)), out


def nested(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values, kind))
