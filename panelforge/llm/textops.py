"""Vectorised word, character and shingle hashing over Arrow string arrays.

A batch of texts is one UTF-8 byte buffer plus offsets. Words are maximal runs of bytes outside
``\\x20\\x09-\\x0D``. Hashes of arbitrary spans come from one prefix sum of a polynomial over the
buffer, so no per-word Python runs. Hashes are 64 bits wide and the same on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_R = 0x9E3779B97F4A7C1B  # odd, 3 modulo 8
_R_INV = pow(_R, -1, 2**64)
_rng = np.random.default_rng(20240229)
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
WINDOW_FACTORS = _rng.integers(1, 2**63, 16, dtype=np.uint64) * U64(2) + U64(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUATION = np.zeros(256, bool)
CONTINUATION[0x80:0xC0] = True

_powers = {"n": 0, "up": np.ones(1, U64), "down": np.ones(1, U64)}


_libc = ctypes.CDLL(None)
_caches: dict[str, Callable[[], None]] = {}


def own_cache(name: str, clear: Callable[[], None]) -> None:
    """Announce a table that this Python worker keeps between tasks."""
    _caches[name] = clear


def tidy(keep: str | None = None) -> None:
    """End of a batch: give freed memory back to the system, and drop the tables that other operators
    have left in this worker (all but ``keep``). Workers outlive stages, and what they hold adds up."""
    for name, clear in _caches.items():
        if name != keep:
            clear()
    pa.default_memory_pool().release_unused()
    getattr(_libc, "malloc_trim", int)(0)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (new array)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        made = {"n": max(n, 1 << 20)}
        for key, base in (("up", _R), ("down", _R_INV)):
            steps = np.full(made["n"], base, U64)
            steps[0] = 1
            made[key] = np.cumprod(steps)
        if n > 1 << 21:  # for this very long text alone
            return made["up"], made["down"]
        _powers.update(made)
    return _powers["up"], _powers["down"]


own_cache("powers", lambda: _powers.update(n=0, up=np.ones(1, U64), down=np.ones(1, U64)))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty text."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def pieces(texts: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``max_bytes`` (always whole texts): (first row, last row, bytes, offsets)."""
    data, offsets = buffers(texts)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + max_bytes, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums that ``span_hash`` turns into hashes of spans."""
    up, _ = _power_tables(len(data))
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end); equal bytes give equal hashes wherever they stand."""
    _, down = _power_tables(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and the first word of each text (and the end)."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = offsets[:-1][offsets[:-1] < len(data)]
    begin[at] = inside[at]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] = inside[at]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` items inside each text: (hashes, first run of each text)."""
    n = len(hashes)
    counts = np.diff(first)
    runs = np.maximum(counts - k + 1, 0)
    out_first = np.concatenate([[0], np.cumsum(runs)])
    if out_first[-1] == 0:
        return np.zeros(0, U64), out_first
    acc = hashes[: n - k + 1] * WINDOW_FACTORS[0]
    for j in range(1, k):
        acc += hashes[j : n - k + 1 + j] * WINDOW_FACTORS[j]
    start = np.repeat(first[:-1] - out_first[:-1], runs) + np.arange(out_first[-1])
    return mix(acc[start] + U64(k)), out_first


def shingle_sets(texts: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """For each text, its sorted distinct ``k``-word shingles as 64-bit hashes.

    A-Z are lower-cased. A text with fewer than ``k`` words has its whole word sequence as the
    only shingle; a text without words (or null) has none.
    """
    for _, _, data, offsets in pieces(texts):
        data = LOWER[data]
        starts, ends, first = words(data, offsets)
        h = span_hash(prefix_hash(data), starts, ends)
        runs, run_first = windows(h, first, k)
        counts = np.diff(first)
        for i in range(len(counts)):
            m = counts[i]
            if m >= k:
                s = np.sort(runs[run_first[i] : run_first[i + 1]])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
            elif m > 0:
                acc = (h[first[i] : first[i + 1]] * WINDOW_FACTORS[:m]).sum(dtype=U64)
                yield mix(np.array([acc], U64) + U64(m))
            else:
                yield np.zeros(0, U64)
