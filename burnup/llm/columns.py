"""Whole columns of text as numpy arrays: chunks of a text column, token bounds and token hashes.

Texts are handled a chunk of rows at a time (``CHUNK_BYTES`` of text; one longer text is a chunk of
its own), so a task's memory does not depend on the size of its partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh64_intdigest

CHUNK_BYTES = 1 << 21
#: Bytes of a span that is hashed by itself.
LONG_SPAN = 32
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Odd multipliers of the hashes below (2^64 over the golden ratio, and splitmix64's two).
GOLD, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


BYTE_CODE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * GOLD)


def slices(lengths: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths sum to ``most`` at most, or of one row."""
    at, ends = 0, np.cumsum(lengths)
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, to
        at = to


def byte_lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def buffer(column: pa.Array, end: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each followed by ``end`` (one byte), and where each text starts (and a last bound)."""
    raw = pc.fill_null(column.cast(pa.large_binary()), b"")
    raw = pc.binary_join_element_wise(raw, pa.scalar(b"", pa.large_binary()), pa.scalar(end, pa.large_binary()))
    _, bounds, data = raw.buffers()
    at = np.frombuffer(bounds, np.int64)[raw.offset: raw.offset + len(raw) + 1]
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data is not None and len(raw) else np.zeros(0, np.uint8), at - at[0]


def chunks(column: pa.Array, end: bytes = b" ", most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for a, b in slices(byte_lengths(column), most):
        yield a, b, *buffer(column.slice(a, b - a), end)


def token_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space; ``buf`` ends with white space."""
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[1:] = ~IS_SPACE[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def per_row(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many tokens start in each row."""
    return np.diff(np.searchsorted(starts, bounds))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = int(GOLD), pow(int(GOLD), -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.ones(1, np.uint64)
        while len(p) < n:
            p = np.concatenate([p, p * np.uint64(pow(b, len(p), 1 << 64))])
        out.append(p[:n])
    return out[0], out[1]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: equal bytes, equal hash (polynomial in 2^64, then mixed)."""
    power, inverse = _powers(1 << max(16, int(len(buf)).bit_length()))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_CODE[buf] * power[: len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: ``span_hashes`` of short spans, XXH64 of spans over ``LONG_SPAN`` bytes.

    Long texts of a regular kind (Thue-Morse strings) are equal as polynomials modulo 2^64, whatever the base.
    """
    out = span_hashes(buf, starts, ends)
    for i in np.flatnonzero(ends - starts > LONG_SPAN).tolist():
        out[i] = xxh64_intdigest(buf[starts[i]: ends[i]].tobytes(), 7)
    return out


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of the given lengths: the run of each element, and its place in the run."""
    run = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return run, np.arange(len(run)) - first[run]


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """(key, rows) of batches that are sorted by an integer column; one key's rows at a time are held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(batch)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if held and keys[a] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield last, pa.Table.from_batches(held)
