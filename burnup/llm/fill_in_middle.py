"""Fill-in-the-middle transformation with a learned index of code point boundaries (operator 13).

A text of n code points is cut at two code points drawn from a hash of its id, and its pieces are written
as prefix, suffix, middle (psm), as suffix, prefix, middle (spm), or left as they were (plain).

Index. A code point's place in the UTF-8 bytes is learned, not searched: over all boundary offsets of a chunk of texts,
rank to offset, a piecewise linear function is fitted whose error is ``ERROR`` bytes at most. Pieces start
as the chunk's texts (cut at blocks of ``BLOCK_BYTES``); a piece over the error is halved, all such pieces at
once, until none is. Each boundary's residual is stored in a signed byte. A cut is predicted by its piece and
corrected by its residual, which makes it exact. A text of ASCII is one piece without error.

Distribution. Map only: nothing is shuffled, gathered or broadcast, and a chunk's index lives as long as the chunk.

Defined cases: a null text is empty; empty texts and texts that hold one of the marks are plain; cuts may fall
together, and at either end; a row without doc_id is hashed as the empty id; rows that repeat id and text get equal results;
texts of any length are one row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnup.llm.columns import chunks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ERROR = 127
BLOCK_BYTES = 1 << 20


class BoundaryIndex:
    """Byte offsets of all code point boundaries of ``buf``, by rank; its end is the last one.

    ``bounds`` are offsets of code points at which pieces start: ``ranks`` are theirs.
    """

    def __init__(self, buf: np.ndarray, bounds: np.ndarray, error: int = ERROR, block: int = BLOCK_BYTES):
        if not 0 < error <= 127:
            raise ValueError("residuals are stored in a signed byte")
        self.error = error
        self.ranks = np.zeros(len(bounds), np.int64)
        pieces, residuals, n = [], [], 0
        for a in range(0, len(buf) + 1, block):
            b = min(a + block, len(buf))
            offsets = a + np.flatnonzero((buf[a:b] & 0xC0) != 0x80)
            if a + block > len(buf):
                offsets = np.append(offsets, len(buf))
            own = slice(*np.searchsorted(bounds, [a, a + block]))
            self.ranks[own] = n + np.searchsorted(offsets, bounds[own])
            if len(offsets):
                fitted, residual = self._fit(offsets, np.unique(np.append(self.ranks[own] - n, 0)))
                pieces.append((fitted[0] + n, *fitted[1:]))
                residuals.append(residual)
                n += len(offsets)
        self.first, self.offset, self.slope = (np.concatenate(x) for x in zip(*pieces, strict=True))
        self.residual = np.concatenate(residuals)

    def _fit(self, y: np.ndarray, cuts: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
        """Pieces (first rank, its offset, slope) of the ranks of one block, and all residuals."""
        lo, hi = cuts, np.append(cuts[1:], len(y))
        residual = np.zeros(len(y), np.int8)
        done = []
        while len(lo):
            slope = (y[hi - 1] - y[lo]) / np.maximum(hi - 1 - lo, 1)
            size = hi - lo
            start = np.cumsum(size) - size
            step = np.arange(int(size.sum())) - np.repeat(start, size)
            rank = step + np.repeat(lo, size)
            off = y[rank] - _line(np.repeat(y[lo], size), np.repeat(slope, size), step)
            worst = np.maximum.reduceat(np.abs(off), start)
            good = worst <= self.error  # one boundary or two always are
            held = np.repeat(good, size)
            residual[rank[held]] = off[held]
            done.append((lo[good], y[lo[good]], slope[good]))
            lo, hi = lo[~good], hi[~good]
            half = (lo + hi) // 2
            lo, hi = np.ravel(np.column_stack([lo, half])), np.ravel(np.column_stack([half, hi]))
        first, offset, slope = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(first)
        return (first[order], offset[order], slope[order]), residual

    def predict(self, rank: np.ndarray) -> np.ndarray:
        piece = np.searchsorted(self.first, rank, "right") - 1
        return _line(self.offset[piece], self.slope[piece], rank - self.first[piece])

    def offsets(self, rank: np.ndarray) -> np.ndarray:
        return self.predict(rank) + self.residual[rank]


def _line(offset: np.ndarray, slope: np.ndarray, step: np.ndarray) -> np.ndarray:
    return offset + np.rint(slope * step).astype(np.int64)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """h1 to h4 of a document."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i: i + 8], 16) for i in range(0, 32, 8)]


OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _transform(seed: int, rate: int, spm: int, error: int):
    marks = p, s, m = tuple(x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, bounds in chunks(batch["text"], end=b""):
                index = BoundaryIndex(buf, bounds, error)
                n = np.diff(index.ranks)
                ids = batch["doc_id"].slice(a, b - a)
                h = np.array([draws(x, seed) for x in ids.to_pylist()], np.int64).reshape(-1, 4)
                cut = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
                at = index.offsets(cut + index.ranks[:-1, None])
                raw = memoryview(buf)
                form, out = [], []
                for i, (x, y) in enumerate(at.tolist()):
                    text = bytes(raw[bounds[i]: bounds[i + 1]])
                    if not text or any(mark in text for mark in marks) or h[i, 2] % 100 >= rate:
                        form.append("plain")
                        out.append(text)
                        continue
                    prefix, middle, suffix = raw[bounds[i]: x], raw[x:y], raw[y: bounds[i + 1]]
                    form.append("spm" if h[i, 3] % 100 < spm else "psm")
                    out.append(b"".join((s, suffix, p, prefix, m, middle) if form[-1] == "spm" else (p, prefix, s, suffix, m, middle)))
                plain = np.array([x == "plain" for x in form], bool)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(form, pa.string()), pa.array(cut[:, 0], mask=plain), pa.array(cut[:, 1] - cut[:, 0], mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                                                 names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def transform(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, error: int = ERROR) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output per row; ``rate`` in 100 texts are transformed, ``spm`` in 100 of them as spm."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(_transform(seed, rate, spm, error), OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""
    head = F.length(F.lit(PREFIX))  # all marks are of one length
    one = F.call_function("substring_index", output, F.when(form == "spm", F.lit(PREFIX)).otherwise(F.lit(SUFFIX)), F.lit(1))
    rest = F.substr(output, F.length(one) + head + 1)
    two = F.substring_index(rest, MIDDLE, 1)
    middle = F.substr(rest, F.length(two) + head + 1)
    one = F.substr(one, head + 1)
    whole = F.when(form == "spm", F.concat(two, middle, one)).otherwise(F.concat(one, middle, two))
    return F.when(form == "plain", output).otherwise(whole)
