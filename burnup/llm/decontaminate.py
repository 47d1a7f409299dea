"""Benchmark decontamination by SimHash of item-sized windows (operator 8).

For each benchmark item every window of as many words in every text is compared, in three steps.

1. Windows that hold no shingle of the item cannot be similar to it and are left out at once (this
   loses nothing: their similarity is zero).
2. The windows' and items' SimHash fingerprints (64 bits, over ``SHINGLE``-word shingles with
   repeats) go through a multi-index: the fingerprint is cut into ``BLOCKS`` blocks; two fingerprints
   within ``RADIUS`` bits have a block that differs in at most RADIUS // BLOCKS bits (pigeonhole), so
   looking up all such variations of each block finds every item within the radius.
3. The weighted similarity of their shingles (each weighted by its number of occurrences: sum of
   the minima over the sum of the maxima) decides: ``SIMILARITY`` or more is a match.

A text with fewer words than the item is one window, its whole; if it has enough shingles of the item
it goes to step 3 at once.

Words are runs of letters and digits (any byte of a non-ASCII character counts as a letter) in lower
case. An item of fewer than five words is one shingle, its whole sequence. The benchmark is the
stated query set: it is indexed in blocks of ``BLOCK_ITEMS`` items, each of a bounded size on every
worker, and each block is held against all texts; texts are never shuffled.

Defined cases: null and empty texts and items without words match nothing; items with equal texts
all match; an empty benchmark matches nothing; repeated rows each get a result; a null item_id is
reported as null in the list; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnup.llm.base import row_schema
from burnup.llm.columns import MIX1, MIX2, chunks, mix, per_row, ragged, word_hashes

SHINGLE, SIMILARITY, RADIUS, BITS, BLOCKS = 5, 0.8, 20, 64, 8
#: Items of one index, on average.
BLOCK_ITEMS = 20_000
#: Windows fingerprinted at once.
WINDOWS = 1 << 12

WORD = np.zeros(256, bool)
WORD[128:] = True
WORD[[b for b in range(128) if chr(b).isalnum()]] = True


def words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per chunk of rows: hashes of all words in order, and how many each row has."""
    for a, b, buf, bounds in chunks(pc.utf8_lower(column.cast(pa.large_string()))):
        inside = np.zeros(len(buf) + 1, np.int8)
        inside[1:] = WORD[buf]
        step = np.diff(inside)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        yield a, b, word_hashes(buf, starts, ends), per_row(starts, bounds)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = out * MIX1 + hashes[i: i + n] * MIX2
        out ^= out >> np.uint64(29)
    return mix(out)


def simhash(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of shingle hashes (no run is empty): the bits set in over half."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, np.cumsum(counts) - counts, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two lists of shingle hashes; the weight is the number of occurrences."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[i], cb[j]).sum())
    return both / (len(a) + len(b) - both)


class Index:
    """Items of one shingle size: their shingles, fingerprints and the multi-index over blocks of bits."""

    def __init__(self, size: int, items: list[tuple[int | None, np.ndarray]]):
        self.size, self.ids, self.words = size, [i for i, _ in items], [w for _, w in items]
        self.length = np.array([len(w) for _, w in items])
        each = [shingles(w, size) for _, w in items]
        self.shingles = each
        n = np.array([len(x) for x in each])
        flat = np.concatenate(each)
        owner = np.repeat(np.arange(len(items)), n)
        pairs = np.unique(np.rec.fromarrays([flat, owner]))  # which items have each shingle
        self.known, first = np.unique(pairs.f0, return_index=True)
        self.owners, self.first = pairs.f1.copy(), np.append(first, len(pairs))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.prints = simhash(flat, n)
        wide = BITS // BLOCKS
        near = np.array([sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1) for c in combinations(range(wide), r)])
        self.tables = []  # per block: items listed under every variation of their bits there
        for t in range(BLOCKS):
            value = self.block(self.prints, t)
            keys = (value[:, None] ^ near[None, :]).ravel()
            who = np.repeat(np.arange(len(items)), len(near))
            by = np.argsort(keys, kind="stable")
            self.tables.append((who[by], np.searchsorted(keys[by], np.arange((1 << wide) + 1))))

    @staticmethod
    def block(prints: np.ndarray, t: int) -> np.ndarray:
        wide = BITS // BLOCKS
        return ((prints >> np.uint64(wide * t)) & np.uint64((1 << wide) - 1)).astype(np.int64)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, item) pairs at most RADIUS bits apart."""
        found = []
        for t, (who, bounds) in enumerate(self.tables):
            value = self.block(prints, t)
            run, i = ragged(bounds[value + 1] - bounds[value])
            item = who[bounds[value][run] + i]
            ok = np.bitwise_count(prints[run] ^ self.prints[item]) <= RADIUS
            found.append(run[ok] * len(self.ids) + item[ok])
        pair = np.unique(np.concatenate(found))
        return pair // len(self.ids), pair % len(self.ids)

    def matches(self, hashes: np.ndarray, n_words: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, item, first word in the row, differing bits, similarity) of each match in a chunk."""
        sh = shingles(hashes, self.size)
        place = np.flatnonzero(self.maybe[(sh & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.searchsorted(self.known, sh[place])
        ok = self.known[np.minimum(at, len(self.known) - 1)] == sh[place]
        place, at = place[ok], at[ok]
        end = np.cumsum(n_words)
        row = np.searchsorted(end, place, "right")
        ok = place + self.size <= end[row]  # not over a text's end
        place, at, row = place[ok], at[ok], row[ok]
        run, i = ragged(self.first[at + 1] - self.first[at])
        item = self.owners[self.first[at][run] + i]
        place, row = place[run], row[run]
        size = self.length[item]
        yield from self.short_matches(sh, n_words, row, item)
        lo = np.maximum(place + self.size - size, (end - n_words)[row])
        hi = np.minimum(place, end[row] - size)
        fits = lo <= hi
        lo, hi, size, row = lo[fits], hi[fits], size[fits], row[fits]
        # windows are sought per (start, size): the multi-index finds the items
        for a in range(0, len(lo), WINDOWS):
            run, i = ragged(hi[a: a + WINDOWS] - lo[a: a + WINDOWS] + 1)
            window = np.unique((lo[a: a + WINDOWS][run] + i) * (1 << 24) + size[a: a + WINDOWS][run])
            for b in range(0, len(window), WINDOWS):
                start, size_b = window[b: b + WINDOWS] >> 24, window[b: b + WINDOWS] & ((1 << 24) - 1)
                n = size_b - self.size + 1
                run, i = ragged(n)
                prints = simhash(sh[start[run] + i], n)
                for w, x in zip(*(p.tolist() for p in self.within(prints)), strict=True):
                    if self.length[x] != size_b[w]:
                        continue
                    s = similarity(sh[start[w]: start[w] + n[w]], self.shingles[x])
                    if s >= SIMILARITY:
                        r = int(np.searchsorted(end, start[w], "right"))
                        yield r, x, int(start[w] - (end[r] - n_words[r])), int(np.bitwise_count(prints[w] ^ self.prints[x])), s

    def short_matches(self, sh: np.ndarray, n_words: np.ndarray, row: np.ndarray, item: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """As ``matches``, of texts with fewer words than the item; ``row`` and ``item``: of each shingle they share."""
        short = n_words[row] < self.length[item]
        pair, shared = np.unique(row[short] * len(self.ids) + item[short], return_counts=True)
        pair = pair[shared / (self.length[pair % len(self.ids)] - self.size + 1) >= SIMILARITY]
        first = np.cumsum(n_words) - n_words
        for r, x in zip((pair // len(self.ids)).tolist(), (pair % len(self.ids)).tolist(), strict=True):
            window = sh[first[r]: first[r] + n_words[r] - self.size + 1]
            s = similarity(window, self.shingles[x])
            if s >= SIMILARITY:
                yield r, x, 0, int(np.bitwise_count(simhash(window, np.array([len(window)]))[0] ^ self.prints[x])), s


def indexes(ids: list[int | None], column: pa.Array) -> list[Index]:
    by_size: dict[int, list] = {}
    for a, _, hashes, n in words(column):
        for i, part in enumerate(np.split(hashes, np.cumsum(n)[:-1])):
            if len(part):
                by_size.setdefault(min(SHINGLE, len(part)), []).append((ids[a + i], part))
    return [Index(size, items) for size, items in sorted(by_size.items())]


MATCHES = "array<struct<item_id:bigint,first_word:bigint,bits:int,similarity:double>>"


def with_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` as a struct ``row`` with ``matches``: the best window for each item found."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text", F.expr(f"cast(array() as {MATCHES})").alias("matches"))
    schema = row_schema(out, f"text string, matches {MATCHES}")

    def matcher(shared):  # noqa: ANN001, ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = [Index(*x) for x in shared.value]
            for batch in batches:
                lists = batch["matches"].to_pylist()
                for a, _, hashes, n in words(batch["text"]):
                    for index in found:
                        best: dict[tuple[int, int], tuple] = {}
                        for r, x, first, bits, s in index.matches(hashes, n):
                            if (r, x) not in best or (s, -first) > (best[r, x][2], -best[r, x][0]):
                                best[r, x] = (first, bits, s)
                        for (r, x), (first, bits, s) in sorted(best.items()):
                            lists[a + r].append({"item_id": index.ids[x], "first_word": first, "bits": bits, "similarity": s})
                yield pa.RecordBatch.from_arrays([batch["row"], batch["text"], pa.array(lists, batch.schema.field("matches").type)], names=["row", "text", "matches"])

        return run

    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()  # BLOCK_ITEMS on average
        if part:
            made = indexes([x.item_id for x in part], pa.array([x.text for x in part], pa.string()))
            plain = [(x.size, list(zip(x.ids, x.words, strict=True))) for x in made]
            out = out.mapInArrow(matcher(spark.sparkContext.broadcast(plain)), schema)
    return out.select("row", "matches")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (in order), similarity (of the best match, else null)."""
    out = with_matches(docs.select("doc_id", "text"), benchmark)
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), (F.size("matches") > 0).alias("contaminated"), F.size("matches").cast("long").alias("n_items"),
                      F.array_sort(F.transform("matches", lambda x: x["item_id"])).alias("item_ids"), F.array_max(F.transform("matches", lambda x: x["similarity"])).alias("similarity"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that match no benchmark item; all columns."""
    out = with_matches(docs, benchmark).where(F.size("matches") == 0)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
