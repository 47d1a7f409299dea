"""SimHash near-duplicates by a self-join of binary tries (operator 3).

Fingerprint: words are the runs without white space of the text with A-Z lower-cased; shingles are
``words`` words joined by one space, repeats included (a shorter text: its whole sequence). A bit is
set if it is set in over half of the shingles' XXH64 values (seed 42). No words: fingerprint zero,
linked like any other. Fingerprints within ``radius`` differing bits are linked.

The self-join runs over distinct fingerprints: copies, however many, are one row. A trie of all
fingerprints is too much for a task, so it is cut: fingerprints within ``radius`` bits agree on at
least one of ``radius`` + 1 blocks of bits (pigeonhole). For each block the fingerprints are rotated
to have it on top; the subtries below equal tops are tasks' work. A subtrie that holds more than
``HOT_ROWS`` fingerprints is cut once more, by the same rule over the rest of its bits. In a subtrie
node pairs are walked from (root, root) downwards, a level at a time: a pair's children either agree
in the next bit or add one differing bit, and a pair over the budget is dropped with all below it.
Links found in a subtrie are united there, so it returns a tree of links and never all pairs;
connected components over all subtries follow in Spark.

Defined cases: null text has no words; rows with a null doc_id are linked like others but name no
component (a component of such rows alone has a null id); repeated rows share a component; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from burnup.llm.base import connected_components, doc_key, stored, text_key, texts
from burnup.llm.columns import IS_SPACE, LOWER, chunks, per_row, token_bounds

WORDS, RADIUS, SEED, BITS = 3, 2, 42, 64
#: Fingerprints of one subtrie beyond which it is cut again.
HOT_ROWS = 200_000
#: Node pairs walked at once, and fingerprints held before whole subtries are walked.
FRONTIER, HELD = 1 << 18, 1 << 20


def fingerprints(column: pa.Array, words: int = WORDS) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text."""
    out = np.zeros(len(column), np.uint64)
    for a, b, buf, bounds in chunks(column):
        space = IS_SPACE[buf]
        keep = ~space
        keep[1:] |= ~space[:-1]  # one space after each word
        norm = np.where(space, np.uint8(32), LOWER[buf])[keep]
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
        starts, ends = token_bounds(norm)
        n_words = per_row(starts, bounds)
        n = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
        first_word = np.cumsum(n_words) - n_words
        row = np.repeat(np.arange(b - a), n)
        first_shingle = np.cumsum(n) - n
        w = first_word[row] + np.arange(len(row)) - first_shingle[row]
        last = w + np.minimum(words, n_words[row]) - 1
        data, some = norm.tobytes(), np.flatnonzero(n)
        if not len(some):
            continue
        h = np.fromiter((xxh64_intdigest(data[i:j], SEED) for i, j in zip(starts[w].tolist(), ends[last].tolist(), strict=True)), np.uint64, len(w))
        ones = np.empty((len(some), BITS), np.int64)
        for x in range(0, len(some), 4096):  # rows whose bits are laid out at once
            rows = some[x: x + 4096]
            lo = first_shingle[rows[0]]
            hi = first_shingle[rows[-1]] + n[rows[-1]]
            laid = np.unpackbits(h[lo:hi].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[x: x + 4096] = np.add.reduceat(laid, first_shingle[rows] - lo, axis=0, dtype=np.int64)
        over = np.packbits(2 * ones > n[some][:, None], axis=1, bitorder="little")
        out[a + some] = over.view(np.uint64).ravel()
    return out


def fingerprinted(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(_d, _k, doc_id, fp) per row; fp as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array(fingerprints(batch["text"], words).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["_d"], batch["_k"], batch["doc_id"], fp], names=["_d", "_k", "doc_id", "fp"])

    return texts(docs).mapInArrow(run, "_d long, _k long, doc_id long, fp long")


def trie_pairs(keys: np.ndarray, roots: np.ndarray, depth: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of sorted, distinct 64-bit keys within ``radius`` bits, both in one subtrie.

    ``roots``: bounds of the runs of keys that agree in their first ``depth`` bits.
    """
    lo, hi = roots[:-1], roots[1:]
    lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
    stack = [(depth, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        depth, al, ah, bl, bh, err = stack.pop()
        if len(al) > FRONTIER:
            half = len(al) // 2
            stack += [(depth, *(x[part] for x in (al, ah, bl, bh, err))) for part in (slice(half), slice(half, None))]
            continue
        leaf = (ah - al == 1) & (bh - bl == 1)
        if leaf.any():
            i, j = al[leaf], bl[leaf]
            near = (i != j) & (np.bitwise_count(keys[i] ^ keys[j]) <= radius)
            if near.any():
                yield i[near], j[near]
            al, ah, bl, bh, err = (x[~leaf] for x in (al, ah, bl, bh, err))
        if not len(al):
            continue
        if depth not in ones:
            bit = (keys >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        c = ones[depth]
        am, bm, own = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl]), al == bl
        parts = [(al, am, bl, bm, err, None), (am, ah, bm, bh, err, None), (al, am, bm, bh, err + 1, None), (am, ah, bl, bm, err + 1, ~own)]
        out = []
        for x in parts:
            ok = (x[0] < x[1]) & (x[2] < x[3]) & (x[4] <= radius)
            ok &= ~((x[0] == x[2]) & (x[1] - x[0] == 1))  # a leaf with itself
            if x[5] is not None:
                ok &= x[5]
            out.append([y[ok] for y in x[:5]])
        merged = [np.concatenate(y) for y in zip(*out, strict=True)]
        if len(merged[0]):
            stack.append((depth + 1, *merged))


def united(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index linked with each of ``n`` elements."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            if not (apart := a != b).any():
                break
            i, j = i[apart], j[apart]
            np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while not np.array_equal(up := root[root], root):
                root = up
    return root


def _walk(radius: int):
    def links(top: np.ndarray, keys: np.ndarray, shift: np.ndarray) -> pa.RecordBatch | None:
        """top: which subtrie (cut and its top bits); all keys of a subtrie are here."""
        order = np.lexsort((keys, top))
        top, keys, shift = top[order], keys[order], shift[order]
        new = np.concatenate([[True], top[1:] != top[:-1]])
        root = united(len(keys), trie_pairs(keys, np.append(np.flatnonzero(new), len(keys)), 0, radius))
        i = np.flatnonzero(root != np.arange(len(keys)))
        if not len(i):
            return None
        back = lambda x: ((keys[x] >> shift[x]) | (keys[x] << ((np.uint64(BITS) - shift[x]) % np.uint64(BITS)))).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(back(i)), pa.array(back(root[i]))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            top, rot, shift = batch["top"].to_numpy(), batch["rot"].to_numpy().view(np.uint64), batch["shift"].to_numpy().astype(np.uint64)
            if size >= HELD and (cut := int(np.searchsorted(top, top[-1]))):  # sorted by top; the last subtrie may go on
                held.append([x[:cut] for x in (top, rot, shift)])
                if (out := links(*(np.concatenate(x) for x in zip(*held, strict=True)))) is not None:
                    yield out
                held, size, top, rot, shift = [], 0, top[cut:], rot[cut:], shift[cut:]
            held.append([top, rot, shift])
            size += len(top)
        if held and (out := links(*(np.concatenate(x) for x in zip(*held, strict=True)))) is not None:
            yield out

    return run


def _blocks(bits: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``parts`` blocks that cover ``bits`` bits."""
    ends = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _rotated(x: Column, by: int) -> Column:
    return x if not by else F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, BITS - by))


def _top(x: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(F.shiftleft(x, first), BITS - width)


def near_links(fps: DataFrame, radius: int = RADIUS, hot: int = HOT_ROWS) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fp`` that connect all that are within ``radius`` bits, chained."""
    cuts = _blocks(BITS, radius + 1)
    rows = fps.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("cut"), F.lit(a).alias("shift"), _rotated(F.col("fp"), a).alias("rot"), _top(F.col("fp"), a, w).alias("block"))
        for i, (a, w) in enumerate(cuts)])).alias("r")).select("r.*")
    large = rows.groupBy("cut", "block").count().where(F.col("count") > hot).select("cut", "block", F.lit(True).alias("large"))
    rows = rows.join(large, ["cut", "block"], "left")
    # below a hot top the other bits are cut once more; the rest of a rotated key starts at its block's width
    deeper = []
    for i, (_, w) in enumerate(cuts):
        deeper += [F.when((F.col("cut") == i) & F.col("large"), F.xxhash64("cut", "block", F.lit(j + 1), _top(F.col("rot"), w + a, v)))
                   for j, (a, v) in enumerate(_blocks(BITS - w, radius + 1))]
    tops = F.array_compact(F.array(F.when(F.col("large").isNull(), F.xxhash64("cut", "block")), *deeper))
    rows = rows.select("rot", "shift", F.explode(tops).alias("top"))
    return rows.repartition("top").sortWithinPartitions("top").mapInArrow(_walk(radius), "u long, v long")


def near_groups(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, hot: int = HOT_ROWS) -> DataFrame:
    """(_d, _k, doc_id, fp, root, component_id) per row; root: a fingerprint that names the component."""
    rows = stored(fingerprinted(docs, words), "simhash")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(near_links(fps.select("fp"), radius, hot)).withColumnRenamed("node", "fp")
    fps = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = fps.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(fps.join(names, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id (smallest doc_id reachable by links)."""
    return near_groups(docs, words, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest doc_id; all columns."""
    kept = near_groups(docs, words, radius).groupBy("root").agg(F.min(F.struct("_d", "_k")).alias("key")).select("key._d", "key._k")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), doc_key().alias("_d"), text_key().alias("_k"))
    rows = rows.join(kept, ["_d", "_k"], "left_semi").groupBy("_d", "_k").agg(F.first("row").alias("row"))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in names])
