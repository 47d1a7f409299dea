"""Removal of long repeated passages by column-wise construction over many documents (operator 10).

Contract: every byte covered by a ``length``-byte string that also starts earlier (in a smaller
doc_id, or earlier in the same document) goes. Strings are judged on the input.

Method. A document as a whole cannot be a column of one sorted collection on a cluster: rounds
would equal the longest text and every round would pass over all suffixes. So texts are cut at
anchors: in each ``length``-byte window the ``GRAM``-byte string of smallest hash (the leftmost of
equal ones). Equal windows have equal anchors at equal offsets; so only texts around equal anchors
have to be compared, and only column by column. For each group of equal anchors the surrounding
texts are the documents of a collection, right-aligned at the anchor. Each round inserts one
symbol per document, from the last column to the first: the symbols in the order of the previous
round are that round's Burrows-Wheeler segment, its stable sort (the LF mapping) gives the next
order, and the longest common prefixes of neighbours follow as one more than the minimum over the
previous round's range. Neighbours with a common prefix of ``length`` share a window; all but the
first occurrence are repeats. Columns of shuffled texts go through an unlinked temporary file, one
sequential run per column, read back from the last to the first, so memory does not hold the texts.

Documents whose whole text is a copy are found by a digest and need no rounds beyond the first.
The rounds run twice. First within each block of rows, before any shuffle: of a passage that a
third of all rows hold, each block keeps one occurrence. Then on what is left, with the anchors
that more than one block holds. Both levels are exact, hence so is the result. An anchor inside a
common line that is shorter than a window can still be in very many texts that go on differently.
Level one leaves one occurrence of a passage in a block, so an anchor with over twice as many occurrences
as there are blocks isn't one passage: its windows are told apart by their own hashes first, and a group's
texts then agree in a whole window. This bound moves with the input, so the share of such anchors
is the same at every size. A passage that every block holds is compared in rounds of ``GROUP_ROWS``: each
group is dealt over shards, a shard hands on the first of its equal windows, and the next round has as many
rows a passage as the one before had shards.

Defined cases: null text is empty; texts shorter than ``length`` lose nothing; rows with a null
doc_id come after all others; rows that repeat a doc_id with another text are ordered by a hash of
the text; rows that repeat both are one document and get equal results; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnup.llm.base import discard, doc_key, row_schema, stored, text_key, texts
from burnup.llm.columns import BYTE_CODE, GOLD, buffer, byte_lengths, mix, ragged, slices, span_hashes

LENGTH = 100
GRAM = 24
#: Bytes of text of a block (level one).
BLOCK_BYTES = 1 << 22
#: Bytes of context texts of a group run (level two); a single larger group is handled as one.
RUN_BYTES = 1 << 24
#: Occurrences of an anchor, for each block, beyond which its windows part.
HOT_IN_BLOCK = 2
#: Occurrences of a passage that are compared in one group.
GROUP_ROWS = 4096
#: Windows whose anchors are sought at once: places within share a word with 40 bits of hash.
SEGMENT = 1 << 20
PAD = 255  # never part of UTF-8
#: Bits of each of the two window offsets of a packed place; the position is above them.
OFFSET_BITS = 7


def _lowest(buf: np.ndarray, gram: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the gram at each place, and for each ``wide`` places running the place of the lowest."""
    parts, have, todo, done, h = BYTE_CODE[buf], 1, gram, 0, None
    while todo:  # spans of 1, 2, 4 ... bytes, joined to spans of ``gram`` bytes
        if todo & 1:
            n = len(buf) - done - have + 1
            h = parts[:n].copy() if h is None else h[:n] * (GOLD + np.uint64(2 * done)) + parts[done: done + n]
            done += have
        todo >>= 1
        if todo:
            parts = parts[:-have] * (GOLD ^ np.uint64(have << 1)) + parts[have:]
            have *= 2
    h = mix(h)
    low = np.uint64(2 * SEGMENT - 1)
    best, have = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
    while 2 * have <= wide:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    if have < wide:
        best = np.minimum(best[: len(best) - (wide - have)], best[wide - have:])
    return h, (best & low).astype(np.int64)


def anchors(buf: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Place and hash of each anchor, and the first and last window it stands for.

    ``buf``: texts, each followed by PAD; windows never hold a PAD. Windows are looked at
    ``SEGMENT`` at a time; only the anchors are kept, so memory is a few times ``SEGMENT``.
    """
    fits = np.zeros(max(len(buf) - length + 1, 0) + 1, np.int8)
    for x, y in zip(bounds[:-1], bounds[1:] - 1 - length, strict=True):
        if y >= x:
            fits[x] += 1
            fits[y + 1] -= 1
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    inside = 0
    for a in range(0, len(fits) - 1, SEGMENT):
        b = min(a + SEGMENT, len(fits) - 1)
        depth = inside + np.cumsum(fits[a:b], dtype=np.int64)
        inside = int(depth[-1])
        windows = np.flatnonzero(depth)
        if not len(windows):
            continue
        h, at = _lowest(buf[a: b + length - 1], gram, length - gram + 1)
        place = at[windows]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(windows) != 1)]))
        last = np.append(first[1:], len(windows)) - 1
        found.append((place[first] + a, h[place[first]], windows[first] + a, windows[last] + a))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def repeats(column: Callable[[int], np.ndarray], group: np.ndarray, width: int, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(column, texts) of each window that an earlier text of its group has in the same column.

    ``column(t)``: the t-th symbol of every text (PAD where it has none), asked from the last to the
    first. ``group``: non-decreasing group number; within a group texts come in order of occurrence.
    """
    order, lcp = np.arange(len(group)), np.zeros(len(group) + 1, np.int32)
    key_base = group.astype(np.int64) << 8
    for t in range(width - 1, -1, -1):
        bwt = column(t)[order]
        key = key_base + bwt
        to = np.argsort(key, kind="stable")  # LF mapping within each group
        key = key[to]
        same = np.flatnonzero((key[1:] == key[:-1]) & ((key[1:] & 255) != PAD)) + 1
        p, q = to[same - 1], to[same]
        fresh = np.zeros(len(group) + 1, np.int32)
        next_to = q == p + 1
        fresh[same[next_to]] = lcp[q[next_to]] + 1
        if not next_to.all():
            p, q, i = p[~next_to], q[~next_to], same[~next_to]
            pairs = np.empty(2 * len(p), np.int64)
            pairs[::2], pairs[1::2] = p + 1, q + 1
            fresh[i] = np.minimum.reduceat(lcp, pairs)[::2] + 1
        order, lcp = order[to], fresh
        if t > width - length:
            continue
        near = lcp[:-1] >= length
        if near.any():
            runs = np.flatnonzero(~near)
            first = np.minimum.reduceat(order, runs)
            run = np.cumsum(~near) - 1
            yield t, order[order != first[run]]


def block_rows(d: np.ndarray, k: np.ndarray, column: pa.Array, length: int, gram: int) -> dict[str, np.ndarray]:
    """Level one over one block: repeats found there, and the anchors that are left."""
    order = np.lexsort((k, d))
    d, k = d[order], k[order]
    new = np.concatenate([[True], (np.diff(d) != 0) | (np.diff(k) != 0)]) if len(d) else np.zeros(0, bool)
    order, d, k = order[new], d[new], k[new]
    buf, bounds = buffer(column.take(pa.array(order)), bytes([PAD]))
    place, h, lo, hi = anchors(buf, bounds, length, gram)
    reach, width = length - gram, 2 * length - gram
    by = np.argsort(h, kind="stable")
    new = np.concatenate([[True], h[by][1:] != h[by][:-1]]) if len(by) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    many = np.bincount(group, minlength=1)[group] > 1 if len(by) else np.zeros(0, bool)
    ctx, group = by[many], group[many]
    repeated = np.zeros(len(buf) + 1, bool)
    if len(ctx):
        base, left, right = place[ctx] - reach, lo[ctx], hi[ctx] + length

        def column_at(t: int) -> np.ndarray:
            x = base + t
            return np.where((x >= left) & (x < right), buf[np.clip(x, 0, len(buf) - 1)], PAD)

        for t, which in repeats(column_at, group, width, length):
            repeated[base[which] + t] = True
    # what is left of each anchor: from its first to its last window that is not a repeat
    fresh = np.flatnonzero(~repeated[:-1]).astype(np.int32)
    a = np.searchsorted(fresh, lo)
    b = np.searchsorted(fresh, hi, "right") - 1
    keep = a <= b
    place, h, lo, hi = place[keep], h[keep], fresh[a[keep]].astype(np.int64), fresh[b[keep]].astype(np.int64)
    del fresh
    step = np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]]))
    m_lo, m_hi = np.flatnonzero(step == 1), np.flatnonzero(step == -1) - 1
    # a run of window starts may go on in the next text: PAD and the windows before it never repeat
    row, m_row = np.searchsorted(bounds, place, "right") - 1, np.searchsorted(bounds, m_lo, "right") - 1
    return {"h": h.view(np.int64), "d": d[row], "k": k[row], "place": pack(place - bounds[row], lo - place + reach, hi - place + reach),
            "m_d": d[m_row], "m_k": k[m_row], "m_lo": m_lo - bounds[m_row], "m_hi": m_hi - bounds[m_row]}


def pack(pos: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """One long that sorts by position; the offsets of the first and last window come last."""
    return pos << 2 * OFFSET_BITS | lo << OFFSET_BITS | hi


def unpack(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = (1 << OFFSET_BITS) - 1
    return x >> 2 * OFFSET_BITS, (x >> OFFSET_BITS) & low, x & low


FOUND = "h long, d long, k long, place long, lo int, hi int"


def _found(batch: dict) -> pa.RecordBatch:
    """Rows of FOUND: anchors that are left, repeats, and a row of nulls that counts the block."""
    n, m = len(batch["h"]), len(batch["m_d"]) + 1
    null = lambda c, t: pa.nulls(c, t)
    cat = lambda x, y: pa.concat_arrays([x, y])
    return pa.RecordBatch.from_arrays([
        cat(pa.array(batch["h"]), null(m, pa.int64())),
        cat(pa.array(np.concatenate([batch["d"], batch["m_d"]]).astype(np.int64)), null(1, pa.int64())),
        cat(pa.array(np.concatenate([batch["k"], batch["m_k"]]).astype(np.int64)), null(1, pa.int64())),
        cat(pa.array(batch["place"].astype(np.int64)), null(m, pa.int64())),
        pa.concat_arrays([null(n, pa.int32()), pa.array(batch["m_lo"].astype(np.int32)), null(1, pa.int32())]),
        pa.concat_arrays([null(n, pa.int32()), pa.array(batch["m_hi"].astype(np.int32)), null(1, pa.int32())])], names=["h", "d", "k", "place", "lo", "hi"])


def _level_one(length: int, gram: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            return _found(block_rows(t["_d"].to_numpy(), t["_k"].to_numpy(), pa.concat_arrays(t["text"].chunks), length, gram))

        for batch in batches:
            for a, b in slices(byte_lengths(batch["text"]) + 1, block):
                part = batch.slice(a, b - a)
                n = int(byte_lengths(part["text"]).sum()) + len(part)
                if held and size + n > block:
                    yield flush()
                    held, size = [], 0
                held.append(part)
                size += n
        if held:
            yield flush()

    return run


def _contexts(length: int, gram: int):
    """Texts around the shared anchors of each document."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(byte_lengths(batch["text"]), 1 << 21):
                part = batch.slice(a, b - a)
                buf, bounds = buffer(part["text"], bytes([PAD]))
                found = part["found"]
                row = np.repeat(np.arange(len(part)), np.diff(np.asarray(found.offsets)))
                flat = found.flatten()
                h, place = flat.field(0), flat.field(1).to_numpy()
                pos, lo, hi = unpack(place)
                start = bounds[row] + pos - reach + lo
                size = hi - lo + length
                for x, y in slices(size, 1 << 22):
                    which, i = ragged(size[x:y])
                    data = buf[start[x:y][which] + i]
                    ends = np.concatenate([[0], np.cumsum(size[x:y])]).astype(np.int32)
                    ctx = pa.BinaryArray.from_buffers(pa.binary(), y - x, [None, pa.py_buffer(ends), pa.py_buffer(data)])
                    yield pa.RecordBatch.from_arrays([h.slice(x, y - x), part["_d"].take(pa.array(row[x:y])), part["_k"].take(pa.array(row[x:y])),
                                                      pa.array(place[x:y]), ctx], names=["h", "d", "k", "place", "ctx"])

    return run


def _window_hashes(length: int, gram: int):
    """One row for each window of the given anchors: its hash, document and place (its own window only)."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(byte_lengths(batch["text"]), 1 << 21):
                part = batch.slice(a, b - a)
                buf, bounds = buffer(part["text"], bytes([PAD]))
                row = np.repeat(np.arange(len(part)), np.diff(np.asarray(part["found"].offsets)))
                d, k = part["_d"].to_numpy(), part["_k"].to_numpy()
                for x in range(0, len(row), 1 << 14):
                    some = row[x: x + (1 << 14)]
                    pos, lo, hi = unpack(part["found"].flatten().field(1).to_numpy()[x: x + (1 << 14)])
                    which, i = ragged(hi - lo + 1)
                    offset = lo[which] + i
                    start = bounds[some][which] + pos[which] - reach + offset
                    h = span_hashes(buf, start, start + length)
                    place = pack(pos[which], offset, offset)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(d[some][which]), pa.array(k[some][which]), pa.array(place)], names=["h", "d", "k", "place"])

    return run


def _group_repeats(rows: pa.Table, length: int, gram: int, hand_on: bool) -> Iterator[pa.RecordBatch]:
    """Level two over whole groups, sorted by (g, d, k, place): repeats (g is null), and if asked the rows with windows that aren't."""
    g, h, d, k, place = (rows[c].to_numpy() for c in ("g", "h", "d", "k", "place"))
    column = pa.concat_arrays(rows["ctx"].chunks)
    pos, lo, hi = unpack(place)
    occurrence = np.concatenate([[True], (np.diff(g) != 0) | (np.diff(d) != 0) | (np.diff(k) != 0) | (np.diff(place) != 0)])
    g, h, d, pos, k, lo, hi = (x[occurrence] for x in (g, h, d, pos, k, lo, hi))
    column = column.filter(pa.array(occurrence)) if not occurrence.all() else column
    buf, bounds = buffer(column, bytes([PAD]))
    group = np.cumsum(np.concatenate([[True], np.diff(g) != 0])) - 1
    width, reach = 2 * length - gram, length - gram
    first, size = bounds[:-1], np.diff(bounds) - 1
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    with tempfile.TemporaryFile() as file:  # a file of columns; it has no name and ends with the task
        for t in range(width):
            x = t - lo
            inside = (x >= 0) & (x < size)
            file.write(np.where(inside, buf[np.clip(first + x, 0, len(buf) - 1)], PAD).astype(np.uint8).data)
        del buf

        def column_at(t: int) -> np.ndarray:
            file.seek(t * len(g))
            return np.frombuffer(file.read(len(g)), np.uint8)

        for t, which in repeats(column_at, group, width, length):
            hits.append((which, np.full(len(which), t, np.int16)))
    if hits:
        which, t = (np.concatenate(x) for x in zip(*hits, strict=True))
        by = np.lexsort((t, which))
        which, t = which[by], t[by].astype(np.int64)
        new = np.concatenate([[True], (np.diff(which) != 0) | (np.diff(t) != 1)])
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(t)) - 1
        w = which[a]
        none = pa.nulls(len(w), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array(d[w]), pa.array(k[w]), none, pa.nulls(len(w), pa.binary()), pa.array((pos[w] - reach + t[a]).astype(np.int32)),
                                          pa.array((pos[w] - reach + t[b]).astype(np.int32))], names=LEFT_NAMES)
    if hand_on:
        # each row from its first to its last window that is no repeat; rows without one are done
        left = np.ones((len(g), width - length + 1), bool)
        for which, t in hits:
            left[which, t] = False
        places = np.arange(left.shape[1])
        left &= (places >= lo[:, None]) & (places <= hi[:, None])
        keep = np.flatnonzero(left.any(axis=1))
        a, b = left[keep].argmax(axis=1), left.shape[1] - 1 - left[keep, ::-1].argmax(axis=1)
        ctx = [x.as_py()[y: y + z] for x, y, z in zip(column.take(pa.array(keep)), (a - lo[keep]).tolist(), (b - a + length).tolist(), strict=True)]
        none = pa.nulls(len(keep), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array(d[keep]), pa.array(k[keep]), pa.array(pack(pos[keep], a, b)), pa.array(ctx, pa.binary()), none, none], names=LEFT_NAMES)


LEFT = "h long, d long, k long, place long, ctx binary, lo int, hi int"
LEFT_NAMES = ["h", "d", "k", "place", "ctx", "lo", "hi"]


def _level_two(length: int, gram: int, most: int, hand_on: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            g = batch["g"].to_numpy()
            cut = int(np.searchsorted(g, g[-1]))  # the last group may go on
            if size > most and (cut or g[0] != last):
                yield from _group_repeats(pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks(), length, gram, hand_on)
                held, size = [], 0
                batch = batch.slice(cut)
            held.append(batch)
            size += batch.nbytes
            last = g[-1]
        if held:
            yield from _group_repeats(pa.Table.from_batches(held).combine_chunks(), length, gram, hand_on)

    return run


def _rounds(ctx: DataFrame, most: int, group_rows: int, length: int, gram: int) -> DataFrame:
    """(d, k, lo, hi): repeats within the groups ``h``; ``most``: how many rows of one passage there may be."""
    hits, shards = [], max(1, -(-most // group_rows))
    while True:
        # texts of different groups that meet by a collision of g are compared and found different
        dealt = ctx.withColumn("g", F.xxhash64("h", F.pmod("k", F.lit(shards))) if shards > 1 else F.col("h"))
        out = (dealt.repartition("g").sortWithinPartitions("g", "d", "k", "place").mapInArrow(_level_two(length, gram, RUN_BYTES, shards > 1), LEFT))
        out = stored(out, "sa_round") if shards > 1 else out
        hits.append(out.where("h is null").select("d", "k", "lo", "hi") if shards > 1 else out.select("d", "k", "lo", "hi"))
        if shards == 1:
            return reduce(DataFrame.unionByName, hits)
        ctx = out.where("h is not null").select("h", "d", "k", "place", "ctx")
        shards = -(-shards // group_rows)


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK_BYTES, hot: float = HOT_IN_BLOCK, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(d, k, lo, hi): runs of starts of windows that occur earlier, by document; k: the text key."""
    if not 0 < gram <= length <= gram + 127:
        raise ValueError("need gram <= length <= gram + 127")
    rows = texts(docs).select("_d", "_k", "text").where(F.octet_length("text") >= length)
    copies = stored(_copies(rows, length), "sa_copies")
    found = stored(rows.mapInArrow(_level_one(length, gram, block), FOUND), "sa_found")
    left = found.where("h is not null").select("h", "d", "k", "place").join(copies.select("d", "k"), ["d", "k"], "left_anti")
    blocks = found.where("d is null").count()
    # anchors that more than one block holds (or one block twice, at windows that differ)
    known = stored(_in_several(left), "sa_known")
    # a common line shorter than a window is an anchor in very many texts, of which few go on alike:
    # such an anchor is replaced by its windows, each a group of its own if several texts have it
    windows = _with_texts(rows, known.where(F.col("n") > hot * blocks)).mapInArrow(_window_hashes(length, gram), "h long, d long, k long, place long")
    repeated = _in_several(windows)
    shared = stored(known.where(F.col("n") <= hot * blocks).unionByName(repeated).groupBy("d", "k")
                    .agg(F.collect_list(F.struct("h", "place")).alias("found")), "sa_shared")
    ctx = _with_texts(rows, shared).mapInArrow(_contexts(length, gram), "h long, d long, k long, place long, ctx binary")
    later = _rounds(ctx, blocks, group_rows, length, gram)
    out = stored(later.unionByName(found.where("h is null and d is not null").select("d", "k", "lo", "hi")).unionByName(copies), "sa_windows")
    for df in (copies, found, known, shared):
        discard(df)
    return out


def _in_several(rows: DataFrame) -> DataFrame:
    """The rows whose ``h`` occurs again, with its number of occurrences ``n``.

    The counts are stored: both sides of the join are then shuffled for it, and AQE can split a hot ``h``.
    """
    n = stored(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sa_counts")
    return rows.join(n, "h").select("h", "d", "k", "place", "n")


def _with_texts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(_d, _k, text, found: array of (h, place)) of each document in ``found`` (rows, or lists by document)."""
    if "found" not in found.columns:
        found = found.groupBy("d", "k").agg(F.collect_list(F.struct("h", "place")).alias("found"))  # a document's own anchors
    joined = rows.select("_d", "_k", "text").join(found, (F.col("_d") == F.col("d")) & (F.col("_k") == F.col("k")))
    return joined.select("_d", "_k", "text", "found")


def _copies(rows: DataFrame, length: int) -> DataFrame:
    """All windows of each document whose whole text an earlier document has. The first of a text is pre-aggregated."""
    text = rows.select(F.col("_d").alias("d"), F.col("_k").alias("k"), F.unhex(F.sha2("text", 256)).alias("sha"),
                       (F.octet_length("text") - length).alias("hi"))
    first = text.groupBy("sha").agg(F.min(F.struct("d", "k")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "first")
    first = stored(first, "sa_firsts")  # as the counts above, so that a text with very many copies can be split
    return text.join(first, "sha").where("struct(d, k) != first").select("d", "k", F.lit(0).alias("lo"), "hi").distinct()


def _cut(length: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, spans, kept, shas, removed = [], [], [], [], []
            column = batch["text"].cast(pa.binary())
            for text, windows in zip(column, batch["windows"].to_pylist(), strict=True):
                data = text.as_py() or b""
                runs: list[list[int]] = []
                for w in sorted((w["lo"], w["hi"] + length) for w in windows or ()):
                    if runs and w[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], w[1])
                    else:
                        runs.append(list(w))
                left = b"".join(data[a:b] for a, b in zip([0, *(r[1] for r in runs)], [*(r[0] for r in runs), len(data)], strict=True)) if runs else data
                bounds.append(len(data))
                removed.append(len(data) - len(left))
                spans.append(runs)
                if keep_text:
                    kept.append(left.decode("utf-8", "ignore") if runs else None)
                else:
                    shas.append(hashlib.sha256(left).hexdigest())
            extra = pa.array(kept if keep_text else shas, pa.string())
            names = [c for c in batch.schema.names if c not in ("windows",) and (keep_text or c != "text")]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(bounds, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(spans, pa.list_(pa.list_(pa.int64()))), extra],
                                             names=[*names, "_bytes", "_removed", "_spans", "_kept"])

    return run


def with_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` with a last column ``windows``: the runs of repeated window starts."""
    found = repeated_windows(docs, length, gram, block).groupBy("d", "k").agg(F.collect_list(F.struct("lo", "hi")).alias("windows"))
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), doc_key().alias("_d"), text_key().alias("_k"))
    # text_key hashes a null text otherwise than an empty one; neither has windows
    return rows.join(found, (F.col("_d") == F.col("d")) & (F.col("_k") == F.col("k")), "left").select("row", "windows")


def dedup_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed runs [start, end) in bytes), kept_sha256, per document."""
    rows = with_windows(docs.select("doc_id", "text"), length, gram, block)
    rows = rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce("row.text", F.lit("")).alias("text"), "windows")
    out = rows.mapInArrow(_cut(length, False), "doc_id long, _bytes long, _removed long, _spans array<array<bigint>>, _kept string")
    return out.select("doc_id", F.col("_bytes").alias("n_bytes"), F.col("_removed").alias("n_removed"),
                      F.col("_spans").alias("spans"), F.col("_kept").alias("kept_sha256"))


def dedup_texts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without their repeated passages; all columns, in order.

    A character cut in the middle of its bytes goes. Null texts stay null.
    """
    names = docs.columns
    rows = with_windows(docs, length, gram, block).select("row", F.col("row.text").alias("text"), "windows")
    out = rows.mapInArrow(_cut(length, True), row_schema(rows, "text string, _bytes long, _removed long, _spans array<array<bigint>>, _kept string"))
    text = F.coalesce("_kept", "text")
    return out.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names])
