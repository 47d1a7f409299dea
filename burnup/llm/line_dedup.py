"""Lines that many documents share, found by a once-seen and a twice-seen Bloom filter (operator 11).

A line's key is the line without white space at its ends, ASCII letters lowered; keys of at least
``min_chars`` code points count. A key found in ``min_docs`` documents or more keeps its lines in one
document only: the one of the largest doc_id. The other lines stay as they were, joined by ``\\n``.

Steps. The texts are read once into a directory of (key digest, document) rows, a tenth of their
size, written in folders by digest range. Each digest goes, without its document and once per batch
of rows, to the shard of its range: a digest new to the shard's once-seen filter is entered there, one
that is there already is entered in the twice-seen filter. A shard holds its two filters and no
digests, so nothing is sorted or hashed into groups. The twice-seen filters are broadcast, ``GROUP_BYTES``
of them at a time, and each folder is probed against its own group without a shuffle. Only the
suspects that pass are shuffled: they are counted and confirmed exactly by their 128-bit digests.

Both filters err towards "seen", so every key of two documents is a suspect; one held by a single
document may be, and is then counted as one. Filters take 16 and 4 bits a line: the twice-seen filter
can't hold more than half as many keys as there are lines.

Hot lines. A digest is sent once per batch, not per document. Suspects are counted by (digest, salt)
first, and the salts that occur go back with the verdict, so the join of a key that a third of all rows
hold is dealt over ``SALTS`` groups.

Defined cases: null or empty text is one empty line. Documents are told apart by id and text: rows that
repeat both are one document and get equal results; rows that share an id with other texts count
each, and the largest of them by the hash of id and text keeps the line; rows without doc_id
come after all ids. A line that one document holds several times counts once, and stays as often as
it is where it stays. Texts of any length are one row; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnup.llm.base import discard, shuffles_freed, stored, table_path, texts
from burnup.llm.columns import GOLD, MIX1, mix

SPACE = b" \t\n\v\f\r"
#: Lines of a shard, and bits a line and hashes of the two filters.
SHARD_LINES = 1 << 18
ONCE_BITS, ONCE_HASHES = 16, 4
TWICE_BITS, TWICE_HASHES = 4, 3
#: Twice-seen filters broadcast at once.
GROUP_BYTES = 1 << 25
SALTS = 64

DIRECTORY = "shard int, h long, h2 long, _d long, _k long"


def digest(line: bytes, min_chars: int) -> bytes | None:
    """128 bits of a line's key; None for keys that are too short."""
    key = line.strip(SPACE)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()


def _directory(min_chars: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = [], []
            for text in batch["text"]:
                keys = {x for x in (digest(line, min_chars) for line in text.as_py().encode().split(b"\n")) if x}
                found += keys
                counts.append(len(keys))
            h = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            shard = (h[:, 0].view(np.uint64) % np.uint64(shards)).astype(np.int32)
            doc = [np.repeat(batch[x].to_numpy(), counts) for x in ("_d", "_k")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (shard, h[:, 0].copy(), h[:, 1].copy(), *doc)], names=["shard", "h", "h2", "_d", "_k"])

    return run


def bits(keys: np.ndarray, i: int, size: int) -> np.ndarray:
    """Place of each key's ``i``-th bit."""
    return (mix(keys ^ (np.full(1, i + 1, np.uint64) * MIX1 * GOLD)) % np.uint64(size)).astype(np.int64)


def _once_a_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct digests of each batch, and whether several of its documents hold them."""
    for batch in batches:
        h, first, n = np.unique(batch["h"].to_numpy(), return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([batch["shard"].take(pa.array(first)), pa.array(h), pa.array(n > 1)], names=["shard", "h", "several"])


class Seen:
    """The once-seen and the twice-seen filter of a shard."""

    def __init__(self, lines: int):
        self.once, self.twice = np.zeros(lines * ONCE_BITS, bool), np.zeros(lines * TWICE_BITS, bool)

    def add(self, keys: np.ndarray, several: np.ndarray) -> None:
        keys, first, n = np.unique(keys, return_index=True, return_counts=True)
        again = several[first] | (n > 1)
        at = [bits(keys, i, len(self.once)) for i in range(ONCE_HASHES)]
        again |= np.logical_and.reduce([self.once[x] for x in at])
        for x in at:
            self.once[x] = True
        for i in range(TWICE_HASHES):
            self.twice[bits(keys[again], i, len(self.twice))] = True


def _fill(lines: int):
    """Rows of one or a few shards, in any order, to their twice-seen filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Seen] = {}
        for batch in batches:
            shard, h = batch["shard"].to_numpy(), batch["h"].to_numpy().view(np.uint64)
            several = batch["several"].to_numpy(zero_copy_only=False)
            for s in np.unique(shard).tolist():
                own = shard == s
                held.setdefault(s, Seen(lines)).add(h[own], several[own])
        for s, seen in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.packbits(seen.twice).tobytes()], pa.binary())], names=["shard", "twice"])

    return run


def _probe(filters, lines: int):
    """Rows whose digest is in its shard's twice-seen filter."""
    size = lines * TWICE_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = {s: np.frombuffer(x, np.uint8) for s, x in filters.value.items()}
        for batch in batches:
            shard, h = batch["shard"].to_numpy(), batch["h"].to_numpy().view(np.uint64)
            hit = np.zeros(len(batch), bool)
            for s in np.unique(shard).tolist():
                at = np.flatnonzero(shard == s)
                for i in range(TWICE_HASHES):
                    b = bits(h[at], i, size)
                    at = at[twice[s][b >> 3] >> (7 - (b & 7)).astype(np.uint8) & 1 == 1]
                hit[at] = True
            yield batch.select(["h", "h2", "_d", "_k"]).filter(pa.array(hit))

    return run


def suspects(rows: DataFrame, min_chars: int, shard_lines: int = SHARD_LINES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(h, h2, _d, _k): the digests that two documents or more may hold, once for each document that holds them."""
    spark = rows.sparkSession
    long_lines = F.size(F.filter(F.split("text", "\n"), lambda x: F.length(x) >= min_chars))
    n_lines = rows.agg(F.sum(long_lines.cast("long"))).first()[0] or 0
    shards = max(1, -(-n_lines // shard_lines))
    in_group = max(1, group_bytes // (shard_lines * TWICE_BITS // 8))
    path, out = table_path(spark, "line_directory"), table_path(spark, "line_suspects")
    directory = rows.mapInArrow(_directory(min_chars, shards), DIRECTORY).withColumn("part", F.expr(f"shard div {in_group}").cast("int"))
    directory.write.option("compression", "zstd").partitionBy("part").parquet(path)
    directory = spark.read.schema(directory.schema).parquet(path)
    sent = directory.select("shard", "h").mapInArrow(_once_a_batch, "shard int, h long, several boolean")
    filters = stored(sent.repartition(shards, "shard").mapInArrow(_fill(shard_lines), "shard int, twice binary"), "line_filters")
    for part in range(-(-shards // in_group)):
        own = filters.where(F.col("shard").between(part * in_group, (part + 1) * in_group - 1))
        held = spark.sparkContext.broadcast({r.shard: bytes(r.twice) for r in own.collect()})  # group_bytes at most
        found = directory.where(F.col("part") == part).drop("part").mapInArrow(_probe(held, shard_lines), "h long, h2 long, _d long, _k long").distinct()
        with shuffles_freed(spark):
            found.write.mode("append").option("compression", "zstd").parquet(out)
        held.destroy()
    discard(filters)
    return spark.read.schema("h long, h2 long, _d long, _k long").parquet(out)


def lost_lines(found: DataFrame, min_docs: int) -> DataFrame:
    """(_d, _k, lost): the digests each document loses."""
    found = found.withColumn("salt", F.pmod("_k", F.lit(SALTS)))
    some = found.groupBy("h", "h2", "salt").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("_d", "_k")).alias("last"))
    common = (some.groupBy("h", "h2").agg(F.sum("n").alias("n"), F.max("last").alias("keeps"), F.collect_list("salt").alias("salts"))
              .where(F.col("n") >= min_docs).select("h", "h2", "keeps", F.explode("salts").alias("salt")))
    return (found.join(common, ["h", "h2", "salt"]).where(F.struct("_d", "_k") != F.col("keeps"))
            .groupBy("_d", "_k").agg(F.collect_list(F.struct("h", "h2")).alias("lost")))


def _drop(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, lost in zip(batch["text"], batch["lost"], strict=True):
                lines = text.as_py().encode().split(b"\n")
                n_lines.append(len(lines))
                if lost.is_valid:
                    raw = np.column_stack([x.to_numpy() for x in lost.values.flatten()]).astype("<i8").tobytes()
                    gone = {raw[i: i + 16] for i in range(0, len(raw), 16)}
                    lines = [x for x in lines if digest(x, min_chars) not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(b"\n".join(lines))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_lines", "n_dropped", "text"])

    return run


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, shard_lines: int = SHARD_LINES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and the text that is left, per row."""
    rows = texts(docs)
    lost = stored(lost_lines(suspects(rows.select("_d", "_k", "text"), min_chars, shard_lines, group_bytes), min_docs), "line_lost")
    return rows.join(lost, ["_d", "_k"], "left").select("doc_id", "text", "lost").mapInArrow(_drop(min_chars), "doc_id long, n_lines long, n_dropped long, text string")
