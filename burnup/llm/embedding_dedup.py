"""Near-duplicate embeddings: sign hashing by random hyperplanes in several tables, exact cosines, components (operator 5).

Equal vectors are one class with a count, so copies cost nothing further. Each class gets a bucket
per table: the signs of its products with the table's hyperplanes. The number of planes follows from
the number of classes (``BUCKET_ROWS`` to a bucket if they were spread evenly) and the number of
tables from that: so many that a pair at the threshold meets in one with probability ``RECALL``.
Every bucket is compared in full, in double precision: one of more than ``HOT_ROWS`` classes is cut
into blocks of about half as many, and each pair of blocks is a task's work, so no bucket is too
large and none is capped. A pair that meets in several tables counts in the first only. Links are
never listed: a task returns each class's number of links found there and one link that joins it
with its group; connected components follow in Spark.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing (n_links 0, component_id = vec_id); vectors of different lengths don't link; a null vec_id
names no component and is never kept; rows that repeat a vec_id are vectors of their own; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnup.llm.base import connected_components, stored
from burnup.llm.simhash_dedup import united

THRESHOLD, RECALL, SEED = 0.9, 0.999, 11
BUCKET_ROWS, HOT_ROWS = 512, 4096
#: Rows of a block of cosines.
TILE = 512


def tables(classes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(planes per table, tables) for so many classes."""
    planes = min(30, max(4, math.ceil(math.log2(max(classes, 1) / BUCKET_ROWS)) if classes > BUCKET_ROWS else 4))
    meet = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _class(embedding: Column) -> Column:
    """Name of a vector's class: 128 bits of hash of its components; null if it links with nothing."""
    e = embedding.cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(e, lambda x: x != 0)
    e = F.transform(e, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))  # -0.0 is 0.0
    return F.when(fine, F.concat(F.hex(F.xxhash64(e)), F.lit("-"), F.hex(F.xxhash64(F.lit(SEED), e))))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # lengths neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _signs(planes: int, n_tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            size = np.diff(np.asarray(batch["embedding"].offsets))
            sig = np.zeros((len(batch), n_tables), np.int32)
            for dim in np.unique(size):
                if dim not in made:
                    made[dim] = np.random.default_rng([SEED, int(dim)]).standard_normal((dim, n_tables * planes))
                at = np.flatnonzero(size == dim)
                x = _matrix(batch["embedding"].take(pa.array(at)), dim)
                up = (x @ made[dim] > 0).reshape(len(at), n_tables, planes)
                sig[at] = (up << np.arange(planes)).sum(axis=2)
            lists = pa.ListArray.from_arrays(pa.array((np.arange(len(batch) + 1) * n_tables).astype(np.int32)), pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([batch["c"], batch["n"], batch["first"], batch["embedding"], lists], names=["c", "n", "first", "embedding", "sig"])

    return run


def group_links(x: np.ndarray, n: np.ndarray, sig: np.ndarray, side: np.ndarray | None, table: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links weighted by count, smallest linked index) of each row of one bucket, or of two of its blocks."""
    links, sets = np.zeros(len(x), np.int64), []
    left, right = (np.arange(len(x)),) * 2 if side is None else (np.flatnonzero(~side), np.flatnonzero(side))
    for a in range(0, len(left), TILE):
        i0 = left[a: a + TILE]
        for b in range(a if side is None else 0, len(right), TILE):
            j0 = right[b: b + TILE]
            i, j = np.nonzero(x[i0] @ x[j0].T >= threshold)
            i, j = i0[i], j0[j]
            if side is None:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            sets.append(united_pairs(i, j))
            new = ~(sig[i, :table] == sig[j, :table]).any(axis=1)
            i, j = i[new], j[new]
            links += np.bincount(i, n[j], len(x)).astype(np.int64) + np.bincount(j, n[i], len(x)).astype(np.int64)
    return links, united(len(x), iter(sets))


def united_pairs(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A tree of links in place of a tile's pairs."""
    nodes, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    root = united(len(nodes), iter([(at[: len(i)], at[len(i):])]))
    other = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[other], nodes[root[other]]


def _compare(threshold: float):
    def group(t: pa.Table) -> pa.RecordBatch | None:
        first = t.slice(0, 1).to_pylist()[0]
        if len(t) < 2:
            return None
        t = t.combine_chunks()
        lists = pa.concat_arrays(t["embedding"].chunks)
        x = _matrix(lists, first["dim"])
        sig = pa.concat_arrays(t["sig"].chunks).flatten().to_numpy().reshape(len(t), -1)
        block = t["block"].to_numpy()
        side = None if first["i"] == first["j"] else block == first["j"]
        links, root = group_links(x, t["n"].to_numpy(), sig, side, first["t"], threshold)
        some = np.flatnonzero((links > 0) | (root != np.arange(len(t))))
        names = pa.concat_arrays(t["c"].chunks)
        return pa.RecordBatch.from_arrays([names.take(pa.array(some)), pa.array(links[some]), names.take(pa.array(root[some]))], names=["c", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch[c].to_numpy() for c in ("t", "dim", "bucket", "i", "j")], axis=1)
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            bounds = [0, *ends.tolist(), len(batch)]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                key = tuple(keys[a])
                if held and key != last:
                    if (out := group(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                held.append(batch.slice(a, b - a))
                last = key
        if held and (out := group(pa.Table.from_batches(held))) is not None:
            yield out

    return run


def class_links(classes: DataFrame, n_tables: int, threshold: float = THRESHOLD, hot: int = HOT_ROWS) -> DataFrame:
    """(c, links, root): links found per class and task, and a class it is joined with there."""
    dim = F.size("embedding").alias("dim")
    keys = classes.select("c", dim, F.posexplode("sig").alias("t", "bucket"))
    large = keys.groupBy("t", "dim", "bucket").count().where(F.col("count") > hot)
    cuts = (keys.join(large, ["t", "dim", "bucket"]).groupBy("c")
            .agg(F.map_from_entries(F.collect_list(F.struct("t", F.ceil(F.col("count") * 2 / hot).cast("int")))).alias("cuts")))  # one entry a table
    rows = classes.join(cuts, "c", "left").select("c", "n", "embedding", "sig", "cuts", dim, F.posexplode("sig").alias("t", "bucket"))
    n_blocks = F.coalesce(F.element_at("cuts", F.col("t")), F.lit(1))
    rows = rows.withColumn("blocks", n_blocks).withColumn("block", F.pmod(F.xxhash64("c", "t"), F.col("blocks")).cast("int"))
    rows = rows.select("t", "dim", "bucket", "block", "c", "n", "embedding", "sig", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"))
    rows = rows.select("t", "dim", "bucket", F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"), "block", "c", "n", "embedding", "sig")
    key = ["t", "dim", "bucket", "i", "j"]
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(_compare(threshold), "c string, links long, root string")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept per row."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), _class(F.col("embedding")).alias("c"), F.col("embedding").cast("array<double>").alias("embedding"))
    classes = (rows.where("c is not null").groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"), F.first("embedding").alias("embedding")))
    classes = stored(classes, "emb_classes")
    planes, n_tables = tables(classes.count(), threshold, recall)
    signed = stored(classes.mapInArrow(_signs(planes, n_tables), "c string, n long, first long, embedding array<double>, sig array<int>"), "emb_signed")
    found = stored(class_links(signed, n_tables, threshold), "emb_links")
    roots = connected_components(found.select(F.col("c").alias("u"), F.col("root").alias("v")))
    sums = found.groupBy("c").agg(F.sum("links").alias("links"))
    known = (signed.select("c", "n", "first").join(sums, "c", "left").join(roots.withColumnRenamed("node", "c"), "c", "left")
             .withColumn("root", F.coalesce("root", "c")))
    names = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(names, "root").select("c", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", "c").join(known, "c", "left")
    component = F.when(F.col("c").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
