"""Helpers shared by the operators: row identity, stored intermediate tables, connected components.

Row identity. ``doc_id`` may be null or repeated, so operators that join back to their input
use the pair (``_d``, ``_k``): the id (null: the largest long, so it sorts last) and a 64-bit
hash of id and text. Rows that repeat both id and text are one document and get equal results.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnup.session import checkpoint_dir

MAX_LONG = 2**63 - 1


def doc_key(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(MAX_LONG))


def text_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text))


def texts(docs: DataFrame) -> DataFrame:
    """(_d, _k, doc_id, text) of a documents table; other columns are not read. Null text: empty."""
    return docs.select(doc_key().alias("_d"), text_key().alias("_k"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def table_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")


#: Bytes of rows handed to a Python worker at once.
ARROW_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers (what ``--py-files`` does), wherever the driver found it,
    and bound the batches they get by bytes: rows may be whole long texts."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    if getattr(sc, "_burnup_shipped", False):
        return
    root = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp(prefix="burnup-py-")) / "burnup.zip"  # the driver serves it from here
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._burnup_shipped = True


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when each ends, not when the driver's garbage is collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts lineage and survives lost executors."""
    path = table_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that no later plan reads."""
    spark = df.sparkSession
    for f in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_schema(rows: DataFrame, more: str) -> T.StructType:
    """The struct column ``row`` as it is, whatever its fields' names, and further columns in DDL."""
    return T.StructType([rows.schema["row"], *T.StructType.fromDDL(more).fields])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from every node of ``edges`` (u, v: long).

    Alternating large-star and small-star rounds: every node links its larger, then its
    smaller neighbours to its smallest one, until nothing changes (O(log n) rounds in practice).
    The minimum per node is pre-aggregated before its shuffle and joined back, so a node with
    very many neighbours is never gathered; AQE splits such a node in the join. Each round is a
    table in the shared folder.
    """
    cur = stored(edges.where(F.col("u") != F.col("v"))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        # v <= u holds in every row here, so the small star is the row set itself
        small = (large.join(low2, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u != v").distinct())
        nxt = stored(small, "cc")
        mark = tuple(nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(cur)
        cur = nxt
        if mark == seen:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
    raise RuntimeError("connected components did not settle")
