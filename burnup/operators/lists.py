"""Whole id lists in ordered pieces (A5, A8, A14): no task and no cell holds a whole group.

``string_agg`` over a group makes one cell as long as the group. Here the rows are put in order of group and id by
ranges, numbered from stored ranges, and cut into pieces of ``size`` ids by their place in the group. The pieces of a
group, joined in order, are the warehouse's list; duplicates stay, also one id repeated very often.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnup.sources.landing import assign_keys

PIECE_IDS = 1000


def listagg_pieces(df: DataFrame, group_cols: Sequence[str], id_col: str, list_col: str, size: int = PIECE_IDS, sep: str = ", ", piece_col: str = "piece") -> DataFrame:
    """Group columns, ``piece_col`` (0, 1, 2...) and ``list_col``: the group's ids in order, ``size`` to a piece.

    NULL ids are left out, as string_agg does; a NULL group is a group; no rows give no pieces.
    """
    group = F.struct(*group_cols) if group_cols else F.struct(F.lit(0))
    rows = df.where(F.col(id_col).isNotNull()).select(*group_cols, F.col(id_col).alias("__id"))
    # equal rows are told apart, so that ranges can part them too
    rows = rows.withColumn("__order", F.struct(group.alias("g"), F.col("__id").alias("i"), F.monotonically_increasing_id().alias("n")))
    placed = assign_keys(rows, "__order", 0, "__place").withColumn("__g", F.col("__order.g")).drop("__order")
    first = placed.groupBy("__g").agg(F.min("__place").alias("__first"))  # combined before it is shuffled
    pieces = placed.join(first, placed["__g"].eqNullSafe(first["__g"])).withColumn(piece_col, F.expr(f"(__place - __first) div {size}")) \
        .select(*group_cols, piece_col, F.struct("__place", F.col("__id").cast("string").alias("id")).alias("__x"))
    # shuffled on (group, piece): a partitioning on the group alone would keep a hot one in one task
    cells = pieces.repartition(*group_cols, piece_col).groupBy(*group_cols, piece_col).agg(F.array_sort(F.collect_list("__x")).alias("__ids"))
    return cells.select(*group_cols, piece_col, F.array_join(F.transform("__ids", lambda x: x["id"]), sep).alias(list_col))
