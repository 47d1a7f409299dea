"""The row before, over a whole table in order, without a task that holds all rows.

Rows are put in order by ranges and written once with their partition and place in it; inside a partition the row
before is a window's, and a partition's first row takes what the partition before it hands on: its last row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnup.session import cut_lineage


def row_before(df: DataFrame, order_cols: Sequence[str], value: Column, out_col: str) -> DataFrame:
    """``df`` with ``out_col``: ``value`` of the row before in the order of all rows (NULL for the first).

    NULLs come first. A group of any size is spread over as many ranges as its rows need; rows equal in
    ``order_cols`` stay together, in any order. An empty table gives an empty result.
    """
    ranged = cut_lineage(df.withColumn("__value", value).repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
                         .withColumn("__mono", F.monotonically_increasing_id()), "carry")
    ranged = ranged.withColumn("__pid", F.shiftright("__mono", 33))  # index in the lower 33 bits
    last = ranged.groupBy("__pid").agg(F.max_by("__value", "__mono").alias("__last"))
    handed = last.select("__pid", F.lag("__last").over(Window.orderBy("__pid")).alias("__handed"))  # one row per partition
    inside = Window.partitionBy("__pid").orderBy("__mono")
    rows = ranged.withColumns({"__prev": F.lag("__value").over(inside), "__first": F.row_number().over(inside) == 1}).join(handed, "__pid")
    return rows.withColumn(out_col, F.when(F.col("__first"), F.col("__handed")).otherwise(F.col("__prev"))) \
        .drop("__value", "__mono", "__pid", "__prev", "__first", "__handed")
