"""Day ranges of any length as equi-join keys.

A range [start, end] is covered by disjoint pieces: single days at its ends, blocks of 32 days further in,
then blocks of 32 x 32 days, and so on. A week is its days; a hundred years are some
hundred pieces. A day lies in one block of each level, so "day in range" becomes an equi join on
(level, block) with a key for each level that occurs among the ranges, and each pair meets once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 32 to the power of a level days are one of its blocks; four levels above the days span every date.
BITS, TOP_LEVEL = 5, 4

PIECES = "array<struct<level:int,block:int>>"


def _blocks(level: Column, lo: Column, hi: Column) -> Column:
    """The blocks lo, lo + 1 ... hi - 1 of a level."""
    some = F.transform(F.sequence(lo, hi - 1), lambda b: F.struct(level.alias("level"), b.alias("block")))
    return F.when(lo < hi, some).otherwise(F.array().cast(PIECES))


def range_pieces(start: Column, end: Column) -> Column:
    """The pieces that cover [start, end]; none when start is after end, NULL when either is."""
    def level_up(acc: Column, level: Column) -> Column:
        lo, hi = acc["lo"], acc["hi"]
        up, down = F.shiftright(lo + (1 << BITS) - 1, BITS), F.shiftright(hi, BITS)
        inner = (level < TOP_LEVEL) & (up < down)  # some block of the next level lies within
        pieces = F.when(inner, F.concat(_blocks(level, lo, F.shiftleft(up, BITS)), _blocks(level, F.shiftleft(down, BITS), hi))) \
            .otherwise(_blocks(level, lo, hi))
        return F.struct(F.when(inner, up).otherwise(0).alias("lo"), F.when(inner, down).otherwise(0).alias("hi"),
                        F.concat(acc["out"], pieces).alias("out"))

    first, last = F.unix_date(start), F.unix_date(end) + 1
    zero = F.struct(first.alias("lo"), last.alias("hi"), F.array().cast(PIECES).alias("out"))
    return F.when(first < last, F.aggregate(F.sequence(F.lit(0), F.lit(TOP_LEVEL)), zero, level_up, lambda acc: acc["out"])) \
        .when(first.isNotNull() & last.isNotNull(), F.array().cast(PIECES))


def days_in_ranges(days: DataFrame, ranges: DataFrame, keys: Sequence[tuple[str, str]], day: str, start: str, end: str) -> DataFrame:
    """Rows of ``days`` and ``ranges`` (distinct column names) whose keys are equal and whose ``day`` is in [start, end].

    The levels that occur (five at most) are read once; ranges of up to a month have one, so ``days`` isn't multiplied.
    Spark takes the pieces for as small as the ranges they come from, so the join is asked for as a sort-merge
    join: a broadcast would bring every piece to the driver.
    """
    pieces = ranges.withColumn("__piece", F.explode(range_pieces(F.to_date(start), F.to_date(end))))
    levels = pieces.select(F.array_sort(F.collect_set("__piece.level"))).scalar()
    number = F.unix_date(F.to_date(day))
    keyed = days.withColumn("__levels", levels).withColumn(
        "__key", F.explode(F.transform("__levels", lambda x: F.struct(x.alias("level"), F.call_function("shiftright", number, x * BITS).alias("block")))))
    on = F.col("__key") == F.col("__piece")
    for a, b in keys:
        on = on & (keyed[a] == pieces[b])
    return keyed.join(pieces.hint("merge"), on).drop("__levels", "__key", "__piece")
