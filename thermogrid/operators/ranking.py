"""Positions in an order without a one-partition window or one hot group.

``positions`` numbers rows 0, 1, 2, ... within a group (or over the whole
table) by an integer key that is unique within the group. The key range is cut
into bins of ``width`` keys, these into bins of ``width`` bins, and so on until at most
``width`` (and two) bins are left, however sparse the keys are: hashed 64-bit keys take
six levels, dense ones two. Counts per bin are partial aggregates, each level's from
the one below, and the offsets come from windows over the counts inside one parent bin. Only
the last step, a row number inside one bin, touches single rows, and a bin holds at
most ``width`` of them. A group holding a third of all rows is therefore spread over as
many tasks as any other data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_levels(low: int, high: int, width: int) -> list[int]:
    """Shifts of the key that give the bins of each level, finest first."""
    bits = max(1, int(width).bit_length() - 1)
    shifts = [bits]
    while ((high >> shifts[-1]) - (low >> shifts[-1])) + 1 > width + 2:
        shifts.append(shifts[-1] + bits)
    return shifts


def positions(df: DataFrame, key: str, groups=(), width: int = 1024, out: str = "pos",
              size: str | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row by ``key`` within ``groups``.

    ``size`` (optional) names a column that receives the group's row count.
    ``key`` must be an integer column, unique within a group. The least and the greatest
    key are fetched first (one row).
    """
    groups = list(groups)
    k = F.col(key).cast("long")
    low, high = df.agg(F.min(k), F.max(k)).first()
    shifts = key_levels(low, high, width) if low is not None else key_levels(0, 0, width)
    bins = [f"_b{i}" for i in range(len(shifts))]
    x = df.withColumn("_b0", F.shiftright(k, shifts[0]))
    levels = [x.groupBy(*groups, "_b0").agg(F.count(F.lit(1)).alias("_n"))]
    for i in range(1, len(shifts)):
        up = F.shiftright(F.col(bins[i - 1]), shifts[i] - shifts[i - 1]).alias(bins[i])
        levels.append(levels[-1].groupBy(*groups, up).agg(F.sum("_n").alias("_n")))
    along = lambda i, *by: Window.partitionBy(*groups, *by).orderBy(bins[i]).rowsBetween(Window.unboundedPreceding, 0)
    top = len(shifts) - 1
    offs = levels[top].withColumn("_off", F.sum("_n").over(along(top)) - F.col("_n"))
    if size:
        offs = offs.withColumn(size, F.sum("_n").over(Window.partitionBy(*groups)))
    more = [size] if size else []
    offs = offs.select(*groups, bins[top], "_off", *more)
    for i in range(top - 1, -1, -1):
        up = F.shiftright(F.col(bins[i]), shifts[i + 1] - shifts[i])
        inner = levels[i].withColumn(bins[i + 1], up)
        inner = inner.withColumn("_in", F.sum("_n").over(along(i, bins[i + 1])) - F.col("_n"))
        offs = (inner.join(offs, [*groups, bins[i + 1]])
                .select(*groups, bins[i], (F.col("_off") + F.col("_in")).alias("_off"), *more))
    local = Window.partitionBy(*groups, "_b0").orderBy(key)
    return (x.join(offs, [*groups, "_b0"])
            .withColumn(out, (F.col("_off") + F.row_number().over(local) - 1).cast("long"))
            .drop("_b0", "_off"))
