"""Rows stored along a space-filling curve over two columns.

Each column is cut into up to ``CELLS`` ranges of about equal rows, by boundaries
from a sample, and the bits of the two range numbers are interleaved. Rows are
range-partitioned by that number, so a file covers a small rectangle: a query by
either column skips most files by their statistics (about the square root of their
number remains). The sample decides only where rows are stored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_BITS = 6
CELLS = 1 << CELL_BITS
GROUP = 8                   # boundaries that are compared with a value one by one
SAMPLE_ROWS = 8192          # expected rows of the sample, whatever the input
PARTITION_ROWS = 2_000_000  # about as many rows as a task sorts at most, however few shuffle partitions are set


def boundaries(df: DataFrame, columns: tuple[str, str], sample_rows: int = SAMPLE_ROWS, n: int | None = None) -> dict[str, list]:
    """At most ``CELLS - 1`` ascending values of each column; ``n``: the rows, if
    they were counted."""
    n = df.count() if n is None else n
    rows = df.select(*columns).sample(min(1.0, sample_rows / max(n, 1)), seed=7).collect()      # bounded by the fraction
    out = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        out[c] = sorted({values[math.ceil(len(values) * k / CELLS) - 1] for k in range(1, CELLS)}) if values else []
    return out


def cell(column: Column, bounds: list) -> Column:
    """The number of boundaries below the value: 0 for null and the smallest.
    The last boundaries of the groups name the group to look into."""
    if not bounds:
        return F.lit(0)

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < column))

    groups = [bounds[at:at + GROUP] for at in range(0, len(bounds), GROUP)]
    lasts = [g[-1] for g in groups[:-1]]
    group = below(F.array(*map(F.lit, lasts))) if lasts else F.lit(0)
    within = below(F.get(F.array(*[F.array(*map(F.lit, g)) for g in groups]), group))
    return F.when(column.isNull(), F.lit(0)).otherwise(group * GROUP + within)


def interleave(a: Column, b: Column) -> Column:
    """The bits of two cell numbers, ``a``'s above ``b``'s."""
    out = F.lit(0)
    for bit in range(CELL_BITS):
        for c, at in ((b, 2 * bit), (a, 2 * bit + 1)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c, bit).bitwiseAND(F.lit(1)), at))
    return out


def clustered(df: DataFrame, columns: tuple[str, str], tie: str, partitions: int | None = None) -> DataFrame:
    """``df`` in files along the curve over ``columns`` (names, or SQL expressions
    over ``df``, so that what is derived from its rows need not be shuffled with
    them). Rows of one place (a hot value) are spread by the columns themselves and
    then by ``tie``. Any number of files; without ``partitions`` their sizes decide
    it. Null values come first; an empty table stays empty."""
    keys = df.select(*[F.expr(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    n = keys.count()
    bounds = boundaries(keys, tuple(keys.columns), n=n)
    if partitions is None and n > PARTITION_ROWS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        partitions = math.ceil(n / PARTITION_ROWS)
    place = interleave(*(cell(F.expr(c), b) for c, b in zip(columns, bounds.values())))
    order = (F.col("_place"), *map(F.expr, columns), F.col(tie))
    placed = df.withColumn("_place", place)
    ranged = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop("_place")
