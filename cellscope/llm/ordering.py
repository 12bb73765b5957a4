"""Global order of a distributed table: sorted ranges, numbers inside them, prefix sums over them.

No window runs over the whole table or over a whole group. Rows are dealt by range and sorted;
`monotonically_increasing_id` then numbers them inside their partition without another shuffle,
and what lies before a partition comes from one row for each partition (and group).
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import staged

#: monotonically_increasing_id: the partition is above these bits, the row's number below.
_ROW_BITS = 33


def in_order(df: DataFrame, by: list[str], name: str, made: list[str]) -> DataFrame:
    """`df` with `_part` and `_at`: partition k holds the k-th stretch of the order by `by`, `_at`
    numbers its rows from 0. Nulls come first. Equal rows are told apart by where they were read,
    so that many of them still fall into several partitions. Written once before the ranges are
    sampled (the sample then reads those files, not the source) and once in order."""
    rows = staged(df.withColumn("_tie", F.monotonically_increasing_id()), f"{name}-read", made)
    keys = [*by, "_tie"]
    number = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie").withColumn("_number", number)
    ranged = staged(ranged, f"{name}-ordered", made)
    return (ranged.withColumn("_part", F.shiftright("_number", _ROW_BITS))
            .withColumn("_at", F.col("_number").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).drop("_number"))


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Equality of all keys, null equal to null."""
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


def positions(df: DataFrame, group: list[str], by: list[str], name: str, made: list[str]) -> DataFrame:
    """`df` with `pos`, the row's number from 0 in the order `by` of its group, and `group_rows`.

    A group of any size spreads over partitions; the only window orders one row for each group and
    partition. That small table is written, so that the join knows its size."""
    rows = in_order(df, [*group, *by], name, made)
    runs = rows.groupBy(*group, "_part").agg(F.min("_at").alias("lo"), F.count("*").alias("n"))
    inside = Window.partitionBy(*group)
    before = F.coalesce(F.sum("n").over(inside.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = staged(runs.select(*group, "_part", (before - F.col("lo")).alias("_shift"), F.sum("n").over(inside).alias("group_rows")),
                  f"{name}-runs", made)
    return (rows.join(runs, same(rows, runs, [*group, "_part"]))
            .select(*[rows[c] for c in df.columns], (rows["_at"] + runs["_shift"]).alias("pos"), runs["group_rows"]))
