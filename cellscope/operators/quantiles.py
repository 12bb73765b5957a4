"""Exact quantiles of groups of any size (E14h, Q15): radix selection over counted values.

The input holds each distinct value of a group once, with its number of rows, which a map-side
combine makes. The values are laid into bins of `unit << shift` width, and running counts over a
group's bins tell which bins hold the ranks asked for; the next, finer shift splits those bins
alone, and the last step ranks the distinct values inside the bins that are left. So no task holds
a group: a window sees at most the bins between two shifts, or the distinct values of one bin.
For fixed-point values in steps of `unit` both are bounded, whatever the number of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranks(probs: tuple[float, ...], total: Column) -> Column:
    """The two rows around each quantile's position (linear interpolation, as percentile_cont)."""
    picks = []
    for i, p in enumerate(probs):
        position = F.lit(p) * (total - 1).cast("double")
        for high, row in ((False, F.floor(position)), (True, F.ceil(position))):
            picks.append(F.struct(F.lit(i).alias("q"), F.lit(high).alias("high"), row.cast("long").alias("rank"),
                                  F.abs(position - row.cast("double")).alias("far")))
    return F.array(*picks)


def _inside(ranked: DataFrame, order: str, by: list[str], picks: Column | None, probs: tuple[float, ...]) -> DataFrame:
    """Rows of `ranked` (with `_n`) that hold ranks, which become ranks inside the row."""
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy(order))
    if picks is None:
        picks = _ranks(probs, F.sum("_n").over(Window.partitionBy(*by)))
    found = ranked.select("*", (upto - F.col("_n")).alias("_before"), picks.alias("_all"))
    held = F.filter("_all", lambda x: (x["rank"] >= F.col("_before")) & (x["rank"] < F.col("_before") + F.col("_n")))
    return (found.withColumn("_held", F.transform(held, lambda x: x.withField("rank", x["rank"] - F.col("_before"))))
            .where(F.size("_held") > 0))


def exact_quantiles(counted: DataFrame, keys: list[str], value: str, weight: str, probs: tuple[float, ...],
                    unit: float, shifts: tuple[int, ...]) -> DataFrame:
    """Quantiles `probs` of `value` per `keys`, each value taken `weight` times: the columns `keys` (of
    any value, null too) and `quantiles`, an array of doubles in the order of `probs`.

    `unit` is the step of the values and `shifts` the descending binary widths of the bins in steps; both
    only decide how the work is dealt, not the result. Null values are left out, and groups without others have no row."""
    v = F.col(value).cast("double")
    base = (counted.where(F.col(value).isNotNull())
            .select(*keys, v.alias("_v"), F.col(weight).cast("long").alias("_n"), F.floor(v / F.lit(unit)).cast("long").alias("_code")))
    bin_of = lambda shift: F.shiftright("_code", shift)

    bins = base.groupBy(*keys, bin_of(shifts[0]).alias("_bin")).agg(F.sum("_n").alias("_n"))
    chosen = _inside(bins, "_bin", keys, None, probs)
    for shift, finer in zip(shifts, (*shifts[1:], None)):
        own = chosen.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bin").alias("_outer"), F.col("_held").alias("_picks"))
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        inner = base.join(own, reduce(Column.__and__, [*same, bin_of(shift) == F.col("_outer")]))
        by = [*keys, "_outer"]
        if finer is None:
            chosen = _inside(inner, "_v", by, F.col("_picks"), probs)
        else:
            parts = inner.groupBy(*by, "_picks", bin_of(finer).alias("_bin")).agg(F.sum("_n").alias("_n"))
            chosen = _inside(parts, "_bin", by, F.col("_picks"), probs)

    ends = chosen.select(*keys, "_v", F.explode("_held").alias("_p"))

    def end(i: int, high: bool, what: str) -> Column:
        return F.max(F.when((F.col("_p.q") == i) & (F.col("_p.high") == high), F.col(what)))

    found = [c for i in range(len(probs)) for c in (
        end(i, False, "_v").alias(f"_lo{i}"), end(i, True, "_v").alias(f"_hi{i}"),
        end(i, False, "_p.far").alias(f"_past{i}"), end(i, True, "_p.far").alias(f"_ahead{i}"))]

    def between(i: int) -> Column:
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return F.when(lo == hi, lo).otherwise(F.col(f"_ahead{i}") * lo + F.col(f"_past{i}") * hi)

    return ends.groupBy(*keys).agg(*found).select(*keys, F.array(*[between(i) for i in range(len(probs))]).alias("quantiles"))
