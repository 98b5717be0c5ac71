"""Exact order statistics per group, by one plan whatever the size of a group.

1. Values are counted per (group, value): repeated values shrink before any shuffle, and a
   group that holds most rows is spread over all tasks.
2. The counts are added up per coarse interval, 32 to a doubling of the value, so a group has at most
   some ten thousand of them, and a running sum tells which of them hold a rank.
3. Only the values of those intervals go on. Where an interval has more than a few thousand different
   ones, their counts are added up per fine interval, 65,536 to a coarse one, and a running sum tells
   again which hold a rank.
4. Only the values of the interval that was found last are walked, each on its own.

Nothing is sampled, capped or brought to the driver, and no figure of the data changes the plan. All
comparisons of keys are null-safe, also those of interval numbers: Spark would otherwise demand a
number in one use of the counts and not in the other, and then shuffle them twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

PER_DOUBLING = 1 << 21  # fine intervals
COARSE_BITS = 16  # a coarse interval is so many halvings wider
WALKED = 4096  # different values of a coarse interval that are walked without a finer one
ABOVE = 1100  # added to the logarithm, so that the smallest number has a positive one
LAST = (ABOVE + 1100) * PER_DOUBLING  # above the largest finite double; infinities share it

Position = Callable[[Column], Column]  # rows in the group -> zero-based rank

MEDIAN_POSITIONS: list[Position] = [
    lambda n: F.floor((n - 1) / 2).cast("bigint"),
    lambda n: F.floor(n / 2).cast("bigint"),
]


def interval_of(value: str) -> Column:
    """The number of a value's fine interval. It grows with the value; NaN comes last, as in
    sorting."""
    size = (F.log2(F.abs(value)) + float(ABOVE)) * float(PER_DOUBLING)
    number = F.floor(F.least(size, F.lit(float(LAST)))).cast("bigint")
    return (
        F.when(F.isnan(F.col(value).cast("double")), LAST + 1)
        .when(F.col(value) == 0, 0)
        .when(F.col(value) < 0, -number)
        .otherwise(number)
    )


def _upto(keys: Sequence[str], order: str):
    return W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)


def values_at(
    values: DataFrame, keys: Sequence[str], value: str, positions: Sequence[Position]
) -> DataFrame:
    """(keys, n, p0, p1, ...): the values at the given zero-based ranks of each group, spread over as
    many rows as there are different values; a row is null where a rank has another value.

    ``values`` must hold no null values; keys may be null.
    """
    keys = list(keys)
    inner = [f"_k{i}" for i in range(len(keys))]

    def holds(position: Position) -> Column:
        rank = position(F.col("_n"))
        return (F.col("_start") <= rank) & (rank < F.col("_end"))

    def any_rank() -> Column:
        wanted = holds(positions[0])
        for one in positions[1:]:
            wanted = wanted | holds(one)
        return wanted

    def holding(parts: DataFrame, within: Sequence[str], order: str, base: Column) -> DataFrame:
        """The parts that hold a rank, by a running sum of their counts above a base."""
        return (
            parts.withColumn("_end", base + F.sum("_c").over(_upto([*inner, *within], order)))
            .withColumn("_start", F.col("_end") - F.col("_c"))
            .where(any_rank())
        )

    def inside(rows: DataFrame, found: DataFrame, interval: str) -> DataFrame:
        """The rows in the intervals that were found, with the rank at which their interval starts."""
        on = [*inner, interval]
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"f.{k}")) for k in on]
        return (
            rows.drop("_base", "_n", "_d").alias("r")
            .join(found.select(*on, F.col("_start").alias("_base"), "_n", "_d").alias("f"), same)
            .select("r.*", "f._base", "f._n", "f._d")
        )

    counted = (
        values.groupBy(*[F.col(k).alias(i) for k, i in zip(keys, inner)], F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_fine", interval_of("_v"))
        .withColumn("_coarse", F.shiftright("_fine", COARSE_BITS))
    )
    # In the order of the running sum, so that one sort and one pass serve both.
    whole = W.partitionBy(*inner).orderBy("_coarse").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    sums = (
        counted.groupBy(*inner, "_coarse")
        .agg(F.sum("_c").alias("_c"), F.count(F.lit(1)).alias("_d"))
        .withColumn("_n", F.sum("_c").over(whole))
    )
    base = F.col("_base")
    wanted = holding(sums, [], "_coarse", F.lit(0))
    near = inside(counted, wanted.where(F.col("_d") <= WALKED), "_coarse")
    wide = inside(counted, wanted.where(F.col("_d") > WALKED), "_coarse")
    finer = wide.groupBy(*inner, "_coarse", "_fine").agg(
        F.sum("_c").alias("_c"), *[F.max(c).alias(c) for c in ("_base", "_n", "_d")]
    )
    deep = inside(wide, holding(finer, ["_coarse"], "_fine", base), "_fine")
    found = holding(near, ["_coarse"], "_v", base).unionByName(holding(deep, ["_fine"], "_v", base))
    return found.select(
        *[F.col(i).alias(k) for k, i in zip(keys, inner)],
        F.col("_n").alias("n"),
        *[F.when(holds(p), F.col("_v")).alias(f"p{i}") for i, p in enumerate(positions)],
    )


def order_statistics(
    values: DataFrame, keys: Sequence[str], value: str, positions: Sequence[Position]
) -> DataFrame:
    """(keys, n, p0, p1, ...): one row for each group."""
    found = values_at(values, keys, value, positions)
    return found.groupBy(*keys).agg(*[F.max(c).alias(c) for c in found.columns if c not in keys])


def median_of(low: Column, high: Column) -> Column:
    """Halfway between two values; equal ones stay as they are, also when they are infinite."""
    return F.when(low == high, low).otherwise(low + (high - low) * F.lit(0.5))
