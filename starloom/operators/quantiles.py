"""Exact discrete quantiles in bounded memory.

``percentile_disc`` keeps every distinct value of a group in one task, and
approximate quantiles may return the maximum for a 99th percentile.  The operator
here narrows down to the exact value in passes over the needed columns, each a hash
aggregate with map-side combining followed by a running total over bucket counts:

1. buckets of equal width in log2: 256 per power of two, a million for all doubles;
2. 2^20 equal slices between the least and greatest value of the chosen bucket;
3. the distinct values of the chosen slice, which spans less than 3e-9 of its value.

A bucket keeps the least and greatest value found in it.  Where both are the same, that
value is the result and the group needs no further pass: small whole numbers take one,
amounts of money two.  Bucket numbers never decrease as values grow, so each pass splits
the rows exactly and the third ends on the true value.  A value repeated by a third of all
rows is one bucket entry.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.joins import LOOKUP_ROWS, hot_keys, left_join_chain, small_copy

STEPS_PER_OCTAVE = 256
SLICES = 1 << 20

# log2 of a finite double lies in -1074 .. 1024; infinity gets the next number.
_INFINITY_EXPONENT = 1025.0
_EXPONENT_SHIFT = 1100


def _log_bucket(x: Column) -> Column:
    """A whole number that never decreases as ``x`` grows."""
    exponent = F.least(F.log2(F.abs(x)), F.lit(_INFINITY_EXPONENT))
    step = F.floor((exponent + _EXPONENT_SHIFT) * STEPS_PER_OCTAVE)
    return F.when(x == 0, F.lit(0).cast("bigint")).otherwise(F.signum(x).cast("int") * step)


def _slice(x: Column, low: Column, high: Column) -> Column:
    """Position of ``x`` between ``low`` and ``high`` in whole steps."""
    position = F.floor((x - low) / (high - low) * SLICES)
    return F.when(high > low, position).otherwise(F.lit(0).cast("bigint"))


def _choose(counts: DataFrame) -> DataFrame:
    """Per group, the bucket with the value of the wanted rank, and the rank within it."""
    running = (
        Window.partitionBy("g")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = F.col("upto") - F.col("rows")
    return (
        counts.withColumn("upto", F.sum("rows").over(running))
        .where((F.col("upto") >= F.col("rank")) & (before < F.col("rank")))
        .select("g", "low", "high", (F.col("rank") - before).alias("rank"))
    )


def _tally(*more: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        *more,
    ]


def _numbers(df: DataFrame, value: str, by: str) -> DataFrame:
    """Group and number of every row that has both; NaN is no number."""
    return df.select(F.col(by).alias("g"), F.col(value).cast("double").alias("x")).where(
        F.col("g").isNotNull() & F.col("x").isNotNull() & ~F.isnan("x")
    )


def _first_pass(numbers: DataFrame, share: float) -> DataFrame:
    counts = numbers.groupBy("g", _log_bucket(F.col("x")).alias("bucket")).agg(*_tally())
    total = F.sum("rows").over(Window.partitionBy("g"))
    rank = F.ceil(F.lit(Decimal(str(share))) * total).cast("bigint")
    return _choose(counts.withColumn("rank", rank))


INSIDE = "x BETWEEN low AND high"


def _slices(chosen: DataFrame, join: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The slice of each chosen bucket; ``join`` brings the buckets to the numbers."""
    position = _slice(F.col("x"), F.col("low"), F.col("high")).alias("bucket")
    counts = join(chosen).where(INSIDE).groupBy("g", position)
    return _choose(counts.agg(*_tally(F.max("rank").alias("rank"))))


def _values(chosen: DataFrame, join: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The value in each chosen slice."""
    counts = join(chosen).where(INSIDE).groupBy("g", F.col("x").alias("bucket"))
    return _choose(counts.agg(*_tally(F.max("rank").alias("rank"))))


def quantile_of_few(
    df: DataFrame, value: str, share: float, by: str, groups: Sequence
) -> DataFrame:
    """The least value with at least ``share`` of its group's values at or below it.

    For a handful of named groups: one row for each of ``groups`` is broadcast and the
    plan stays lazy; the third pass meets an empty broadcast where no group needs it, and
    adaptive execution leaves it out.  Rows of other groups are left out; more than
    ``LOOKUP_ROWS`` names raise.  Returns ``by`` and ``value``; NULL and NaN are no values,
    groups without a value are left out, and rows whose group is NULL belong to no group.
    """
    if len(groups) > LOOKUP_ROWS:
        raise ValueError(f"at most {LOOKUP_ROWS} groups can be named")
    numbers = _numbers(df, value, by).where(F.col("g").isin(list(groups)))
    join = lambda chosen: numbers.join(F.broadcast(chosen), "g")
    slices = _slices(_first_pass(numbers, share), join)
    done, open_ = slices.where("low = high"), slices.where("low < high")
    found = done.unionByName(_values(open_, join))
    return found.select(F.col("g").alias(by), F.col("low").alias(value))


def group_quantile(
    df: DataFrame, value: str, share: float, by: str, max_groups: int = LOOKUP_ROWS
) -> DataFrame:
    """As ``quantile_of_few``, for any number of groups.

    The first pass is run at once.  If it finds up to ``max_groups`` groups, their buckets are
    broadcast to the next passes, and those are left out once every bucket holds a single
    value: small whole numbers take one pass, amounts of money two.  Beyond that the buckets
    are joined by shuffle, and rows of hot groups stay in place.
    """
    numbers = _numbers(df, value, by)
    first = _first_pass(numbers, share)
    found = small_copy(first, max_groups)
    if found is None:
        hot = hot_keys(numbers, "g")
        join = lambda chosen: left_join_chain(numbers, [chosen], "g", hot)
        found = _values(_slices(first, join), join)
    else:
        join = lambda chosen: numbers.join(F.broadcast(chosen), "g")
        for narrow in (_slices, _values):
            if found.where("low < high").isEmpty():
                break
            found = small_copy(narrow(found, join), max_groups)
    return found.select(F.col("g").alias(by), F.col("low").alias(value))
