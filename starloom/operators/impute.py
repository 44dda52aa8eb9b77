"""Fill missing values from the other rows of the same group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import lookup_join
from starloom.operators.quantiles import group_quantile
from starloom.sources.scratch import stage


def mark_missing(df: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
    """Flag the rows in which any of the columns is NULL; call it before filling."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.withColumn(flag, missing)


def group_median(df: DataFrame, column: str, by: str) -> DataFrame:
    """The lower median of a column per group, for the groups that have a value."""
    return group_quantile(df, column, 0.5, by)


def group_mode(df: DataFrame, column: str, by: str) -> DataFrame:
    """The most frequent value per group; the smaller value wins a tie."""
    counts = (
        df.where(F.col(by).isNotNull() & F.col(column).isNotNull())
        .groupBy(by, column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy(by).agg(
        F.max_by(column, F.struct(F.col("n"), -F.col(column))).alias(column)
    )


def fill_from_group(df: DataFrame, lookup: DataFrame, column: str, by: str) -> DataFrame:
    """Fill NULLs of a column from a table with one value per group."""
    named = lookup.select(by, F.col(column).alias("_fill"))
    filled = F.coalesce(F.col(column), F.col("_fill"))
    return lookup_join(df, named, by).withColumn(column, filled).drop("_fill")


def group_medians(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """The lower median of several columns per group, found in the same passes.

    One row per group that has a value in any of them; ``_by`` is the group as text.
    """
    values = [F.struct(F.lit(i).alias("which"), F.col(c).cast("double").alias("value"))
              for i, c in enumerate(columns)]
    group = F.col(by).cast("string")
    long = df.select(group.alias("_by"), F.inline(F.array(*values))).select(
        F.concat("which", F.lit(":"), "_by").alias("cell"), "value"
    )
    cells = group_quantile(long, "value", 0.5, "cell")
    which, name = F.substring_index("cell", ":", 1), F.expr("substring(cell, locate(':', cell) + 1)")
    return cells.groupBy(name.alias("_by")).agg(
        *[F.max(F.when(which == str(i), F.col("value"))).alias(f"_fill{i}") for i in range(len(columns))]
    )


def fill_group_median(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Fill NULLs with the group's median; a group without values stays NULL.

    The needed columns are staged once, all medians come from the same passes, and one
    join brings them to the rows.
    """
    needed = stage(df.select(by, *columns), "gaps")
    lookup = group_medians(needed, columns, by)
    filled = lookup_join(df.withColumn("_by", F.col(by).cast("string")), lookup, "_by")
    fills = {
        c: F.coalesce(F.col(c), F.col(f"_fill{i}").cast(df.schema[c].dataType))
        for i, c in enumerate(columns)
    }
    return filled.withColumns(fills).select(*df.columns)


def fill_group_mode(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Fill NULLs with the group's most frequent value."""
    return reduce(
        lambda out, c: fill_from_group(out, group_mode(df, c, by), c, by), columns, df
    )
