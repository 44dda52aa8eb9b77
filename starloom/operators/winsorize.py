"""Cap the upper tail of numeric columns at a global quantile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.quantiles import quantile_of_few


def upper_caps(df: DataFrame, columns: Sequence[str], share: float) -> DataFrame:
    """One row with the ``share`` quantile of every column (NULL without values)."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "metric", "value"
    )
    caps = quantile_of_few(long, "value", share, "metric", columns)
    return caps.agg(
        *[F.max(F.when(F.col("metric") == c, F.col("value"))).alias(c) for c in columns]
    )


def winsorize(df: DataFrame, columns: Sequence[str], share: float = 0.99) -> DataFrame:
    """Replace values above the column's ``share`` quantile by that quantile.

    The caps reach the rows as a one-row scalar subquery, so the plan stays lazy and
    an empty table passes through.
    """
    caps = upper_caps(df, columns, share).select(F.struct(*columns).alias("caps"))
    return (
        df.withColumn("_caps", caps.scalar())
        .withColumns(
            {
                # least() skips NULL, so a missing value must be kept apart.
                c: F.when(F.col(c).isNotNull(), F.least(F.col(c), F.col("_caps")[c]))
                for c in columns
            }
        )
        .drop("_caps")
    )


def keep_raw(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Copy columns to ``raw_<name>`` before they are cleaned."""
    return df.withColumns({f"raw_{c}": F.col(c) for c in columns})
