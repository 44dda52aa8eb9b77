"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the least one by ``order``, then by the remaining columns.

    Which row survives does not depend on how the data is laid out.  It is an
    aggregate, not a window: copies of a key collapse before the shuffle, so a key
    with a third of the rows costs one row per task.  Exact copies go first, by hash;
    only what is left is sorted for its least row.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = list(order or ())
    ordered += [c for c in rest if c not in ordered]
    least = F.min(F.struct(*ordered)).alias("_row")
    return df.distinct().groupBy(*keys).agg(least).select(
        *[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df`` itself, or an error if a key (other than a missing one) occurs twice."""
    whole = df.select(*keys).dropna()
    twice = duplicate_keys(whole, keys).first()
    if twice is not None:
        raise ValueError(f"{name} holds {twice.asDict()}; it must be unique in {list(keys)}")
    return df
