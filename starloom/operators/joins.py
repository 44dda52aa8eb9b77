"""Left joins that hold up when one key owns a large share of the rows.

Spark broadcasts a table it knows to be below ``autoBroadcastJoinThreshold`` and
otherwise sort-merges with adaptive skew splitting.  Two cases need more:

* a chain of joins on one key shuffles each input once and joins several times in
  the same stage, where adaptive execution does not split a hot key;
* a lookup side that is itself an aggregate has no shuffle of its own to split.

For both, the rows of hot keys stay where they are and meet a broadcast of just
those keys' lookup rows, while all other rows take the shuffled join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.sources.scratch import stage

# A key is hot when it owns at least this share of the rows, or the rows of one shuffle
# task if that is less, and at least HOT_ROWS.  The share bounds the number of hot keys
# (10,000, or the number of shuffle partitions), and so each broadcast.
HOT_SHARE = 1e-4
HOT_ROWS = 1_000_000

# Keys are first counted by hash into this many buckets.
HASH_BUCKETS = 1 << 16

# A lookup of at most this many rows is broadcast.
LOOKUP_ROWS = 10_000


class HotKeys(NamedTuple):
    values: list
    nulls: bool

    def __bool__(self) -> bool:
        return bool(self.values) or self.nulls


def hot_share(df: DataFrame) -> float:
    """The share of the rows that fills a shuffle task, ``HOT_SHARE`` at most."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(HOT_SHARE, 1 / partitions)


def hot_keys(
    df: DataFrame, key: str, share: float | None = None, min_rows: int | None = None
) -> HotKeys:
    """The keys that own a large share of ``df``.

    Rows are counted by hash bucket of the key, which sends at most ``HASH_BUCKETS``
    counts per task.  A hot key makes its bucket hot, so without a hot bucket one such
    pass settles that there is none; otherwise the keys of the hot buckets, and only
    those, are counted one by one.  At most ``1 / share`` values come to the driver.
    """
    share = hot_share(df) if share is None else share
    min_rows = HOT_ROWS if min_rows is None else min_rows
    keys = df.select(
        F.col(key).alias("key"),
        F.pmod(F.xxhash64(key), F.lit(HASH_BUCKETS)).alias("bucket"),
    )
    limit = F.greatest(F.sum("rows").over(Window.partitionBy()) * share, F.lit(min_rows))
    hot = (
        keys.groupBy(F.col("key").isNull().alias("no_key"), "bucket")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("no_key", "bucket", "rows", limit.alias("limit"))
        .where(F.col("rows") >= F.col("limit"))
        .collect()
    )
    buckets = [row["bucket"] for row in hot if not row["no_key"]]
    nulls = any(row["no_key"] for row in hot)
    if not buckets:
        return HotKeys([], nulls)
    counted = (
        keys.where(F.col("bucket").isin(buckets) & F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") >= hot[0]["limit"])
    )
    return HotKeys([row["key"] for row in counted.select("key").collect()], nulls)


def small_copy(df: DataFrame, max_rows: int = LOOKUP_ROWS) -> DataFrame | None:
    """``df`` as literal rows if it has at most ``max_rows``, otherwise None."""
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(table, df.schema)


def _join_hot(left: DataFrame, right: DataFrame, key: str, values: list) -> DataFrame:
    """Left join of the hot keys' rows with a broadcast row per key; more rows raise."""
    small = small_copy(right.where(F.col(key).isin(values)), len(values))
    if small is None:
        raise ValueError(f"{key} is not unique in the joined table")
    return left.join(F.broadcast(small), key, "left")


def left_join_chain(
    left: DataFrame,
    rights: Sequence[DataFrame],
    key: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left-join several tables that are unique in ``key`` onto ``left``.

    Each input is shuffled once on the key.  Rows of hot keys, and rows without a
    key, are not shuffled: the hot keys' rows of the other tables, one per key, are
    broadcast.  A hot key that a table holds twice raises.
    """
    hot = hot_keys(left, key) if hot is None else hot
    if not hot:
        return reduce(lambda df, right: df.join(right, key, "left"), rights, left)

    is_hot = F.col(key).isNull() | F.col(key).isin(hot.values)
    shuffled = reduce(
        lambda df, right: df.join(right, key, "left"), rights, left.where(~is_hot)
    )
    in_place = reduce(
        lambda df, right: _join_hot(df, right, key, hot.values),
        rights,
        left.where(is_hot),
    )
    return shuffled.unionByName(in_place)


def lookup_join(
    left: DataFrame, lookup: DataFrame, key: str, max_rows: int = LOOKUP_ROWS
) -> DataFrame:
    """Left-join a computed lookup that is unique in ``key`` and usually small.

    The lookup is run once and staged; up to ``max_rows`` rows of it are broadcast.  A
    larger one is joined by shuffle, with hot keys of ``left`` kept in place.
    """
    lookup = stage(lookup, "lookup")
    small = small_copy(lookup, max_rows)
    if small is not None:
        return left.join(F.broadcast(small), key, "left")
    return left_join_chain(left, [lookup], key)
