"""Joins under skew: the result never depends on which keys are called hot."""

import pytest
from pyspark.sql import functions as F

from starloom.operators.dedup import dedup_by_key, duplicate_keys, require_unique
from starloom.operators.joins import HotKeys, hot_keys, left_join_chain, lookup_join, small_copy
from tests.conftest import plan, rows, unordered


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 7 owns a third of the rows, a tenth has no key."""
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.col("id") % 500)
        .alias("k"),
        F.col("id").alias("item"),
    )


@pytest.fixture(scope="module")
def rights(spark):
    return [
        spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a")),
        spark.range(0, 500, 7).select(F.col("id").alias("k"), (F.col("id") * 3).alias("b")),
    ]


def test_hot_keys_are_found(skewed):
    assert hot_keys(skewed, "k", share=0.05, min_rows=100) == HotKeys([7], True)
    assert hot_keys(skewed, "k", share=0.2, min_rows=100) == HotKeys([7], False)
    assert not hot_keys(skewed, "k")
    assert not hot_keys(skewed.limit(0), "k")


def test_hot_keys_of_text(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 400, "it's").otherwise(F.col("id").cast("string")).alias("k")
    )
    assert hot_keys(df, "k", share=0.1, min_rows=10).values == ["it's"]


@pytest.mark.parametrize("hot", [([7], True), ([7, 12], False), ([], True)])
def test_chain_gives_the_same_rows_either_way(skewed, rights, hot):
    plain = left_join_chain(skewed, rights, "k", HotKeys([], False))
    split = left_join_chain(skewed, rights, "k", HotKeys(*hot))
    assert plain.count() == split.count() == 9000
    assert unordered(plain) == unordered(split)


def test_hot_rows_are_not_shuffled(skewed, rights, no_broadcast):
    left = skewed.withColumn("payload", F.sha2(F.col("item").cast("string"), 256))
    text = plan(left_join_chain(left, rights, "k", HotKeys([7], True)))
    hot, cold = text.count("BroadcastHashJoin"), text.count("SortMergeJoin")
    assert (hot, cold) == (2, 2)


def test_chain_shuffles_every_input_once(skewed, rights, no_broadcast):
    text = plan(left_join_chain(skewed, rights, "k"))
    assert text.count("SortMergeJoin") == 2
    assert text.count("Exchange hashpartitioning") == 3


def test_lookup_beyond_the_limit_takes_the_shuffled_way(skewed, rights):
    few = lookup_join(skewed, rights[0], "k")
    many = lookup_join(skewed, rights[0], "k", max_rows=10)
    assert unordered(few) == unordered(many)
    assert small_copy(rights[0], 399) is None
    assert unordered(small_copy(rights[0], 400)) == unordered(rights[0])


def test_dedup_keeps_the_least_row_whatever_the_layout(spark):
    data = [(1, "b", 5), (1, "a", 9), (1, "a", 3), (2, None, 1), (2, "z", 0), (None, "q", 1), (None, "p", 1)]
    df = spark.createDataFrame(data, "k int, s string, n int")
    expected = sorted([(1, "a", 3), (2, None, 1), (None, "p", 1)], key=repr)
    for parts in (1, 3, 7):
        assert unordered(dedup_by_key(df.repartition(parts), ["k"], ["s"])) == expected
    assert "Window" not in plan(dedup_by_key(df, ["k"], ["s"]))
    assert unordered(duplicate_keys(df, ["k"])) == sorted([(1, 3), (2, 2), (None, 2)], key=repr)


def test_dedup_by_all_orders(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 1, 9)], "k int, a int, b int")
    assert rows(dedup_by_key(df, ["k"])) == [(1, 1, 9)]
    assert rows(dedup_by_key(df, ["k"], ["b"])) == [(1, 2, 3)]


def test_a_key_that_is_not_unique_raises(skewed, rights):
    twice = rights[0].union(rights[0])
    with pytest.raises(ValueError, match="not unique"):
        left_join_chain(skewed, [twice], "k", HotKeys([7], False))
    with pytest.raises(ValueError, match="must be unique"):
        require_unique(twice, ["k"], "rights")
    assert require_unique(rights[0], ["k"], "rights") is rights[0]
