"""The narrowing quantile against brute force."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starloom.operators.impute import fill_group_median, fill_group_mode, mark_missing
from starloom.operators.quantiles import group_quantile, quantile_of_few
from starloom.operators.winsorize import upper_caps, winsorize
from tests.conftest import plan, rows, unordered


def brute(values, percent):
    """The value of rank ceil(percent * n), in whole numbers."""
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    return ordered[max(1, -(-percent * len(ordered) // 100)) - 1] if ordered else None


def samples():
    rng = random.Random(7)
    inf = float("inf")
    return {
        "whole": [float(rng.randint(-5, 40)) for _ in range(997)],
        "tails": [rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(1500)],
        "dense": [1 + rng.random() * 1e-12 for _ in range(2000)],
        "copies": [42.5] * 700 + [rng.random() for _ in range(50)],
        "odd": [0.0, -0.0, inf, -inf, None, float("nan"), 5e-324, 1.7e308, -3.0],
        "one": [3.25],
        "none": [None, None, float("nan")],
    }


@pytest.fixture(scope="module")
def sampled(spark):
    data = [(g, v) for g, values in samples().items() for v in values] + [(None, 1.0)]
    return spark.createDataFrame(data, "g string, v double").repartition(5)


@pytest.mark.parametrize("percent", [1, 50, 99, 100])
@pytest.mark.parametrize("way", ["few", "counted", "shuffled"])
def test_matches_brute_force(sampled, percent, way):
    share = percent / 100
    if way == "few":
        found = quantile_of_few(sampled, "v", share, "g", list(samples()))
    else:
        found = group_quantile(sampled, "v", share, "g", 100 if way == "counted" else 2)
    expected = {g: brute(v, percent) for g, v in samples().items()}
    assert dict(rows(found)) == {g: v for g, v in expected.items() if v is not None}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=60), st.integers(1, 100))
def test_any_doubles(spark, values, percent):
    df = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    assert rows(quantile_of_few(df, "v", percent / 100, "g", ["a"])) == [("a", brute(values, percent))]


def test_caps(spark):
    thousand = spark.range(1, 1001).selectExpr("cast(id as double) v", "id % 7 w", "cast(null as double) n")
    assert rows(upper_caps(thousand, ["v", "w", "n"], 0.99)) == [(990.0, 6.0, None)]


def test_winsorize_edges(spark):
    def capped(values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return [r[0] for r in rows(winsorize(df, ["v"]))]

    assert capped([]) == []
    assert capped([3.0]) == [3.0]
    assert capped([2.0, 2.0, 2.0]) == [2.0, 2.0, 2.0]
    assert capped([None, None]) == [None, None]
    got = capped([float(i) for i in range(1, 1001)] + [None])
    assert max(v for v in got if v is not None) == 990.0 and got[-1] is None


def test_winsorize_plan_has_no_unpartitioned_window_and_one_cap_query(spark):
    df = spark.range(1000).selectExpr("cast(id as double) v", "cast(id as double) w")
    text = plan(winsorize(df, ["v", "w"]))
    assert text.count("Subquery subquery") >= 1
    names = {line.split("Subquery ")[1].split(",")[0] for line in text.splitlines() if "Subquery " in line}
    assert len(names) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_group_median_fill(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("a", 5.0), ("a", None), ("even", 1.0), ("even", 2.0),
         ("even", None), ("empty", None), (None, None), (None, 7.0)],
        "g string, v double",
    )
    flagged = mark_missing(df, ["v"], "was_missing")
    got = unordered(fill_group_median(flagged, ["v"], "g").select("g", "v", "was_missing"))
    assert got == sorted(
        [("a", 1.0, False), ("a", 3.0, False), ("a", 5.0, False), ("a", 3.0, True),
         ("even", 1.0, False), ("even", 2.0, False), ("even", 1.0, True),
         ("empty", None, True), (None, None, True), (None, 7.0, False)],
        key=repr,
    )


def test_group_mode_fill(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 9.0), ("a", 9.0), ("a", None), ("tie", 4.0), ("tie", 2.0), ("tie", None)],
        "g string, v double",
    )
    got = unordered(fill_group_mode(df, ["v"], "g").where("true").select("g", "v"))
    assert got == sorted(
        [("a", 1.0), ("a", 9.0), ("a", 9.0), ("a", 9.0), ("tie", 4.0), ("tie", 2.0), ("tie", 2.0)],
        key=repr,
    )


def scans(df):
    """Scans that a finished query ran: those of stages that adaptive execution kept."""
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    return text.count("Scan")


def test_money_takes_two_passes_and_smooth_values_three(spark, tmp_path):
    spark.range(5000).selectExpr("round(id * 0.37D, 2) AS v", "'a' AS g").write.parquet(str(tmp_path / "m"))
    spark.range(5000).selectExpr(
        "CASE id WHEN 0 THEN 1D WHEN 1 THEN 1.002D ELSE 1.001D + id * 1e-13D END AS v", "'a' AS g"
    ).write.parquet(str(tmp_path / "d"))
    money, smooth = (spark.read.parquet(str(tmp_path / n)) for n in "md")
    for df in (money, smooth):
        values = [r["v"] for r in df.collect()]
        assert rows(quantile_of_few(df, "v", 0.99, "g", ["a"])) == [("a", brute(values, 99))]
    assert scans(quantile_of_few(money, "v", 0.99, "g", ["a"])) < scans(
        quantile_of_few(smooth, "v", 0.99, "g", ["a"])
    )
