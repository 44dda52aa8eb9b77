"""Edge rows of the column rules."""

import datetime as dt
import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions import columns as c
from starloom.operators.winsorize import keep_raw
from starloom.plans import cleaning
from tests.conftest import rows


def test_day_parts_at_their_limits(spark):
    hours = [5, 6, 11, 12, 17, 18, 21, 22, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    assert [r[0] for r in rows(df.select(c.day_part(F.col("h"))))] == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening",
        "Night", "Night",
    ]


def test_prices_and_freight_are_repaired_and_kept(spark):
    raw = spark.createDataFrame(
        [(-1.0, -0.5), (0.0, 0.0), (None, None), (0.01, 3.0)],
        "price double, freight_value double",
    ).withColumn("shipping_limit_date", F.lit("2017-01-01"))
    fixed = cleaning.repair_order_items(raw)
    got = rows(fixed.select("price", "price_flag", "freight_value", "raw_price", "raw_freight_value"))
    assert got == [
        (None, "invalid", 0.0, -1.0, -0.5),
        (None, "invalid", 0.0, 0.0, 0.0),
        (None, "ok", None, None, None),
        (0.01, "ok", 3.0, 0.01, 3.0),
    ]


def test_total_cost_counts_a_voided_price_as_zero_and_revenue_does_not(spark):
    items = spark.createDataFrame([(None, 3.0), (2.0, 3.0), (2.0, None)], "price double, freight_value double")
    got = rows(
        cleaning.with_revenue(cleaning.with_total_cost(items)).select("item_total_cost", "item_revenue")
    )
    assert got == [(3.0, None), (5.0, 5.0), (None, None)]


def test_reviews(spark):
    raw = spark.createDataFrame(
        [
            ("5", None, None), ("4", "", "t"), ("3", "  ", None), ("2", "x", None),
            (None, "two\nlines", None), ("bad", None, None), ("3.0", None, None),
        ],
        "review_score string, review_comment_message string, review_comment_title string",
    ).withColumns(
        {
            "review_creation_date": F.lit("2018-01-02"),
            "review_answer_timestamp": F.lit("no date"),
        }
    )
    got = rows(
        cleaning.clean_reviews(raw).select(
            "review_score", "has_comment", "review_comment_message", "review_comment_title",
            "sentiment",
        )
    )
    assert got == [
        (5, False, "", "", "positive"),
        (4, False, "", "t", "positive"),
        (3, False, "  ", "", "neutral"),
        (2, True, "x", "", "negative"),
        (None, True, "two\nlines", "", "negative"),
        (None, False, "", "", "negative"),
        (3, False, "", "", "neutral"),
    ]
    dates = rows(cleaning.clean_reviews(raw).select("review_creation_date", "review_answer_timestamp"))
    assert dates[0] == (dt.datetime(2018, 1, 2), None)


def test_places(spark):
    raw = spark.createDataFrame(
        [(1234, " Sao Paulo ", " sp"), (123456, "X", "RJ "), (None, None, None)],
        "seller_zip_code_prefix int, seller_city string, seller_state string",
    )
    got = rows(
        cleaning.normalise_place(raw, "seller").select("seller_zip_str", "seller_city", "seller_state")
    )
    assert got == [("01234", "sao paulo", "SP"), ("123456", "x", "RJ"), (None, None, None)]


def test_orders(spark):
    raw = spark.createDataFrame(
        [
            # Bought one second before midnight, delivered just after: one day.
            (1, " Delivered ", "2017-10-02 23:59:59", "2017-10-03 00:00:01", "2017-10-10"),
            (2, "DELIVERED", "2017-10-02 10:00:00", None, "2017-10-10"),
            (3, None, "not a date", "2017-10-12 00:00:00", "2017-10-10 12:00:00"),
        ],
        "order_id int, order_status string, order_purchase_timestamp string, "
        "order_delivered_customer_date string, order_estimated_delivery_date string",
    ).withColumns({"order_approved_at": F.lit(None).cast("string"),
                   "order_delivered_carrier_date": F.lit(None).cast("timestamp")})
    got = rows(
        cleaning.clean_orders(raw).select(
            "order_status", "is_delivered", "delivery_duration_days", "delivery_delay_days",
            "purchase_hour", "time_of_day", "order_year", "order_month", "order_quarter",
        )
    )
    assert got == [
        ("delivered", True, 1.0, -7.0, 23, "Night", 2017, 10, 4),
        ("delivered", True, None, None, 10, "Morning", 2017, 10, 4),
        (None, False, None, 2.0, None, "Night", None, None, None),
    ]


def test_keep_raw(spark):
    df = keep_raw(spark.createDataFrame([(1.0,)], "v double"), ["v"])
    assert rows(df) == [(1.0, 1.0)]


def test_amounts_that_are_no_numbers_become_null(spark):
    raw = spark.createDataFrame([("12.5", "x"), ("free", "-1")], "price string, freight_value string")
    fixed = cleaning.repair_order_items(raw.withColumn("shipping_limit_date", F.lit("?")))
    assert rows(fixed.select("price", "freight_value", "raw_price", "shipping_limit_date")) == [
        (12.5, None, 12.5, None), (None, 0.0, None, None),
    ]


def test_sums_round_nothing_and_keep_what_is_not_finite(spark):
    def total(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(c.exact_sum(F.col("v")), c.exact_mean(F.col("v"))).first()

    assert total(*[0.00004] * 1000) == (0.04, 0.00004)
    assert total(1e15, 1.0, None) == (1e15 + 1, (1e15 + 1) / 2)
    assert total(float("inf"), 1.0)[0] == float("inf")
    assert total(float("nan"), 1.0)[0] != total(float("nan"), 1.0)[0]
    assert total(None) == (None, None) and total() == (None, None)
    assert total(1e300, -1e300, 1.5)[0] == 1.5 and total(-0.1, 0.1)[0] == 0.0
    assert total(*[1e22] * 1000, *[1.0] * 5)[0] == 1e25
    assert total(-1e-5, 1e-6)[0] == -9e-6


def test_large_sums_neither_overflow_nor_switch(spark):
    many = spark.range(160_000_000).select(F.lit(9e11).alias("v"))
    assert many.agg(c.exact_sum(F.col("v"))).first()[0] == 160_000_000 * 9e11
    below, above = ([at, 0.1, 0.2, 0.3, -at] for at in (1e12 - 1, 1e12 + 1))
    for values in (below, above):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert df.agg(c.exact_sum(F.col("v"))).first()[0] == 0.6


money = st.integers(-(10**9), 10**9).map(lambda n: n / 100)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(money | st.floats(-(2.0**30), 2.0**30).filter(lambda v: v == 0 or abs(v) > 0.1), min_size=1))
def test_sums_equal_those_of_the_decimals_in_any_order(spark, values):
    sums = set()
    for order in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(3)
        sums.add(df.agg(c.exact_sum(F.col("v"))).first()[0])
    assert sums == {float(sum(Decimal(repr(v)) for v in values))}


def test_coordinates_show_what_is_not_a_number(spark):
    rows_ = [("a", float("nan")), ("a", 2.0), ("b", -23.5), ("b", -23.25), ("c", None)]
    df = spark.createDataFrame(rows_, "g string, lat double")
    got = dict(rows(df.groupBy("g").agg(c.mean_coordinate("lat"))))
    assert math.isnan(got["a"]) and got["b"] == -23.375 and got["c"] is None


def test_a_price_that_is_no_number_is_invalid(spark):
    raw = spark.createDataFrame([("abc", "1"), (" ", "1"), ("2", "1")], "price string, freight_value string")
    fixed = cleaning.repair_order_items(raw.withColumn("shipping_limit_date", F.lit("?")))
    assert rows(fixed.select("price", "price_flag")) == [(None, "invalid"), (None, "ok"), (2.0, "ok")]


def test_primary_payment_type_passes_over_what_is_missing(spark):
    from starloom.plans.star import payments_per_order

    payments = spark.createDataFrame(
        [
            (1, "boleto", None, None), (1, "credit_card", 100.0, None),
            (2, None, 5.0, 1), (2, "voucher", 5.0, 2),
            (3, "boleto", 9.0, None), (3, "voucher", 1.0, 4),
            (4, None, None, None),
        ],
        "order_id int, payment_type string, payment_value double, payment_sequential int",
    ).withColumn("payment_installments", F.lit(1))
    first = {r.order_id: r.primary_payment_type for r in payments_per_order(payments).collect()}
    assert first == {1: "credit_card", 2: "voucher", 3: "voucher", 4: None}
    unnumbered = payments_per_order(payments.drop("payment_sequential"))
    assert {r.order_id: r.primary_payment_type for r in unnumbered.collect()}[3] == "boleto"
