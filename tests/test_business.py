"""The business queries and panels on small tables with known answers."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from starloom.plans import business, panels, quality, star
from tests.conftest import plan, rows, unordered

FACT = (
    "order_id int, order_item_id int, seller_id int, product_id int, order_status string, "
    "is_delivered boolean, order_year int, order_month int, price double, "
    "item_revenue double, avg_review_score double, delivery_duration_days double, "
    "delivery_delay_days double, primary_payment_type string"
)


def fact(spark, lines):
    """Fact rows from the fields that matter to a test."""
    base = dict(
        order_id=1, order_item_id=1, seller_id=1, product_id=1, order_status="delivered",
        is_delivered=True, order_year=2017, order_month=1, price=1.0, item_revenue=1.0,
        avg_review_score=None, delivery_duration_days=1.0, delivery_delay_days=0.0,
        primary_payment_type="boleto",
    )
    return spark.createDataFrame([tuple({**base, **x}.values()) for x in lines], FACT)


def test_monthly_revenue_gap_zero_month_and_status(spark):
    table = fact(
        spark,
        [
            dict(order_id=1, order_month=1, item_revenue=10.0, avg_review_score=4.0),
            dict(order_id=1, order_month=1, item_revenue=5.0, avg_review_score=5.0),
            dict(order_id=2, order_month=2, item_revenue=0.0),
            dict(order_id=3, order_month=5, item_revenue=30.0),
            dict(order_id=4, order_month=5, item_revenue=99.0, order_status="canceled"),
            dict(order_id=5, order_month=5, item_revenue=99.0, order_status=None),
            dict(order_id=6, order_year=2019, item_revenue=99.0),
        ],
    )
    assert rows(business.monthly_revenue(table)) == [
        (2017, 1, "2017-01", 1, 15.0, 4.5, None, None),
        (2017, 2, "2017-02", 1, 0.0, None, -15.0, -100.0),
        (2017, 5, "2017-05", 1, 30.0, None, 30.0, None),
    ]
    gapless = rows(business.monthly_revenue_without_gaps(table))
    assert [r[2:5] for r in gapless] == [
        ("2017-01", 1, 15.0), ("2017-02", 1, 0.0), ("2017-03", 0, 0.0), ("2017-04", 0, 0.0),
        ("2017-05", 1, 30.0),
    ]
    assert gapless[-1][6:] == (30.0, None)
    months = business.monthly_revenue(table)
    assert [r[2:] for r in rows(panels.month_changes(months))] == [
        (0.0, "up"), (-15.0, "down"), (30.0, "up"),
    ]
    assert rows(panels.sparkline(months)) == [(0, 15.0), (1, 0.0), (2, 30.0)]


def test_money_is_summed_exactly(spark):
    table = fact(spark, [dict(order_id=i, item_revenue=0.1) for i in range(1000)])
    assert rows(business.monthly_revenue(table))[0][4] == 100.0


def test_categories_tied_in_revenue_share_a_rank(spark):
    products = spark.createDataFrame(
        [(1, "b"), (2, "a"), (3, "c"), (4, None)], "product_id int, product_category_name_en string"
    )
    table = fact(
        spark,
        [dict(order_id=p, product_id=p, item_revenue=v) for p, v in ((1, 5.0), (2, 5.0), (3, 2.0), (4, 9.0), (9, 9.0))],
    )
    got = business.category_revenue(table, products)
    assert [(r[0], r[3], r[6], r[7]) for r in rows(got)] == [
        ("a", 5.0, 1, 1), ("b", 5.0, 1, 2), ("c", 2.0, 3, 3),
    ]
    assert [r[0] for r in rows(panels.top_categories(got, top=2))] == ["a", "b"]
    assert rows(business.category_revenue(table, products, top=1))[0][0] == "a"


@pytest.fixture
def sellers(spark):
    return spark.createDataFrame(
        [(1, "SP", "x"), (2, "SP", "x"), (3, None, "y"), (4, "SP", "z"), (5, None, "y")],
        "seller_id int, seller_state string, seller_city string",
    )


def test_sellers_need_ten_orders_and_rank_within_their_state(spark, sellers):
    lines = []
    for seller, orders, revenue in ((1, 10, 1.0), (2, 9, 50.0), (3, 11, 2.0), (4, 12, 0.5), (5, 11, 1.0), (6, 10, 9.0)):
        lines += [
            dict(order_id=seller * 100 + i, seller_id=seller, item_revenue=revenue) for i in range(orders)
        ]
    lines.append(dict(order_id=999, seller_id=2, order_status="shipped"))
    table = fact(spark, lines)
    got = rows(business.seller_performance(table, sellers))
    assert [(r[0], r[1], r[3], r[4], r[7]) for r in got] == [
        (6, None, 10, 90.0, 3),
        (3, None, 11, 22.0, 1),
        (5, None, 11, 11.0, 2),
        (1, "SP", 10, 10.0, 2),
        (4, "SP", 12, 6.0, 1),
    ]
    text = plan(business.seller_performance(table, sellers))
    assert "windowspecdefinition(seller_state" not in text and "NestedLoop" not in text
    # The rank counts sellers that are not among the listed ones.
    assert [(r[0], r[7]) for r in rows(business.seller_performance(table, sellers, top=4))][-1] == (1, 2)
    states = panels.top_states(business.seller_performance(table, sellers))
    assert rows(states) == [("SP", 16.0 / 1e6, True)]
    assert rows(panels.top_states_of_all(table, sellers)) == [("SP", 466.0 / 1e6, True)]


def test_late_items_of_one_order_count_twice(spark, sellers):
    table = fact(
        spark,
        [
            dict(order_id=1, seller_id=1, delivery_delay_days=3.0),
            dict(order_id=1, seller_id=1, order_item_id=2, delivery_delay_days=3.0),
            dict(order_id=2, seller_id=3, delivery_delay_days=None),
            dict(order_id=3, seller_id=3, delivery_duration_days=None),
            dict(order_id=4, seller_id=3, is_delivered=False),
        ],
    )
    got = rows(business.delivery_by_state(table, sellers))
    assert [(r[0], r[1], r[3], r[5], r[6]) for r in got] == [
        ("SP", 1, 3.0, 2, 200.0), (None, 1, None, 0, 0.0),
    ]
    assert unordered(business.late_orders_by_state(table, sellers)) == sorted(
        [("SP", 1, 1, 100.0), (None, 1, 0, 0.0)], key=repr
    )


def test_payment_mix(spark):
    payments = spark.createDataFrame(
        [(1, "credit_card", 1, 10.0), (1, "credit_card", 1, 5.01), (1, "credit_card", 2, 5.0),
         (2, "boleto", 1, 4.0), (3, "not_defined", 1, 9.0), (4, None, 1, 9.0),
         (5, "credit_card", 13, 1.0)],
        "order_id int, payment_type string, payment_installments int, payment_value double",
    )
    mix = business.payment_analysis(payments)
    assert rows(mix) == [
        ("boleto", 1, 1, 4.0, 4.0, 4.0),
        ("credit_card", 1, 1, 7.51, 15.01, 7.51),
        ("credit_card", 2, 1, 5.0, 5.0, 5.0),
        ("credit_card", 13, 1, 1.0, 1.0, 1.0),
    ]
    assert rows(panels.payment_share(mix)) == [("credit_card", 3, 75.0), ("boleto", 1, 25.0)]
    assert rows(panels.payment_share_of_orders(payments)) == [
        ("credit_card", 2, 66.7), ("boleto", 1, 33.3),
    ]
    assert rows(panels.installment_curve(mix)) == [(1, 7.51), (2, 5.0)]


def test_heatmap_and_scatter(spark):
    states = spark.createDataFrame(
        [("A", 100, 1.0, -2.0, 4.0, 10.0), ("B", 300, 3.0, 2.0, 4.0, 20.0),
         (None, 200, 2.0, None, 4.0, 30.0), ("Z", 1, 99.0, 0.0, None, 0.0)],
        "seller_state string, total_orders long, avg_delivery_days double, "
        "avg_delay_days double, avg_review_score double, late_pct double",
    )
    heat = {r[0]: r for r in rows(panels.state_heatmap(states, top=3))}
    assert set(heat) == {"A", "B", None}
    assert heat["A"][6] == 0.0 and heat["B"][6] == pytest.approx(1.0)
    assert heat[None][6] == pytest.approx(0.5) and heat[None][7] is None
    assert heat["B"][8] == 0.0  # a constant metric
    assert unordered(panels.delay_scatter(states)) == [("A", -2.0, 4.0, 2.0), ("B", 2.0, 4.0, 6.0)]


def test_payments_and_reviews_per_order(spark):
    payments = spark.createDataFrame(
        [(1, 2, "voucher", 1, 50.0), (1, 1, "boleto", 2, 0.1), (1, 3, "boleto", 1, 0.2), (2, 1, None, None, None)],
        "order_id int, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    assert unordered(star.payments_per_order(payments)) == [
        (1, 50.3, 4, ["boleto", "voucher"], "boleto"), (2, None, None, [], None),
    ]
    by_value = unordered(star.payments_per_order(payments.drop("payment_sequential")))
    assert by_value[0][4] == "voucher"
    day = dt.datetime(2018, 1, 1)
    reviews = spark.createDataFrame(
        [(1, "a", 5, True, day), (1, "b", 2, False, day + dt.timedelta(1)), (1, "c", None, True, None)],
        "order_id int, review_id string, review_score int, has_comment boolean, review_answer_timestamp timestamp_ntz",
    )
    assert rows(star.reviews_per_order(reviews)) == [(1, 3.5, 5, 2)]
    assert rows(star.reviews_per_order(reviews, "latest")) == [(1, 2.0, 5, 2)]


def test_audit(spark):
    good = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    bad = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert unordered(quality.audit({"good": good, "bad": bad}, {"good": ["a", "b"], "bad": ["a", "b"]})) == [
        ("bad", 2, 3, "a=1, b=2", "FAIL"), ("good", 2, 0, "", "PASS"),
    ]
    quality.require(good, "good", ["a"], expected_rows=2)
    with pytest.raises(quality.QualityError, match="a=1"):
        quality.require(bad, "bad", ["a"])
    with pytest.raises(quality.QualityError, match="2 rows, expected 3"):
        quality.require(good, "good", ["a"], expected_rows=3)


def test_queries_never_window_over_the_fact(spark, sellers, no_broadcast):
    table = fact(spark, [dict(order_id=i) for i in range(3)])
    text = plan(business.monthly_revenue(table))
    # Nothing reaches a single task before it was aggregated.
    assert "Exchange SinglePartition" not in text.split("HashAggregate")[-1]
    assert "CartesianProduct" not in text


def test_order_counts_keep_groups_without_a_name_or_an_order(spark, sellers):
    lines = [
        dict(order_id=1, seller_id=99, price=1.0),
        dict(order_id=1, seller_id=99, price=2.0),
        dict(order_id=None, seller_id=99, price=4.0),
        dict(order_id=2, seller_id=1, product_id=2, price=8.0),
        dict(order_id=None, seller_id=2, product_id=3, price=16.0),
    ]
    counted = business.with_order_counts(fact(spark, lines), ["product_id"], F.sum("price").alias("p"))
    assert unordered(counted) == [(1, 7.0, 1), (2, 8.0, 1), (3, 16.0, 0)]
    states = business.delivery_by_state(fact(spark, lines[:4]), sellers)
    assert states.where("seller_state IS NULL").first()["total_orders"] == 1


def test_pairs_of_group_and_order_carry_no_totals(spark, sellers, no_broadcast):
    table = fact(spark, [{}])
    products = spark.createDataFrame([(1, "a")], "product_id int, product_category_name_en string")
    payments = table.selectExpr(
        "order_id", "primary_payment_type payment_type", "1 payment_installments", "price payment_value"
    )
    for query in (
        business.monthly_revenue(table),
        business.category_revenue(table, products),
        business.seller_performance(table, sellers),
        business.delivery_by_state(table, sellers),
        business.payment_analysis(payments),
    ):
        pairs = [x for x in plan(query).splitlines() if re.search(r"Aggregate\(keys?=\[[^]]*order_id", x)]
        assert pairs and all("functions=[]" in x for x in pairs)
