"""The five business queries.  Each takes warehouse tables and returns a DataFrame.

Money and ratings are summed as decimals; days are whole numbers, whose sums are exact
as they are.  Windows run over aggregated rows whose number is bounded (months of the
years asked for, or the rows of a top-k), never over the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.columns import exact_mean, exact_sum, rounded

CANCELED = "canceled"
DELIVERED = "delivered"
UNDEFINED_PAYMENT = "not_defined"


def year_month(year: str, month: str) -> Column:
    return F.concat(
        F.col(year).cast("string"), F.lit("-"), F.lpad(F.col(month).cast("string"), 2, "0")
    )


def with_order_counts(df: DataFrame, keys: Sequence[str], *totals: Column) -> DataFrame:
    """Totals per group, and ``total_orders``, the number of its distinct orders.

    In one aggregate every pair of group and order would carry the buffers of all totals
    through the shuffle.  So the totals are taken apart from the orders, a row per group and
    task, and the pairs travel bare.  ``df`` is read twice.
    """
    other = [F.col(k).alias(f"_{k}") for k in keys]
    # A missing order makes a pair, which keeps its group, but does not count.
    orders = (
        df.select(*other, "order_id")
        .distinct()
        .groupBy(*[f"_{k}" for k in keys])
        .agg(F.count("order_id").alias("total_orders"))
    )
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    grouped = df.groupBy(*keys).agg(*totals)
    return grouped.join(orders, same).drop(*[f"_{k}" for k in keys])


def _months(fact: DataFrame, first_year: int, last_year: int) -> DataFrame:
    sold = fact.where(
        (F.col("order_status") != CANCELED)
        & F.col("order_year").between(first_year, last_year)
    )
    return with_order_counts(
        sold,
        ["order_year", "order_month"],
        exact_sum(F.col("item_revenue")).alias("revenue"),
        rounded(exact_mean(F.col("avg_review_score")), 2).alias("avg_rating"),
    )


def _month_trend(months: DataFrame) -> DataFrame:
    # At most twelve rows for each year asked for reach this window.
    before = F.lag("revenue", 1).over(Window.orderBy("order_year", "order_month"))
    now, prev = F.col("revenue"), F.col("previous")
    growth = (now - prev) / F.nullif(prev, F.lit(0.0)) * 100
    return (
        months.withColumn("previous", before)
        .select(
            "order_year",
            "order_month",
            year_month("order_year", "order_month").alias("year_month"),
            "total_orders",
            rounded(now, 2).alias("monthly_revenue"),
            "avg_rating",
            rounded(now - prev, 2).alias("revenue_mom_change"),
            rounded(growth, 2).alias("revenue_mom_pct"),
        )
        .orderBy("order_year", "order_month")
    )


def monthly_revenue(fact: DataFrame, first_year: int = 2016, last_year: int = 2018) -> DataFrame:
    """Orders, revenue and rating by month, with the change from the month before.

    "Before" is the previous month that has orders, as LAG sees it.
    """
    return _month_trend(_months(fact, first_year, last_year))


def monthly_revenue_without_gaps(
    fact: DataFrame, first_year: int = 2016, last_year: int = 2018
) -> DataFrame:
    """As ``monthly_revenue``, with a zero row for every month without orders.

    The calendar runs from the first to the last month with orders, so the change is
    always against the previous calendar month.
    """
    number = F.col("order_year") * 12 + F.col("order_month") - 1
    months = _months(fact, first_year, last_year).withColumn("number", number)
    calendar = fact.sparkSession.range(first_year * 12, (last_year + 1) * 12).select(
        F.col("id").cast("int").alias("number")
    )
    # At most twelve rows for each year asked for reach this window.
    every = Window.partitionBy()
    seen = F.when(F.col("total_orders").isNotNull(), F.col("number"))
    filled = (
        calendar.join(months.drop("order_year", "order_month"), "number", "left")
        .withColumns({"first": F.min(seen).over(every), "last": F.max(seen).over(every)})
        .where(F.col("number").between(F.col("first"), F.col("last")))
        .withColumns(
            {
                "order_year": F.floor(F.col("number") / 12).cast("int"),
                "order_month": (F.col("number") % 12 + 1).cast("int"),
                "total_orders": F.coalesce("total_orders", F.lit(0).cast("bigint")),
                "revenue": F.coalesce("revenue", F.lit(0.0)),
            }
        )
    )
    return _month_trend(filled)


def category_revenue(fact: DataFrame, products: DataFrame, top: int = 20) -> DataFrame:
    """The categories with the most revenue; equal revenue shares a rank.

    Ranks within the first rows of a descending sort are the ranks overall, so the
    top-k is taken first and the window sees ``top`` rows only.
    """
    sold = (
        fact.where(F.col("order_status") != CANCELED)
        .join(
            products.select(
                "product_id", F.col("product_category_name_en").alias("category")
            ),
            "product_id",
        )
        .where(F.col("category").isNotNull())
    )
    by_category = with_order_counts(
        sold,
        ["category"],
        F.count("order_item_id").alias("total_items_sold"),
        exact_sum(F.col("item_revenue")).alias("revenue"),
        rounded(exact_mean(F.col("price")), 2).alias("avg_price"),
        rounded(exact_mean(F.col("avg_review_score")), 2).alias("avg_rating"),
    )
    best = [F.desc_nulls_last("revenue"), F.asc("category")]
    return (
        by_category.orderBy(*best)
        .limit(top)
        .select(
            "category",
            "total_orders",
            "total_items_sold",
            rounded(F.col("revenue"), 2).alias("total_revenue"),
            "avg_price",
            "avg_rating",
            F.rank().over(Window.orderBy(best[0])).alias("revenue_rank"),
            F.row_number().over(Window.orderBy(*best)).alias("row_num"),
        )
        .orderBy("row_num")
    )


def seller_performance(
    fact: DataFrame, sellers: DataFrame, min_orders: int = 10, top: int = 30
) -> DataFrame:
    """The sellers with the most revenue from delivered orders, ranked in their state.

    Sellers below ``min_orders`` orders do not count, for the rank either.  The rank
    is one more than the number of sellers of the state that come first, counted
    against the ``top`` sellers only: no state's sellers are gathered and sorted.
    Items are aggregated before the join, and their orders by seller and order, so a seller
    with a third of them is spread over all tasks.  Sellers must be unique in ``seller_id``.
    """
    measures = ["total_orders", "total_revenue", "avg_rating", "avg_delivery_days"]
    totals = (
        with_order_counts(
            fact.where(F.col("order_status") == DELIVERED),
            ["seller_id"],
            rounded(exact_sum(F.col("item_revenue")), 2).alias("total_revenue"),
            rounded(exact_mean(F.col("avg_review_score")), 2).alias("avg_rating"),
            rounded(F.avg("delivery_duration_days"), 1).alias("avg_delivery_days"),
        )
        .where(F.col("total_orders") >= min_orders)
        .select("seller_id", *measures)
    )
    ranked = totals.join(
        sellers.select("seller_id", "seller_state", "seller_city"), "seller_id", "left"
    ).select("seller_id", "seller_state", "seller_city", *measures)
    by_revenue = [F.desc_nulls_last("total_revenue"), "seller_id", "seller_state", "seller_city"]
    best = (
        ranked.orderBy(*by_revenue)
        .limit(top)
        .withColumn("position", F.row_number().over(Window.orderBy(*by_revenue)))
    )
    mine = F.struct(-F.col("m.total_orders"), F.col("m.seller_id"), F.col("m.seller_city"))
    other = F.struct(-F.col("o.total_orders"), F.col("o.seller_id"), F.col("o.seller_city"))
    ahead = (
        ranked.alias("o")
        .join(
            F.broadcast(best).alias("m"),
            F.col("o.seller_state").eqNullSafe(F.col("m.seller_state")) & (other < mine),
        )
        .groupBy("position")
        .agg(F.count(F.lit(1)).alias("ahead"))
    )
    return (
        best.join(F.broadcast(ahead), "position", "left")
        .withColumn("state_rank", (F.coalesce("ahead", F.lit(0)) + 1).cast("int"))
        .orderBy("position")
        .drop("position", "ahead")
    )


def _delivered_with_state(fact: DataFrame, sellers: DataFrame) -> DataFrame:
    return fact.where(
        F.col("is_delivered") & F.col("delivery_duration_days").isNotNull()
    ).join(sellers.select("seller_id", "seller_state"), "seller_id", "left")


def delivery_by_state(fact: DataFrame, sellers: DataFrame) -> DataFrame:
    """Delivery days, delay, rating and lateness by seller state, slowest first.

    ``late_pct`` divides late items by distinct orders, so it can exceed 100; see
    ``late_orders_by_state`` for the share of late orders.
    """
    states = with_order_counts(
        _delivered_with_state(fact, sellers),
        ["seller_state"],
        rounded(F.avg("delivery_duration_days"), 1).alias("avg_delivery_days"),
        rounded(F.avg("delivery_delay_days"), 1).alias("avg_delay_days"),
        rounded(exact_mean(F.col("avg_review_score")), 2).alias("avg_review_score"),
        F.count_if(F.col("delivery_delay_days") > 0).alias("late_deliveries"),
    )
    late_pct = F.col("late_deliveries") / F.col("total_orders") * 100
    return states.select(
        "seller_state",
        "total_orders",
        "avg_delivery_days",
        "avg_delay_days",
        "avg_review_score",
        "late_deliveries",
        rounded(late_pct, 1).alias("late_pct"),
    ).orderBy(F.desc_nulls_last("avg_delay_days"), "seller_state")


def late_orders_by_state(fact: DataFrame, sellers: DataFrame) -> DataFrame:
    """Share of delivered orders with at least one late item, by seller state."""
    orders = (
        _delivered_with_state(fact, sellers)
        .groupBy("seller_state", "order_id")
        .agg(F.max(F.col("delivery_delay_days") > 0).alias("late"))
    )
    late = F.count_if("late")
    return orders.groupBy("seller_state").agg(
        F.count(F.lit(1)).alias("total_orders"),
        late.alias("late_orders"),
        F.round(late / F.count(F.lit(1)) * 100, 1).alias("late_order_pct"),
    )


def payment_analysis(payments: DataFrame) -> DataFrame:
    """Orders and values by payment type and number of instalments.

    ``avg_order_value`` and ``avg_payment`` are both the mean payment row.
    """
    value = F.col("payment_value")
    mix = with_order_counts(
        payments.where(F.col("payment_type") != UNDEFINED_PAYMENT),
        ["payment_type", "payment_installments"],
        rounded(exact_mean(value), 2).alias("avg_order_value"),
        rounded(exact_sum(value), 2).alias("total_value"),
        rounded(exact_mean(value), 2).alias("avg_payment"),
    )
    return mix.select(
        "payment_type",
        "payment_installments",
        F.col("total_orders").alias("order_count"),
        "avg_order_value",
        "total_value",
        "avg_payment",
    ).orderBy("payment_type", "payment_installments")


def revenue_by_month_and_payment(fact: DataFrame, year: int = 2017) -> DataFrame:
    """Revenue of one year by month and primary payment type."""
    return (
        fact.where(F.col("order_year") == year)
        .groupBy("order_month", "primary_payment_type")
        .agg(exact_sum(F.col("item_revenue")).alias("monthly_revenue"))
    )


def with_seller(fact: DataFrame, sellers: DataFrame) -> DataFrame:
    """Add the seller's columns to every fact row.

    Spark broadcasts the sellers while their files are below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that it shuffles both sides and
    splits hot sellers adaptively.
    """
    return fact.join(sellers, "seller_id", "left")
