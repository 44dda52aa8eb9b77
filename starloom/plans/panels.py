"""The data behind each report panel, from the results of the business queries.

The inputs are query results of a few dozen rows, or one row per state or per
payment type and instalment count.  Windows run after a limit or over such rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.columns import exact_sum

MILLION = 1e6
CREDIT_CARD = "credit_card"

# The metrics of the state heatmap.
HEAT_METRICS = ("avg_delivery_days", "avg_delay_days", "avg_review_score", "late_pct")
# Fixed value: keeps the scale of a constant metric away from zero.
HEAT_EPSILON = 1e-9
# Fixed value: orders per unit of bubble size.
ORDERS_PER_BUBBLE = 50


def month_changes(monthly: DataFrame) -> DataFrame:
    """Month-over-month change with its direction; the first month counts as zero."""
    change = F.coalesce("revenue_mom_change", F.lit(0.0))
    return monthly.select(
        "year_month",
        "monthly_revenue",
        change.alias("revenue_mom_change"),
        F.when(change >= 0, "up").otherwise("down").alias("direction"),
    )


def top_categories(categories: DataFrame, top: int = 15) -> DataFrame:
    """The first categories of the ranking, least revenue first, in millions."""
    return (
        categories.orderBy("row_num")
        .limit(top)
        .select(
            "category",
            (F.col("total_revenue") / MILLION).alias("revenue_millions"),
            "avg_rating",
        )
        .orderBy("revenue_millions", "category")
    )


def state_heatmap(states: DataFrame, top: int = 15) -> DataFrame:
    """Delivery metrics of the states with most orders, each also scaled to 0..1."""
    largest = states.orderBy(F.desc("total_orders"), F.asc_nulls_first("seller_state")).limit(top)
    everyone = Window.partitionBy()  # at most ``top`` rows

    def scaled(metric: str):
        low, high = F.min(metric).over(everyone), F.max(metric).over(everyone)
        return ((F.col(metric) - low) / (high - low + HEAT_EPSILON)).alias(f"{metric}_scaled")

    return largest.select(
        "seller_state", "total_orders", *HEAT_METRICS, *[scaled(m) for m in HEAT_METRICS]
    )


def delay_scatter(states: DataFrame) -> DataFrame:
    """Delay against rating by state, sized by orders; states missing either drop out."""
    return states.dropna(subset=["avg_delay_days", "avg_review_score"]).select(
        "seller_state",
        "avg_delay_days",
        "avg_review_score",
        (F.col("total_orders") / ORDERS_PER_BUBBLE).alias("bubble_size"),
    )


def payment_share(mix: DataFrame) -> DataFrame:
    """Share of each payment type in the order counts, largest first.

    An order paid in several ways or instalment plans counts in each of them; see
    ``payment_share_of_orders`` for distinct orders.
    """
    return _with_share(
        mix.groupBy("payment_type").agg(F.sum("order_count").alias("order_count"))
    )


def payment_share_of_orders(payments: DataFrame, undefined: str = "not_defined") -> DataFrame:
    """As ``payment_share``, counting an order once for each type."""
    return _with_share(
        payments.where(F.col("payment_type") != undefined)
        .groupBy("payment_type")
        .agg(F.count_distinct("order_id").alias("order_count"))
    )


def _with_share(types: DataFrame) -> DataFrame:
    # The total comes from a one-row aggregate; types are not gathered in one task.
    total = types.agg(F.sum("order_count")).scalar()
    return types.withColumn(
        "share_pct", F.round(F.col("order_count") / total * 100, 1)
    ).orderBy(F.desc("order_count"), "payment_type")


def installment_curve(mix: DataFrame, last: int = 12) -> DataFrame:
    """Mean order value by number of instalments, for credit cards."""
    return (
        mix.where(
            (F.col("payment_type") == CREDIT_CARD)
            & F.col("payment_installments").between(1, last)
        )
        .groupBy("payment_installments")
        .agg(F.avg("avg_order_value").alias("avg_order_value"))
        .orderBy("payment_installments")
    )


def top_states(sellers: DataFrame, top: int = 10) -> DataFrame:
    """Revenue by state over the listed sellers, least first, the largest flagged.

    Sellers without a state are left out.  See ``top_states_of_all`` for all sellers.
    """
    return _top_states(sellers, F.col("total_revenue"), top)


def top_states_of_all(
    fact: DataFrame, sellers: DataFrame, top: int = 10, status: str = "delivered"
) -> DataFrame:
    """As ``top_states``, over the revenue of every seller."""
    sold = fact.where(F.col("order_status") == status).join(
        sellers.select("seller_id", "seller_state"), "seller_id"
    )
    return _top_states(sold, F.col("item_revenue"), top)


def _top_states(df: DataFrame, revenue: Column, top: int) -> DataFrame:
    best = (
        df.where(F.col("seller_state").isNotNull())
        .groupBy("seller_state")
        .agg(F.coalesce(exact_sum(revenue), F.lit(0.0)).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "seller_state")
        .limit(top)
    )
    place = F.row_number().over(Window.orderBy(F.desc("total_revenue"), "seller_state"))
    return best.select(
        "seller_state",
        (F.col("total_revenue") / MILLION).alias("revenue_millions"),
        (place == 1).alias("is_largest"),
    ).orderBy("revenue_millions", F.desc("seller_state"))


def sparkline(monthly: DataFrame) -> DataFrame:
    """Monthly revenue by position in the series, from zero."""
    place = F.row_number().over(Window.orderBy("order_year", "order_month"))
    return monthly.select((place - 1).alias("month_index"), "monthly_revenue")
