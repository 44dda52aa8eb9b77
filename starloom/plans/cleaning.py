"""From raw tables to clean ones.  Each function maps one DataFrame to another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import columns as c
from starloom.operators.dedup import dedup_by_key
from starloom.operators.impute import (
    fill_from_group,
    fill_group_median,
    fill_group_mode,
    group_median,
    mark_missing,
)
from starloom.operators.winsorize import keep_raw, winsorize
from starloom.sources.scratch import stage

# The times of an order.
ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def clean_orders(raw: DataFrame) -> DataFrame:
    """Parse times, normalise the status, derive delivery and calendar columns.

    The status is normalised before it is tested, so ``is_delivered`` and
    ``order_status`` always agree.
    """
    bought, arrived = F.col("order_purchase_timestamp"), "order_delivered_customer_date"
    parsed = raw.withColumns(
        {
            **{name: c.timestamp(name) for name in ORDER_TIMES},
            "order_status": c.lower_trimmed("order_status"),
        }
    )
    return parsed.withColumns(
        {
            "is_delivered": F.coalesce(F.col("order_status") == "delivered", F.lit(False)),
            "delivery_duration_days": c.days_between("order_purchase_timestamp", arrived),
            # Positive: late.  Negative: early.
            "delivery_delay_days": c.days_between("order_estimated_delivery_date", arrived),
            "purchase_hour": F.hour(bought),
            "time_of_day": c.day_part(F.hour(bought)),
            "order_year": F.year(bought),
            "order_month": F.month(bought),
            "order_quarter": F.quarter(bought),
        }
    )


def repair_order_items(raw: DataFrame) -> DataFrame:
    """Flag and void prices that are not positive, lift negative freight to zero.

    ``raw_price`` and ``raw_freight_value`` keep the values as they were read.  A price
    whose text is no number is flagged like one that is not positive.
    """
    amounts = ["price", "freight_value"]
    read = raw.withColumns(
        {
            "price_flag": F.when(c.not_read(raw, "price"), "invalid").otherwise("ok"),
            **{a: c.number(a) for a in amounts},
        }
    )
    return keep_raw(read, amounts).withColumns(
        {
            "shipping_limit_date": c.timestamp("shipping_limit_date"),
            "price_flag": F.when(F.col("price") <= 0, "invalid").otherwise(F.col("price_flag")),
            "price": c.null_if_not_positive(F.col("price")),
            "freight_value": c.at_least(F.col("freight_value"), 0.0),
        }
    )


def clean_order_items(
    raw: DataFrame, cap_share: float = 0.99, products: DataFrame | None = None
) -> DataFrame:
    """Repair, winsorize price and freight, and add the item's total cost.

    With ``products``, prices that are not valid are filled from the category first.
    """
    repaired = repair_order_items(raw)
    if products is not None:
        repaired = repair_prices_from_category(repaired, products)
    capped = winsorize(repaired, ["price", "freight_value"], cap_share)
    return with_total_cost(capped)


def with_total_cost(items: DataFrame) -> DataFrame:
    """Price plus freight, where a voided price counts as zero."""
    return items.withColumn(
        "item_total_cost", F.coalesce(F.col("price"), F.lit(0.0)) + F.col("freight_value")
    )


def with_revenue(items: DataFrame) -> DataFrame:
    """Price plus freight, NULL where either is missing."""
    return items.withColumn("item_revenue", F.col("price") + F.col("freight_value"))


def repair_prices_from_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Give items without a valid price the median price of their category."""
    category = "product_category_name_en"
    # The medians take several passes and the fill one more; none should repeat the join.
    labelled = stage(
        items.join(products.select("product_id", category), "product_id", "left"), "labelled_items"
    )
    median = group_median(labelled, "price", category)
    filled = fill_from_group(labelled, median, "price", category)
    return with_total_cost(filled.drop(category))


def normalise_place(raw: DataFrame, entity: str) -> DataFrame:
    """Upper-case state, lower-case city and a zip label for customers or sellers."""
    return raw.withColumns(
        {
            f"{entity}_state": c.upper_trimmed(f"{entity}_state"),
            f"{entity}_city": c.lower_trimmed(f"{entity}_city"),
            f"{entity}_zip_str": c.zip_label(f"{entity}_zip_code_prefix"),
        }
    )


def translate_category(products: DataFrame, translation: DataFrame | None) -> DataFrame:
    """English category name, else the native one, else ``unknown``.

    The translation is broadcast when Spark knows its files to be small; otherwise the
    join is shuffled and hot categories are split by adaptive execution.
    """
    names = [F.col("product_category_name"), F.lit("unknown")]
    if translation is not None:
        products = products.join(translation, "product_category_name", "left")
        names.insert(0, F.col("product_category_name_english"))
    return products.withColumn("product_category_name_en", F.coalesce(*names))


def clean_products(
    raw: DataFrame, translation: DataFrame | None, photos: str = "median"
) -> DataFrame:
    """Correct column names, translate categories, fill gaps from the category.

    ``is_imputed`` is set before filling, from the category and both filled columns.
    ``photos="mode"`` fills the photo count with the category's most frequent value.
    """
    category = "product_category_name_en"
    gaps = ["product_name_length", "product_photos_qty"]
    named = raw.withColumnsRenamed(
        {
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        }
    )
    labelled = translate_category(named, translation).withColumns(
        {g: c.number(g) for g in gaps}
    )
    flagged = mark_missing(labelled, ["product_category_name", *gaps], "is_imputed")
    if photos == "mode":
        filled = fill_group_mode(
            fill_group_median(flagged, gaps[:1], category), gaps[1:], category
        )
    else:
        filled = fill_group_median(flagged, gaps, category)
    return filled.withColumns({g: F.col(g).cast("int") for g in gaps})


def clean_payments(raw: DataFrame, cap_share: float = 0.99) -> DataFrame:
    """Winsorize the value (``raw_payment_value`` keeps it), normalise the type."""
    read = raw.withColumns(
        {
            "payment_value": c.number("payment_value"),
            "payment_type": c.lower_trimmed("payment_type"),
        }
    )
    return winsorize(keep_raw(read, ["payment_value"]), ["payment_value"], cap_share)


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Parse dates and score, flag comments, blank missing text, label sentiment."""
    score = c.whole_number("review_score")
    return raw.withColumns(
        {
            "review_creation_date": c.timestamp("review_creation_date"),
            "review_answer_timestamp": c.timestamp("review_answer_timestamp"),
            "review_score": score,
            "has_comment": c.has_text("review_comment_message"),
            "review_comment_message": F.coalesce("review_comment_message", F.lit("")),
            "review_comment_title": F.coalesce("review_comment_title", F.lit("")),
            # A missing score counts as negative.
            "sentiment": c.sentiment(score),
        }
    )


def clean_geolocation(raw: DataFrame) -> DataFrame:
    """One centroid per zip, state and city, from distinct coordinates."""
    # The columns of the table.
    place = ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"]
    names = ["geolocation_state", "geolocation_city"]
    distinct = dedup_by_key(raw.select(*place, *names), place, names)
    return distinct.groupBy(place[0], *names).agg(
        *[c.mean_coordinate(at).alias(at) for at in place[1:]]
    )
