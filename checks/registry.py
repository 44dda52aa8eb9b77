"""Every query of the library, runnable on one test-data directory.

Cleaning steps and dimensions run straight on the raw stand-in tables.  The business
queries read the warehouse, as in production: a table is written to the cluster's
shared folder the first time a query needs it, and read back from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.standin import RawTables, source
from starloom.functions import columns as c
from starloom.functions.columns import UNPARSED
from starloom.operators.dedup import dedup_by_key
from starloom.operators.impute import fill_group_median, fill_group_mode, mark_missing
from starloom.operators.winsorize import winsorize
from starloom.plans import business, cleaning, panels, quality
from starloom.plans.star import Star, payments_per_order, reviews_per_order
from starloom.sources.raw import RawFiles, read_csv, write_csv
from starloom.sources.scratch import scratch_path
from starloom.sources.warehouse import TABLES, VIEW_TABLES, Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# The test orders are from 1995 to 2001.
YEARS = (1996, 1998)
ALL_YEARS = (1990, 2010)
ONE_YEAR = 1997

_warehouses: dict[tuple[str, str], Warehouse] = {}
_written: set[tuple[str, str]] = set()


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        _warehouses[key] = Warehouse(spark, scratch_path(spark, "warehouse"))
    return _warehouses[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A warehouse table, written on first use."""
    warehouse = _warehouse(spark, sf_dir)
    if (warehouse.root, name) not in _written:
        star = Star(RawTables(spark, sf_dir), balanced=True)
        if name == "fact_orders":
            star.dim_payments = table(spark, sf_dir, "dim_payments")
            star.dim_reviews = table(spark, sf_dir, "dim_reviews")
        warehouse.write(name, getattr(star, name), balanced=star.balanced)
        _written.add((warehouse.root, name))
    return warehouse.read(name)


def _star(attribute: str, **options) -> Query:
    return lambda spark, sf_dir: getattr(Star(RawTables(spark, sf_dir), **options), attribute)


def _raw(name: str, plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(RawTables(spark, sf_dir)[name])


def _stored(plan: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: plan(*[table(spark, sf_dir, t) for t in tables])


# --- sources and sinks -------------------------------------------------------------


def src_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "order_items.csv")
    write_csv(RawTables(spark, sf_dir)["order_items"], path)
    ids = dict.fromkeys(("order_id", "product_id", "seller_id"), "bigint")
    types = {**ids, "order_item_id": "int", "price": "double", "freight_value": "double"}
    return read_csv(spark, path, types)


def _write_lines(lines: DataFrame, header: str, path: str) -> None:
    """Files of CSV lines as they are, each with the header."""
    plain = lines.toDF(header).write.option("header", True).option("sep", "\u0001")
    plain.option("quote", "").option("escapeQuotes", False).csv(path)


def src_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item files in which some rows have a field too many, or two too few."""
    root = scratch_path(spark, "raw")
    fields = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    late = F.concat_ws(",", *fields, F.lit("2018-01-01 10:00:00"), "l_linenumber", F.lit("1"))
    shifted = F.concat_ws(",", *fields[:3], F.lit("Rio"), fields[3], F.lit("2018-01-01"), fields[1], F.lit("1"))
    short = F.concat_ws(",", *fields, F.lit("2018-01-01 10:00:00"))
    line = F.when(F.col("l_orderkey") % 97 == 0, shifted).when(F.col("l_orderkey") % 89 == 0, short)
    header = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value"
    items = source(spark, sf_dir, "lineitem").select(line.otherwise(late).alias("line"))
    _write_lines(items, header, f"{root}/order_items.csv")
    good, refused, _ = RawFiles(spark, root).load("order_items")
    return good.drop(UNPARSED).unionByName(refused, allowMissingColumns=True)


def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose types nobody names, written as text and read back."""
    path = scratch_path(spark, "orders.csv")
    key = F.col("o_orderkey")
    given = source(spark, sf_dir, "orders").select(
        key.cast("int").alias("whole"),
        (key * 10_000_000_000).alias("large"),
        F.concat(key.cast("string"), F.lit("0" * 20)).alias("huge"),
        "o_totalprice",
        F.when(key % 2 == 0, key.cast("string")).otherwise(F.lit("0.5")).alias("mixed_numbers"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(key % 3 == 0, F.col("o_orderdate").cast("date").cast("string"))
        .otherwise(F.col("o_orderdate").cast("string")).alias("moment"),
        (key % 2 == 0).alias("even"),
        F.when(key % 7 != 0, key.cast("string")).otherwise("n/a").alias("number_or_text"),
        F.when(key % 5 == 0, key.cast("int")).alias("sparse"),
        F.lit(None).cast("string").alias("nothing"),
        "o_orderpriority",
    )
    write_csv(given, path)
    # The digits of a decimal follow the data; the comparison wants one type at any size.
    return read_csv(spark, path, infer=True).withColumn("huge", F.col("huge").cast("decimal(38,0)"))


def dim_products_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dimension from files; weight and volume are columns nobody names."""
    raw, root = RawTables(spark, sf_dir), scratch_path(spark, "raw")
    number = F.col("product_id")
    products = raw["products"].withColumns(
        {
            "product_weight_g": F.when(number % 4 != 0, number * 25),
            "product_volume_l": F.when(number % 3 != 0, number / 4).otherwise(F.lit(2)),
            "product_note": F.concat(F.lit("note "), number.cast("string")),
        }
    )
    write_csv(products, f"{root}/products.csv")
    files = RawFiles(spark, root, column_types={"products": {"product_id": "bigint"}})
    loaded, _, _ = files.load("products")
    return cleaning.clean_products(loaded, raw["category_translation"]).drop(UNPARSED)


def src_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents.csv")
    write_csv(source(spark, sf_dir, "documents"), path)
    types = {"doc_id": "bigint", "n_chars": "bigint"}
    return read_csv(spark, path, types, multiline=True)


def src_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "fact_orders")


def views_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in VIEW_TABLES:
        table(spark, sf_dir, name)
    _warehouse(spark, sf_dir).register_views()
    counts = [f"SELECT '{t}' AS view_name, count(*) AS row_count FROM {t}" for t in VIEW_TABLES]
    return spark.sql(" UNION ALL ".join(counts))


# --- cleaning steps ----------------------------------------------------------------


def time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.hour("ts")
    return source(spark, sf_dir, "events").select(
        "event_id", hour.alias("hour"), c.day_part(hour).alias("time_of_day")
    )


def invalid_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = cleaning.repair_order_items(RawTables(spark, sf_dir)["order_items"])
    return items.select("order_id", "order_item_id", "raw_price", "price", "price_flag")


def clamp_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return source(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", c.at_least(balance, 0.0).alias("floored")
    )


def winsorize_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
        F.col("l_extendedprice").alias("raw_extendedprice"),
    )
    return winsorize(lines, ["l_extendedprice", "l_quantity"])


def item_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = cleaning.repair_order_items(RawTables(spark, sf_dir)["order_items"])
    totals = cleaning.with_revenue(cleaning.with_total_cost(items))
    return totals.select(
        "order_id", "order_item_id", "price", "freight_value", "item_total_cost",
        "item_revenue",
    )


def _parts_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = F.col("p_partkey") % 5 == 0
    return source(spark, sf_dir, "part").select(
        "p_partkey",
        "p_brand",
        F.when(~gap, F.col("p_size").cast("double")).alias("size"),
        F.when(~gap, F.col("p_retailprice")).alias("price"),
    )


def impute_group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_group_median(_parts_with_gaps(spark, sf_dir), ["size", "price"], "p_brand")


def impute_group_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts_with_gaps(spark, sf_dir).drop("price")
    return fill_group_mode(parts, ["size"], "p_brand")


def impute_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = source(spark, sf_dir, "documents").select("doc_id").join(
        source(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return mark_missing(rated, ["quality", "toxic"], "is_imputed")


def price_from_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = RawTables(spark, sf_dir)
    repaired = cleaning.repair_order_items(raw["order_items"])
    products = table(spark, sf_dir, "dim_products")
    return cleaning.repair_prices_from_category(repaired, products).select(
        "order_id", "order_item_id", "product_id", "raw_price", "price", "item_total_cost"
    )


def geo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_shipdate",
    )
    return dedup_by_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# --- business queries --------------------------------------------------------------


def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return business.monthly_revenue(table(spark, sf_dir, "fact_orders"), *YEARS)


q2 = _stored(business.category_revenue, "fact_orders", "dim_products")
q3 = _stored(business.seller_performance, "fact_orders", "dim_sellers")
q4 = _stored(business.delivery_by_state, "fact_orders", "dim_sellers")
q5 = _stored(business.payment_analysis, "dim_payments")


def _panel(plan: Callable[[DataFrame], DataFrame], query: Query) -> Query:
    return lambda spark, sf_dir: plan(query(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "src_csv_header": src_csv_header,
    "src_csv_multiline": src_csv_multiline,
    "src_csv_quarantine": src_csv_quarantine,
    "src_csv_inferred": src_csv_inferred,
    "src_parquet_partitioned": src_parquet_partitioned,
    "views_smoke": views_smoke,
    "orders_clean": _star("orders"),
    "time_of_day": time_of_day,
    "invalid_to_null": invalid_to_null,
    "clamp_floor": clamp_floor,
    "winsorize_p99": winsorize_p99,
    "item_totals": item_totals,
    "order_items_clean": _star("items"),
    "winsorize_payments": _raw("payments", cleaning.clean_payments),
    "dim_customers": _star("dim_customers"),
    "dim_sellers": _star("dim_sellers"),
    "impute_group_median": impute_group_median,
    "impute_group_mode": impute_group_mode,
    "impute_flag": impute_flag,
    "dim_products": _star("dim_products"),
    "dim_products_from_csv": dim_products_from_csv,
    "dim_products_photos_mode": _star("dim_products", photos="mode"),
    "dim_products_no_translation": _raw(
        "products", lambda raw: cleaning.clean_products(raw, None)
    ),
    "price_from_category": price_from_category,
    "reviews_clean": _raw("reviews", cleaning.clean_reviews),
    "dedup_by_key": geo_dedup,
    "dim_geolocation": _star("dim_geolocation"),
    "payments_per_order": _stored(
        lambda payments: payments_per_order(payments).withColumn(
            "payment_types", F.array_join("payment_types", ",")
        ),
        "dim_payments",
    ),
    "reviews_per_order": _stored(reviews_per_order, "dim_reviews"),
    "reviews_per_order_latest": _stored(
        lambda reviews: reviews_per_order(reviews, "latest"), "dim_reviews"
    ),
    "dim_date": _star("dim_date"),
    "fact_orders": _star("fact_orders"),
    "fact_orders_latest_score": _star("fact_orders", score="latest"),
    "order_items_repaired_prices": _star("items", repair_prices=True),
    "fact_sellers_broadcast": _stored(business.with_seller, "fact_orders", "dim_sellers"),
    "month_paytype_revenue": _stored(
        lambda fact: business.revenue_by_month_and_payment(fact, ONE_YEAR), "fact_orders"
    ),
    "null_audit": lambda spark, sf_dir: quality.audit(
        {name: table(spark, sf_dir, name) for name in TABLES}
    ),
    "row_count_check": lambda spark, sf_dir: quality.compare_row_counts(
        {
            name: (RawTables(spark, sf_dir)[raw], table(spark, sf_dir, name))
            for name, raw in quality.ROW_SOURCES.items()
        }
    ),
    "orphan_keys": lambda spark, sf_dir: quality.orphans(
        {name: table(spark, sf_dir, name) for name in TABLES}
    ),
    "orders_without_items": lambda spark, sf_dir: quality.orders_without_items(
        source(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "order_id"),
        RawTables(spark, sf_dir)["order_items"],
    ),
    "q1_monthly_revenue": q1,
    "q1_without_gaps": _stored(
        lambda fact: business.monthly_revenue_without_gaps(fact, *ALL_YEARS), "fact_orders"
    ),
    "q2_category_revenue": q2,
    "q3_seller_performance": q3,
    "q4_delivery_by_state": q4,
    "q4_late_orders": _stored(business.late_orders_by_state, "fact_orders", "dim_sellers"),
    "q5_payment_analysis": q5,
    "viz_mom_sign": _panel(panels.month_changes, q1),
    "viz_top15_category": _panel(panels.top_categories, q2),
    "viz_minmax_state": _panel(panels.state_heatmap, q4),
    "viz_delay_scatter": _panel(panels.delay_scatter, q4),
    "viz_payment_share": _panel(panels.payment_share, q5),
    "viz_payment_share_orders": _stored(panels.payment_share_of_orders, "dim_payments"),
    "viz_installment_curve": _panel(panels.installment_curve, q5),
    "viz_state_top10": _panel(panels.top_states, q3),
    "viz_state_top10_all": _stored(panels.top_states_of_all, "fact_orders", "dim_sellers"),
    "viz_sparkline": _panel(panels.sparkline, q1),
}
