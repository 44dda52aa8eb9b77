"""Raw tables for the star schema, derived by Spark from the given test tables.

They look the way raw files do: timestamps and scores partly as text, stray spaces and
mixed case, missing values, prices that are not positive and dates that do not parse.
Every row of the source table is kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

ORDERS = """
    WITH bought AS (
        SELECT *,
               o_orderdate + make_dt_interval(
                   0, cast(o_orderkey % 24 AS int), cast(o_orderkey % 60 AS int), 0
               ) AS at,
               CASE o_orderstatus WHEN 'F' THEN ' Delivered' WHEN 'O' THEN 'DELIVERED '
                    ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'Canceled' ELSE 'shipped' END
               END AS status
        FROM {orders})
    SELECT o_orderkey AS order_id,
           CASE WHEN o_orderkey % 211 <> 0 THEN o_custkey END AS customer_id,
           status AS order_status,
           CASE WHEN o_orderkey % 401 = 0 THEN 'not recorded' ELSE cast(at AS string)
           END AS order_purchase_timestamp,
           CASE WHEN status <> 'Canceled' THEN at + INTERVAL 2 HOURS
           END AS order_approved_at,
           CASE WHEN o_orderstatus <> 'P' THEN at + INTERVAL 27 HOURS
           END AS order_delivered_carrier_date,
           CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 17 <> 0
                THEN cast(at + make_dt_interval(cast(o_orderkey % 31 AS int), 5, 0, 0) AS string)
           END AS order_delivered_customer_date,
           cast(cast(o_orderdate AS date) + 15 AS string) AS order_estimated_delivery_date
    FROM bought"""

ORDER_ITEMS = """
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
           l_partkey AS product_id, l_suppkey AS seller_id,
           cast(l_shipdate AS string) AS shipping_limit_date,
           CASE l_quantity WHEN 1 THEN -l_extendedprice WHEN 2 THEN 0.0D WHEN 3 THEN NULL
                ELSE l_extendedprice END AS price,
           CASE WHEN l_quantity = 4 THEN -1.5D ELSE l_extendedprice * l_tax
           END AS freight_value
    FROM {lineitem}"""

CUSTOMERS = """
    SELECT c_custkey AS customer_id,
           cast(c_custkey * 37 % 123457 AS int) AS customer_zip_code_prefix,
           concat('  ', c_name, ' ') AS customer_city,
           CASE WHEN c_nationkey <> 24 THEN concat(' ', lower(n_name)) END AS customer_state
    FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey"""

SELLERS = """
    SELECT s_suppkey AS seller_id,
           cast(s_suppkey * 991 % 123457 AS int) AS seller_zip_code_prefix,
           concat(' ', s_name) AS seller_city,
           CASE WHEN s_nationkey <> 7 THEN concat(lower(n_name), ' ') END AS seller_state
    FROM {supplier} LEFT JOIN {nation} ON s_nationkey = n_nationkey"""

PRODUCTS = """
    SELECT p_partkey AS product_id,
           CASE WHEN p_size % 10 <> 0 THEN lower(p_brand) END AS product_category_name,
           CASE WHEN p_partkey % 11 <> 0 THEN cast(length(p_name) AS double)
           END AS product_name_lenght,
           p_size * 10 AS product_description_lenght,
           CASE WHEN p_partkey % 13 <> 0 THEN cast(p_size % 6 AS double)
           END AS product_photos_qty
    FROM {part}"""

CATEGORY_TRANSLATION = """
    SELECT concat('brand#', cast(n_nationkey AS string)) AS product_category_name,
           CASE WHEN n_nationkey % 2 = 1 THEN concat('goods of ', lower(n_name))
           END AS product_category_name_english
    FROM {nation}"""

PAYMENTS = """
    SELECT l_orderkey AS order_id,
           CASE WHEN l_quantity = 6 THEN NULL ELSE CASE l_returnflag WHEN 'A' THEN ' Credit_Card' WHEN 'N' THEN 'BOLETO'
                ELSE CASE l_linestatus WHEN 'O' THEN 'not_defined' ELSE 'voucher ' END
           END END AS payment_type,
           l_linenumber AS payment_installments,
           CASE WHEN l_quantity <> 5 THEN l_extendedprice END AS payment_value,
           CASE WHEN l_quantity <> 7 THEN cast(8 - l_linenumber DIV 2 AS int) END AS payment_sequential
    FROM {lineitem}"""

REVIEWS = """
    SELECT event_id AS review_id, event_id DIV 2 AS order_id,
           CASE WHEN event_id % 53 = 0 THEN 'n/a'
                WHEN event_id % 59 <> 0 THEN cast(1 + user_id % 5 AS string)
           END AS review_score,
           CASE WHEN event_type = 'view' THEN event_type END AS review_comment_title,
           CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '   '
                WHEN 'signup' THEN '' ELSE props END AS review_comment_message,
           cast(cast(ts AS date) AS string) AS review_creation_date,
           CASE WHEN event_id % 61 = 0 THEN 'never' ELSE cast(ts AS string)
           END AS review_answer_timestamp
    FROM {events}"""

GEOLOCATION = """
    SELECT cast(l_partkey % 50 AS int) AS geolocation_zip_code_prefix,
           l_quantity / 4 - 10 AS geolocation_lat,
           -l_linenumber / 2 AS geolocation_lng,
           concat('city ', l_linestatus) AS geolocation_city,
           l_returnflag AS geolocation_state
    FROM {lineitem}"""

TABLES = {
    "orders": (ORDERS, ("orders",)),
    "order_items": (ORDER_ITEMS, ("lineitem",)),
    "customers": (CUSTOMERS, ("customer", "nation")),
    "products": (PRODUCTS, ("part",)),
    "category_translation": (CATEGORY_TRANSLATION, ("nation",)),
    "sellers": (SELLERS, ("supplier", "nation")),
    "payments": (PAYMENTS, ("lineitem",)),
    "reviews": (REVIEWS, ("events",)),
    "geolocation": (GEOLOCATION, ("lineitem",)),
}


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class RawTables(Mapping):
    """The raw tables over one test-data directory, planned when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            sql, sources = TABLES[name]
            frames = {s: source(self.spark, self.sf_dir, s) for s in sources}
            self._made[name] = self.spark.sql(sql, **frames)
        return self._made[name]

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)
