"""Independent DuckDB SQL for the registered queries.

Each text is complete: it lists the common table expressions it needs, derived from
the test tables, and states the wanted result in plain SQL (windows where the library
aggregates, ``quantile_disc`` where it narrows down, and so on).
"""

from __future__ import annotations

def money(column: str) -> str:
    """The sum of the doubles' shortest decimal forms, rounded once, to a double."""
    exact = f"sum(CAST(CAST({column} AS VARCHAR) AS DECIMAL(38,18)))"
    return f"CAST(CAST({exact} AS VARCHAR) AS DOUBLE)"


# name -> (body, names of the expressions it builds on)
PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_orders": (
        """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 211 <> 0 THEN o_custkey END AS customer_id,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN 'delivered'
                    WHEN o_orderkey % 3 = 0 THEN 'canceled' ELSE 'shipped' END AS status,
               o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) AS moment,
               CAST(o_orderdate AS DATE) + 15 AS due
        FROM orders""",
        (),
    ),
    "orders_clean": (
        """
        SELECT *, status = 'delivered' AS is_delivered,
               CAST(date_diff('day', bought, arrived) AS DOUBLE) AS duration,
               CAST(date_diff('day', CAST(due AS TIMESTAMP), arrived) AS DOUBLE) AS delay,
               CAST(hour(bought) AS INTEGER) AS bought_hour,
               CASE WHEN hour(bought) BETWEEN 6 AND 11 THEN 'Morning'
                    WHEN hour(bought) BETWEEN 12 AND 17 THEN 'Afternoon'
                    WHEN hour(bought) BETWEEN 18 AND 21 THEN 'Evening'
                    ELSE 'Night' END AS part,
               CAST(year(bought) AS INTEGER) AS y, CAST(month(bought) AS INTEGER) AS m,
               CAST(quarter(bought) AS INTEGER) AS q
        FROM (SELECT *,
                     CASE WHEN order_id % 401 <> 0 THEN moment END AS bought,
                     CASE WHEN status = 'delivered' AND order_id % 17 <> 0
                          THEN moment + to_days(CAST(order_id % 31 AS INTEGER)) + to_hours(5)
                     END AS arrived
              FROM raw_orders)""",
        ("raw_orders",),
    ),
    "raw_items": (
        """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
               l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS ships,
               CASE l_quantity WHEN 1 THEN -l_extendedprice WHEN 2 THEN 0.0
                    WHEN 3 THEN NULL ELSE l_extendedprice END AS raw_price,
               CASE WHEN l_quantity = 4 THEN CAST(-1.5 AS DOUBLE)
                    ELSE l_extendedprice * l_tax END AS raw_freight
        FROM lineitem""",
        (),
    ),
    "repaired": (
        """
        SELECT *, CASE WHEN raw_price > 0 THEN raw_price END AS good_price,
               greatest(raw_freight, 0.0) AS good_freight,
               CASE WHEN raw_price <= 0 THEN 'invalid' ELSE 'ok' END AS price_flag
        FROM raw_items""",
        ("raw_items",),
    ),
    "items": (
        """
        SELECT r.*,
               CASE WHEN good_price > p_cap THEN p_cap ELSE good_price END AS price,
               CASE WHEN good_freight > f_cap THEN f_cap ELSE good_freight END AS freight
        FROM repaired r, (SELECT quantile_disc(good_price, 0.99) AS p_cap,
                                 quantile_disc(good_freight, 0.99) AS f_cap FROM repaired)""",
        ("repaired",),
    ),
    "payments": (
        """
        WITH paid AS (
            SELECT *, CASE WHEN l_quantity <> 5 THEN l_extendedprice END AS paid FROM lineitem)
        SELECT l_orderkey AS order_id,
               CASE WHEN l_quantity = 6 THEN NULL WHEN l_returnflag = 'A' THEN 'credit_card'
                    WHEN l_returnflag = 'N' THEN 'boleto'
                    WHEN l_linestatus = 'O' THEN 'not_defined' ELSE 'voucher'
               END AS payment_type,
               l_linenumber AS payment_installments,
               CASE WHEN paid > cap THEN cap ELSE paid END AS payment_value,
               CASE WHEN l_quantity <> 7 THEN 8 - l_linenumber // 2 END AS payment_sequential,
               paid AS raw_payment_value
        FROM paid, (SELECT quantile_disc(paid, 0.99) AS cap FROM paid)""",
        (),
    ),
    "pay_agg": (
        f"""
        SELECT order_id,
               {money('payment_value')} AS total_payment_value,
               CAST(sum(payment_installments) AS BIGINT) AS total_installments,
               coalesce(array_to_string(list_sort(
                   list(DISTINCT payment_type) FILTER (payment_type IS NOT NULL)), ','), '')
                   AS payment_types,
               first(payment_type ORDER BY payment_sequential NULLS LAST,
                     payment_value DESC NULLS LAST, payment_type)
                   FILTER (payment_type IS NOT NULL) AS primary_payment_type
        FROM payments GROUP BY order_id""",
        ("payments",),
    ),
    "reviews": (
        """
        SELECT event_id AS review_id, event_id // 2 AS order_id,
               CASE WHEN event_id % 53 = 0 OR event_id % 59 = 0 THEN NULL
                    ELSE CAST(1 + user_id % 5 AS INTEGER) END AS review_score,
               CASE event_type WHEN 'view' THEN 'view' ELSE '' END AS review_comment_title,
               CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN '   '
                    WHEN 'signup' THEN '' ELSE props END AS review_comment_message,
               date_trunc('day', ts)::TIMESTAMP AS review_creation_date,
               CASE WHEN event_id % 61 <> 0 THEN ts END AS review_answer_timestamp,
               event_type IN ('click', 'purchase') AS has_comment
        FROM events""",
        (),
    ),
    "rev_agg": (
        """
        SELECT order_id, avg(review_score) AS avg_review_score,
               max(review_score) AS max_review_score,
               CAST(sum(CAST(has_comment AS INTEGER)) AS BIGINT) AS comment_count
        FROM reviews GROUP BY order_id""",
        ("reviews",),
    ),
    "fact": (
        """
        SELECT i.order_id, i.order_item_id, o.customer_id, i.seller_id, i.product_id,
               o.status AS order_status, o.is_delivered,
               o.bought AS order_purchase_timestamp, o.y AS order_year, o.m AS order_month,
               o.q AS order_quarter, o.part AS time_of_day, o.bought_hour AS purchase_hour,
               o.arrived AS order_delivered_customer_date,
               CAST(o.due AS TIMESTAMP) AS order_estimated_delivery_date,
               o.duration AS delivery_duration_days, o.delay AS delivery_delay_days,
               i.price, i.raw_price, i.freight AS freight_value,
               i.raw_freight AS raw_freight_value,
               coalesce(i.price, 0.0) + i.freight AS item_total_cost,
               i.price + i.freight AS item_revenue,
               p.total_payment_value, p.primary_payment_type, p.total_installments,
               r.avg_review_score, r.comment_count
        FROM items i LEFT JOIN orders_clean o USING (order_id)
             LEFT JOIN pay_agg p USING (order_id) LEFT JOIN rev_agg r USING (order_id)""",
        ("items", "orders_clean", "pay_agg", "rev_agg"),
    ),
    "sellers": (
        """
        SELECT s_suppkey AS seller_id,
               CAST(s_suppkey * 991 % 123457 AS INTEGER) AS seller_zip_code_prefix,
               lower(s_name) AS seller_city,
               CASE WHEN s_nationkey <> 7 THEN upper(n_name) END AS seller_state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
        (),
    ),
    "named_products": (
        """
        SELECT p_partkey AS product_id,
               CASE WHEN p_size % 10 <> 0 THEN lower(p_brand) END AS native,
               CASE WHEN p_partkey % 11 <> 0 THEN length(p_name) END AS name_length,
               p_size * 10 AS description_length,
               CASE WHEN p_partkey % 13 <> 0 THEN p_size % 6 END AS photos
        FROM part""",
        (),
    ),
    "translated_products": (
        """
        SELECT p.*, CASE WHEN n_nationkey IS NOT NULL
                         THEN 'goods of ' || lower(n_name) END AS english
        FROM named_products p LEFT JOIN nation
             ON n_nationkey % 2 = 1 AND native = 'brand#' || n_nationkey""",
        ("named_products",),
    ),
    "products": (
        """
        SELECT t.*, coalesce(english, native, 'unknown') AS category
        FROM translated_products t""",
        ("translated_products",),
    ),
    "geo": (
        """
        SELECT CAST(l_partkey % 50 AS INTEGER) AS zip, l_quantity / 4 - 10 AS lat,
               -l_linenumber / 2 AS lng, 'city ' || l_linestatus AS city,
               l_returnflag AS state
        FROM lineitem""",
        (),
    ),
    "months": (
        f"""
        SELECT order_year, order_month, count(DISTINCT order_id) AS total_orders,
               {money('item_revenue')} AS revenue,
               {money('avg_review_score')} / count(avg_review_score) AS rating
        FROM fact
        WHERE order_status <> 'canceled' AND order_year BETWEEN 1996 AND 1998
        GROUP BY ALL""",
        ("fact",),
    ),
    "all_months": (
        f"""
        SELECT order_year, order_month, count(DISTINCT order_id) AS total_orders,
               {money('item_revenue')} AS revenue,
               {money('avg_review_score')} / count(avg_review_score) AS rating
        FROM fact
        WHERE order_status <> 'canceled' AND order_year IS NOT NULL
        GROUP BY ALL""",
        ("fact",),
    ),
}


def r(value: str, digits: int) -> str:
    """Round half away from zero, on the decimal value."""
    exact = f"CAST(CAST(CAST({value} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18))"
    return f"CAST(round({exact}, {digits}) AS DOUBLE)"


def mean(column: str) -> str:
    return f"{money(column)} / nullif(count({column}), 0)"


def trend(months: str) -> str:
    return f"""
        SELECT order_year, order_month,
               order_year || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS year_month,
               total_orders, {r('revenue', 2)} AS monthly_revenue, {r('rating', 2)} AS avg_rating,
               {r('revenue - prev', 2)} AS revenue_mom_change,
               {r('CAST(revenue - prev AS DOUBLE) / nullif(CAST(prev AS DOUBLE), 0) * 100', 2)}
                   AS revenue_mom_pct
        FROM (SELECT *, lag(revenue) OVER (ORDER BY order_year, order_month) AS prev
              FROM {months})"""


PARTS |= {
    "q1": (trend("months"), ("months",)),
    "q2": (
        f"""
        SELECT category, count(DISTINCT f.order_id) AS total_orders,
               count(order_item_id) AS total_items_sold,
               {r(money('item_revenue'), 2)} AS total_revenue,
               {r(mean('price'), 2)} AS avg_price,
               {r(mean('avg_review_score'), 2)} AS avg_rating,
               CAST(rank() OVER (ORDER BY {money('item_revenue')} DESC NULLS LAST) AS INTEGER)
                   AS revenue_rank,
               CAST(row_number() OVER (ORDER BY {money('item_revenue')} DESC NULLS LAST, category)
                    AS INTEGER) AS row_num
        FROM fact f JOIN products USING (product_id)
        WHERE order_status <> 'canceled'
        GROUP BY category ORDER BY row_num LIMIT 20""",
        ("fact", "products"),
    ),
    "q3": (
        f"""
        SELECT * FROM (
            SELECT f.seller_id, seller_state, seller_city,
                   count(DISTINCT order_id) AS total_orders,
                   {r(money('item_revenue'), 2)} AS total_revenue,
                   {r(mean('avg_review_score'), 2)} AS avg_rating,
                   {r(mean('delivery_duration_days'), 1)} AS avg_delivery_days,
                   CAST(row_number() OVER (PARTITION BY seller_state
                        ORDER BY count(DISTINCT order_id) DESC, f.seller_id) AS INTEGER)
                       AS state_rank
            FROM fact f LEFT JOIN sellers s ON f.seller_id = s.seller_id
            WHERE order_status = 'delivered'
            GROUP BY f.seller_id, seller_state, seller_city
            HAVING count(DISTINCT order_id) >= 10)
        ORDER BY total_revenue DESC NULLS LAST, seller_id LIMIT 30""",
        ("fact", "sellers"),
    ),
    "q4": (
        f"""
        SELECT seller_state, count(DISTINCT order_id) AS total_orders,
               {r(mean('delivery_duration_days'), 1)} AS avg_delivery_days,
               {r(mean('delivery_delay_days'), 1)} AS avg_delay_days,
               {r(mean('avg_review_score'), 2)} AS avg_review_score,
               count(*) FILTER (delivery_delay_days > 0) AS late_deliveries,
               {r('count(*) FILTER (delivery_delay_days > 0) / count(DISTINCT order_id) * 100', 1)}
                   AS late_pct
        FROM fact LEFT JOIN sellers USING (seller_id)
        WHERE is_delivered AND delivery_duration_days IS NOT NULL
        GROUP BY seller_state""",
        ("fact", "sellers"),
    ),
    "q5": (
        f"""
        SELECT payment_type, payment_installments, count(DISTINCT order_id) AS order_count,
               {r(mean('payment_value'), 2)} AS avg_order_value,
               {r(money('payment_value'), 2)} AS total_value,
               {r(mean('payment_value'), 2)} AS avg_payment
        FROM payments WHERE payment_type NOT IN ('not_defined')
        GROUP BY payment_type, payment_installments""",
        ("payments",),
    ),
}


def _with(sql: str, *needs: str) -> str:
    """Put the needed expressions, and what they build on, in front of a query."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in PARTS[name][1]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][0]})" for n in ordered) + "\n" + sql


def _product_query(category: str, english: str, source: str) -> str:
    filled = "CAST(coalesce({0}, quantile_disc({0}, 0.5) OVER (PARTITION BY {1})) AS INTEGER)"
    return _with(
        f"""
        SELECT product_id, native AS product_category_name, {english}
               {filled.format('name_length', category)} AS product_name_length,
               description_length AS product_description_length,
               {filled.format('photos', category)} AS product_photos_qty,
               {category} AS product_category_name_en,
               native IS NULL OR name_length IS NULL OR photos IS NULL AS is_imputed
        FROM {source}""",
        source,
    )


_AUDITED = {
    "fact_orders": ("fact", ("order_id", "product_id", "seller_id", "customer_id")),
    "dim_customers": ("customer", ("c_custkey",)),
    "dim_products": ("part", ("p_partkey",)),
    "dim_sellers": ("supplier", ("s_suppkey",)),
    "dim_date": ("(SELECT DISTINCT CAST(bought AS DATE) AS date_key FROM orders_clean)", ("date_key",)),
    "dim_payments": ("payments", ("order_id",)),
    "dim_reviews": ("reviews", ("review_id",)),
    "dim_geolocation": ("(SELECT DISTINCT zip, state, city FROM geo_kept)", ("zip",)),
}
PARTS["geo_kept"] = (
    """
    SELECT * FROM geo
    QUALIFY row_number() OVER (PARTITION BY zip, lat, lng ORDER BY state, city) = 1""",
    ("geo",),
)


def _audit() -> str:
    selects = []
    for name, (source, keys) in _AUDITED.items():
        nulls = [f"count(*) FILTER ({k} IS NULL)" for k in keys]
        detail = ", ".join(
            f"CASE WHEN {n} > 0 THEN '{k}=' || {n} END" for n, k in zip(nulls, keys)
        )
        total = " + ".join(nulls)
        selects.append(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, {total} AS null_keys, "
            f"concat_ws(', ', {detail}) AS null_detail, "
            f"CASE WHEN {total} > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM {source}"
        )
    return _with(
        "\nUNION ALL ".join(selects), "fact", "orders_clean", "payments", "reviews", "geo_kept"
    )


_HEAT = ("avg_delivery_days", "avg_delay_days", "avg_review_score", "late_pct")

def _orphans() -> str:
    references = (
        ("fact_orders", "fact", "product_id", "dim_products", "SELECT p_partkey FROM part"),
        ("fact_orders", "fact", "seller_id", "dim_sellers", "SELECT s_suppkey FROM supplier"),
        ("fact_orders", "fact", "customer_id", "dim_customers", "SELECT c_custkey FROM customer"),
        ("dim_payments", "payments", "order_id", "fact_orders", "SELECT l_orderkey FROM lineitem"),
        ("dim_reviews", "reviews", "order_id", "fact_orders", "SELECT l_orderkey FROM lineitem"),
    )
    selects = [
        f"SELECT '{name}.{key}' AS reference, '{other}' AS refers_to, "
        f"count(DISTINCT {key}) AS orphan_keys, count(*) AS orphan_rows FROM {source} "
        f"WHERE {key} IS NOT NULL AND {key} NOT IN ({known})"
        for name, source, key, other, known in references
    ]
    return _with("\nUNION ALL ".join(selects), "fact", "payments", "reviews")


ORACLES: dict[str, str] = {
    "src_csv_header": _with(
        """
        SELECT order_id, order_item_id, product_id, seller_id,
               strftime(ships, '%Y-%m-%d %H:%M:%S') AS shipping_limit_date,
               raw_price AS price, raw_freight AS freight_value
        FROM raw_items""",
        "raw_items",
    ),
    "src_csv_multiline": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "src_csv_quarantine": """
        WITH lines AS (
            SELECT *, CASE WHEN l_orderkey % 97 = 0
                THEN concat_ws(',', l_orderkey, l_linenumber, l_partkey, 'Rio', l_suppkey,
                               '2018-01-01', l_linenumber, '1')
                WHEN l_orderkey % 89 = 0
                THEN concat_ws(',', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                               '2018-01-01 10:00:00') END AS refused
            FROM lineitem)
        SELECT CASE WHEN refused IS NULL THEN CAST(l_orderkey AS VARCHAR) END AS order_id,
               CASE WHEN refused IS NULL THEN l_linenumber END AS order_item_id,
               CASE WHEN refused IS NULL THEN CAST(l_partkey AS VARCHAR) END AS product_id,
               CASE WHEN refused IS NULL THEN CAST(l_suppkey AS VARCHAR) END AS seller_id,
               CASE WHEN refused IS NULL THEN TIMESTAMP '2018-01-01 10:00:00' END AS shipping_limit_date,
               CASE WHEN refused IS NULL THEN CAST(l_linenumber AS DOUBLE) END AS price,
               CASE WHEN refused IS NULL THEN 1.0::DOUBLE END AS freight_value,
               CASE WHEN refused IS NOT NULL THEN 'order_items' END AS table_name,
               refused AS malformed_row
        FROM lines""",
    "src_csv_inferred": """
        SELECT CAST(o_orderkey AS INTEGER) AS whole, o_orderkey * 10000000000 AS large,
               CAST(o_orderkey || repeat('0', 20) AS DECIMAL(38, 0)) AS huge, o_totalprice,
               CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS DOUBLE) ELSE 0.5 END AS mixed_numbers,
               CAST(o_orderdate AS DATE) AS day, o_orderdate AS moment, o_orderkey % 2 = 0 AS even,
               CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'n/a' END AS number_or_text,
               CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS INTEGER) END AS sparse,
               CAST(NULL AS VARCHAR) AS nothing, o_orderpriority
        FROM orders""",
    "src_parquet_partitioned": _with(
        """
        SELECT * FROM fact""",
        "fact",
    ),
    "views_smoke": _with(
        """
        SELECT 'fact_orders' AS view_name, count(*) AS row_count FROM lineitem
        UNION ALL SELECT 'dim_customers', count(*) FROM customer
        UNION ALL SELECT 'dim_products', count(*) FROM part
        UNION ALL SELECT 'dim_sellers', count(*) FROM supplier
        UNION ALL SELECT 'dim_date', count(*)
                  FROM (SELECT DISTINCT CAST(bought AS DATE) FROM orders_clean)
        UNION ALL SELECT 'dim_payments', count(*) FROM lineitem
        UNION ALL SELECT 'dim_reviews', count(*) FROM events""",
        "orders_clean",
    ),
    "orphan_keys": _orphans(),
    "orders_clean": _with(
        """
        SELECT order_id, customer_id, status AS order_status,
               bought AS order_purchase_timestamp,
               CASE WHEN status <> 'canceled' THEN moment + to_hours(2) END AS order_approved_at,
               CASE WHEN status = 'delivered' THEN moment + to_hours(27)
               END AS order_delivered_carrier_date,
               arrived AS order_delivered_customer_date,
               CAST(due AS TIMESTAMP) AS order_estimated_delivery_date,
               is_delivered, duration AS delivery_duration_days,
               delay AS delivery_delay_days, bought_hour AS purchase_hour,
               part AS time_of_day, y AS order_year, m AS order_month, q AS order_quarter
        FROM orders_clean""",
        "orders_clean",
    ),
    "time_of_day": """
        SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour,
               CASE WHEN hour(ts) >= 6 AND hour(ts) < 12 THEN 'Morning'
                    WHEN hour(ts) >= 12 AND hour(ts) < 18 THEN 'Afternoon'
                    WHEN hour(ts) >= 18 AND hour(ts) < 22 THEN 'Evening'
                    ELSE 'Night' END AS time_of_day
        FROM events""",
    "invalid_to_null": _with(
        """
        SELECT order_id, order_item_id, raw_price, good_price AS price, price_flag
        FROM repaired""",
        "repaired",
    ),
    "clamp_floor": """
        SELECT c_custkey, c_acctbal, greatest(c_acctbal, 0.0) AS floored FROM customer""",
    "winsorize_p99": """
        SELECT l_orderkey, l_linenumber, l_extendedprice AS raw_extendedprice,
               least(l_extendedprice, (SELECT quantile_disc(l_extendedprice, 0.99)
                                       FROM lineitem)) AS l_extendedprice,
               least(l_quantity, (SELECT quantile_disc(l_quantity, 0.99)
                                  FROM lineitem)) AS l_quantity
        FROM lineitem""",
    "item_totals": _with(
        """
        SELECT order_id, order_item_id, good_price AS price, good_freight AS freight_value,
               coalesce(good_price, 0.0) + good_freight AS item_total_cost,
               good_price + good_freight AS item_revenue
        FROM repaired""",
        "repaired",
    ),
    "order_items_clean": _with(
        """
        SELECT order_id, order_item_id, product_id, seller_id,
               ships AS shipping_limit_date, price, freight AS freight_value, raw_price,
               raw_freight AS raw_freight_value, price_flag,
               coalesce(price, 0.0) + freight AS item_total_cost
        FROM items""",
        "items",
    ),
    "winsorize_payments": _with(
        """
        SELECT order_id, payment_type, payment_installments, payment_value,
               payment_sequential, raw_payment_value
        FROM payments""",
        "payments",
    ),
    "dim_customers": """
        SELECT c_custkey AS customer_id,
               CAST(c_custkey * 37 % 123457 AS INTEGER) AS customer_zip_code_prefix,
               lower(c_name) AS customer_city,
               CASE WHEN c_nationkey <> 24 THEN upper(n_name) END AS customer_state,
               CASE WHEN c_custkey * 37 % 123457 < 100000
                    THEN right('0000' || (c_custkey * 37 % 123457), 5)
                    ELSE CAST(c_custkey * 37 % 123457 AS VARCHAR) END
                   AS customer_zip_str
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "dim_sellers": _with(
        """
        SELECT *, printf('%05d', seller_zip_code_prefix) AS seller_zip_str
        FROM sellers""",
        "sellers",
    ),
    "impute_group_median": """
        SELECT p_partkey, p_brand,
               coalesce(size, quantile_disc(size, 0.5) OVER (PARTITION BY p_brand)) AS size,
               coalesce(price, quantile_disc(price, 0.5) OVER (PARTITION BY p_brand)) AS price
        FROM (SELECT *, CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS DOUBLE) END AS size,
                     CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END AS price
              FROM part)""",
    "impute_group_mode": """
        WITH sized AS (
            SELECT *, CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS DOUBLE) END AS size
            FROM part),
        ranked AS (
            SELECT p_brand, size AS usual,
                   row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, size) AS place
            FROM sized WHERE size IS NOT NULL GROUP BY p_brand, size)
        SELECT p_partkey, p_brand, coalesce(size, usual) AS size
        FROM sized LEFT JOIN ranked USING (p_brand) WHERE place = 1""",
    "impute_flag": """
        SELECT doc_id, quality, toxic, quality IS NULL OR toxic IS NULL AS is_imputed
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "dim_products": _product_query(
        "category", "english AS product_category_name_english,", "products"
    ),
    "dim_products_from_csv": _product_query(
        "category",
        """english AS product_category_name_english,
        CASE WHEN product_id % 4 <> 0 THEN CAST(product_id * 25 AS INTEGER) END AS product_weight_g,
        CASE WHEN product_id % 3 <> 0 THEN product_id / 4 ELSE 2 END AS product_volume_l,
        'note ' || product_id AS product_note,""",
        "products",
    ),
    "dim_products_photos_mode": _with(
        """
        SELECT product_id, native AS product_category_name,
               english AS product_category_name_english,
               CAST(coalesce(name_length, quantile_disc(name_length, 0.5)
                             OVER (PARTITION BY category)) AS INTEGER) AS product_name_length,
               description_length AS product_description_length,
               CAST(coalesce(photos, usual) AS INTEGER) AS product_photos_qty,
               category AS product_category_name_en,
               native IS NULL OR name_length IS NULL OR photos IS NULL AS is_imputed
        FROM products LEFT JOIN (
            SELECT category, photos AS usual FROM products WHERE photos IS NOT NULL
            GROUP BY category, photos
            QUALIFY row_number() OVER (
                PARTITION BY category ORDER BY count(*) DESC, photos) = 1) USING (category)""",
        "products",
    ),
    "dim_products_no_translation": _product_query(
        "coalesce(native, 'unknown')", "", "named_products"
    ),
    "price_from_category": _with(
        """
        SELECT order_id, order_item_id, product_id, raw_price,
               coalesce(good_price, median) AS price,
               coalesce(good_price, median, 0.0) + good_freight AS item_total_cost
        FROM repaired JOIN products USING (product_id) LEFT JOIN (
            SELECT category, quantile_disc(good_price, 0.5) AS median
            FROM repaired JOIN products USING (product_id) GROUP BY category) USING (category)""",
        "repaired",
        "products",
    ),
    "reviews_clean": _with(
        """
        SELECT *, CASE WHEN review_score IN (4, 5) THEN 'positive'
                       WHEN review_score = 3 THEN 'neutral' ELSE 'negative' END AS sentiment
        FROM reviews""",
        "reviews",
    ),
    "dedup_by_key": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
        FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "dim_geolocation": _with(
        """
        SELECT zip AS geolocation_zip_code_prefix, state AS geolocation_state,
               city AS geolocation_city, avg(lat) AS geolocation_lat,
               avg(lng) AS geolocation_lng
        FROM geo_kept GROUP BY zip, state, city""",
        "geo_kept",
    ),
    "payments_per_order": _with("SELECT * FROM pay_agg", "pay_agg"),
    "reviews_per_order": _with("SELECT * FROM rev_agg", "rev_agg"),
    "reviews_per_order_latest": _with(
        """
        SELECT order_id, max_review_score, comment_count,
               CAST(review_score AS DOUBLE) AS avg_review_score
        FROM rev_agg JOIN (
            SELECT order_id, review_score FROM reviews
            QUALIFY row_number() OVER (
                PARTITION BY order_id
                ORDER BY review_answer_timestamp DESC NULLS LAST, review_id DESC) = 1)
            USING (order_id)""",
        "rev_agg",
    ),
    "dim_date": _with(
        """
        SELECT date_key, CAST(year(date_key) AS INTEGER) AS year,
               CAST(month(date_key) AS INTEGER) AS month,
               CAST(quarter(date_key) AS INTEGER) AS quarter,
               CAST(dayofweek(date_key) + 1 AS INTEGER) AS day_of_week,
               dayname(date_key) AS day_name, monthname(date_key) AS month_name,
               CAST(weekofyear(date_key) AS INTEGER) AS week_of_year,
               dayofweek(date_key) IN (0, 6) AS is_weekend
        FROM (SELECT DISTINCT CAST(bought AS DATE) AS date_key FROM orders_clean)""",
        "orders_clean",
    ),
    "fact_orders": _with("SELECT * FROM fact", "fact"),
    "fact_orders_latest_score": _with(
        """
        SELECT fact.* REPLACE (CAST(last_score AS DOUBLE) AS avg_review_score)
        FROM fact LEFT JOIN (
            SELECT order_id, review_score AS last_score FROM reviews
            QUALIFY row_number() OVER (
                PARTITION BY order_id
                ORDER BY review_answer_timestamp DESC NULLS LAST, review_id DESC) = 1)
            USING (order_id)""",
        "fact",
        "reviews",
    ),
    "order_items_repaired_prices": _with(
        """
        , filled AS (
            SELECT *, coalesce(good_price, median) AS full_price
            FROM repaired LEFT JOIN products USING (product_id) LEFT JOIN (
                SELECT category, quantile_disc(good_price, 0.5) AS median
                FROM repaired JOIN products USING (product_id)
                GROUP BY category) USING (category)),
        caps AS (
            SELECT quantile_disc(full_price, 0.99) AS top_price,
                   quantile_disc(good_freight, 0.99) AS top_freight
            FROM filled),
        capped AS (
            SELECT *, CASE WHEN full_price IS NOT NULL
                           THEN least(full_price, top_price) END AS price,
                   CASE WHEN good_freight IS NOT NULL
                        THEN least(good_freight, top_freight) END AS freight_value
            FROM filled, caps)
        SELECT order_id, order_item_id, product_id, seller_id,
               ships AS shipping_limit_date, price, freight_value, raw_price,
               raw_freight AS raw_freight_value, price_flag,
               coalesce(price, 0.0) + freight_value AS item_total_cost
        FROM capped""",
        "repaired",
        "products",
    ),
    "fact_sellers_broadcast": _with(
        """
        SELECT f.*, seller_zip_code_prefix, seller_city, seller_state,
               printf('%05d', seller_zip_code_prefix) AS seller_zip_str
        FROM fact f LEFT JOIN sellers USING (seller_id)""",
        "fact",
        "sellers",
    ),
    "month_paytype_revenue": _with(
        f"""
        SELECT order_month, primary_payment_type,
               CAST({money('item_revenue')} AS DOUBLE) AS monthly_revenue
        FROM fact WHERE order_year = 1997 GROUP BY ALL""",
        "fact",
    ),
    "null_audit": _audit(),
    "row_count_check": "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS raw_rows, count(*) AS row_count, "
        f"'PASS' AS status FROM {source}"
        for name, source in (
            ("fact_orders", "lineitem"),
            ("dim_customers", "customer"),
            ("dim_products", "part"),
            ("dim_sellers", "supplier"),
            ("dim_payments", "lineitem"),
            ("dim_reviews", "events"),
        )
    ),
    "orders_without_items": """
        SELECT o_orderkey AS order_id, * EXCLUDE (o_orderkey) FROM orders
        WHERE NOT EXISTS (FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "q1_monthly_revenue": _with("SELECT * FROM q1", "q1"),
    "q1_without_gaps": _with(
        trend(
            """(SELECT CAST(n // 12 AS INTEGER) AS order_year,
                       CAST(n % 12 + 1 AS INTEGER) AS order_month,
                       coalesce(total_orders, 0) AS total_orders,
                       coalesce(revenue, 0) AS revenue, rating
                FROM (SELECT unnest(generate_series(min(order_year * 12 + order_month - 1),
                                                    max(order_year * 12 + order_month - 1))) AS n
                      FROM all_months)
                LEFT JOIN all_months ON order_year * 12 + order_month - 1 = n)"""
        ),
        "all_months",
    ),
    "q2_category_revenue": _with("SELECT * FROM q2", "q2"),
    "q3_seller_performance": _with("SELECT * FROM q3", "q3"),
    "q4_delivery_by_state": _with("SELECT * FROM q4", "q4"),
    "q4_late_orders": _with(
        f"""
        SELECT seller_state, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT order_id) FILTER (delivery_delay_days > 0) AS late_orders,
               {r('late_orders / total_orders * 100', 1)} AS late_order_pct
        FROM fact LEFT JOIN sellers USING (seller_id)
        WHERE is_delivered AND delivery_duration_days IS NOT NULL
        GROUP BY seller_state""",
        "fact",
        "sellers",
    ),
    "q5_payment_analysis": _with("SELECT * FROM q5", "q5"),
    "viz_mom_sign": _with(
        """
        SELECT year_month, monthly_revenue,
               coalesce(revenue_mom_change, 0) AS revenue_mom_change,
               CASE WHEN revenue_mom_change < 0 THEN 'down' ELSE 'up' END AS direction
        FROM q1""",
        "q1",
    ),
    "viz_top15_category": _with(
        """
        SELECT category, total_revenue / 1e6 AS revenue_millions, avg_rating
        FROM q2 WHERE row_num <= 15""",
        "q2",
    ),
    "viz_minmax_state": _with(
        "SELECT seller_state, total_orders, "
        + ", ".join(
            f"{h}, ({h} - min({h}) OVER ()) / (max({h}) OVER () - min({h}) OVER () + 1e-9) "
            f"AS {h}_scaled"
            for h in _HEAT
        )
        + """
        FROM (FROM q4 ORDER BY total_orders DESC, seller_state NULLS FIRST LIMIT 15)""",
        "q4",
    ),
    "viz_delay_scatter": _with(
        """
        SELECT seller_state, avg_delay_days, avg_review_score,
               total_orders / 50 AS bubble_size
        FROM q4 WHERE avg_delay_days IS NOT NULL AND avg_review_score IS NOT NULL""",
        "q4",
    ),
    "viz_payment_share": _with(
        f"""
        SELECT payment_type, CAST(sum(order_count) AS BIGINT) AS order_count,
               {r('sum(order_count) / (SELECT sum(order_count) FROM q5) * 100', 1)} AS share_pct
        FROM q5 GROUP BY payment_type""",
        "q5",
    ),
    "viz_payment_share_orders": _with(
        f"""
        SELECT payment_type, order_count,
               {r('order_count / sum(order_count) OVER () * 100', 1)} AS share_pct
        FROM (SELECT payment_type, count(DISTINCT order_id) AS order_count
              FROM payments WHERE payment_type <> 'not_defined' GROUP BY payment_type)""",
        "payments",
    ),
    "viz_installment_curve": _with(
        """
        SELECT payment_installments, avg(avg_order_value) AS avg_order_value FROM q5
        WHERE payment_type = 'credit_card' AND payment_installments BETWEEN 1 AND 12
        GROUP BY payment_installments""",
        "q5",
    ),
    "viz_state_top10": _with(
        f"""
        SELECT seller_state, total / 1e6 AS revenue_millions,
               row_number() OVER (ORDER BY total DESC, seller_state) = 1 AS is_largest
        FROM (SELECT seller_state,
                     {money('total_revenue')} AS total
              FROM q3 WHERE seller_state IS NOT NULL
              GROUP BY seller_state ORDER BY total DESC, seller_state LIMIT 10)""",
        "q3",
    ),
    "viz_state_top10_all": _with(
        f"""
        SELECT seller_state, total / 1e6 AS revenue_millions,
               total = max(total) OVER () AS is_largest
        FROM (SELECT seller_state, CAST({money('item_revenue')} AS DOUBLE) AS total
              FROM fact JOIN sellers USING (seller_id)
              WHERE order_status = 'delivered' AND seller_state IS NOT NULL
              GROUP BY seller_state ORDER BY total DESC, seller_state LIMIT 10)""",
        "fact",
        "sellers",
    ),
    "viz_sparkline": _with(
        """
        SELECT CAST(row_number() OVER (ORDER BY order_year, order_month) - 1 AS INTEGER)
                   AS month_index,
               monthly_revenue
        FROM q1""",
        "q1",
    ),
}
