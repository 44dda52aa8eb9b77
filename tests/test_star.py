"""Invariants of the star schema on the test tables, and the run from CSV to queries."""

import pytest
from pyspark.sql import functions as F

from checks.standin import RawTables
from starloom import build
from starloom.operators import joins
from starloom.operators.impute import fill_group_median
from starloom.operators.joins import hot_keys
from starloom.plans import business, quality
from starloom.plans.cleaning import clean_geolocation, clean_products
from starloom.plans.star import FACT_COLUMNS, HotKeys, Star, date_dimension, fact_orders
from starloom.sources.raw import RawFiles, write_csv
from starloom.sources.scratch import stage
from starloom.sources.warehouse import TABLES, VIEW_TABLES, Warehouse
from tests.conftest import DATA, plan, rows, unordered


REVIEW_HEADER = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
)


@pytest.fixture(scope="module")
def star(spark):
    return Star(RawTables(spark, DATA))


@pytest.fixture(scope="module")
def stored_fact(star):
    return stage(star.fact_orders, "fact")


def test_fact_has_the_rows_and_revenue_of_the_items(star, stored_fact):
    assert tuple(stored_fact.columns) == FACT_COLUMNS
    assert stored_fact.count() == star.raw["order_items"].count()
    revenue = F.sum((F.col("price") + F.col("freight_value")).cast("decimal(18,4)"))
    total = F.sum(F.col("item_revenue").cast("decimal(18,4)"))
    assert stored_fact.agg(total).first()[0] == star.items.agg(revenue).first()[0]


def test_capped_values_stay_below_the_cap_and_raw_ones_are_kept(star, stored_fact):
    raw = star.raw["order_items"]
    top, raw_top = stored_fact.agg(F.max("price"), F.max("raw_price")).first()
    assert top < raw_top == raw.agg(F.max("price")).first()[0]


def test_hot_orders_do_not_change_the_fact(star, stored_fact):
    args = (star.orders, star.items, star.dim_payments, star.dim_reviews)
    some = [r[0] for r in stored_fact.select("order_id").distinct().limit(20).collect()]
    assert unordered(fact_orders(*args, hot=HotKeys(some, True))) == unordered(stored_fact)


def test_hot_orders_are_found_and_do_not_change_the_fact(star, stored_fact, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 7)
    assert hot_keys(star.items, "order_id").values
    fresh = Star(star.raw)
    assert unordered(fresh.fact_orders) == unordered(stored_fact)


def test_repeated_orders_raise(spark, star):
    raw = RawTables(spark, DATA)
    again = Star({name: raw[name] for name in ("orders", "order_items", "payments", "reviews")})
    again.orders = star.orders.union(star.orders)
    with pytest.raises(ValueError, match="must be unique"):
        again.fact_orders


def test_all_medians_come_from_the_same_passes(spark):
    data = [("a", 1, 4.0), ("a", 3, None), ("a", None, 2.0), ("b", None, 7.5), (None, None, 1.0), ("c:1", 5, None)]
    df = spark.createDataFrame(data, "g string, n int, x double")
    filled = fill_group_median(df, ["n", "x"], "g")
    assert filled.schema == df.schema
    assert unordered(filled) == unordered(
        spark.createDataFrame(
            [("a", 1, 4.0), ("a", 3, 2.0), ("a", 1, 2.0), ("b", None, 7.5), (None, None, 1.0), ("c:1", 5, None)],
            "g string, n int, x double",
        )
    )


def test_fact_shuffles_each_input_once(star, no_broadcast):
    tables = {n: stage(getattr(star, n), n) for n in ("orders", "items", "dim_payments", "dim_reviews")}
    text = plan(fact_orders(*tables.values(), hot=HotKeys([], False)))
    assert text.count("SortMergeJoin") == 3
    assert text.count("Exchange hashpartitioning(order_id") == 4
    assert text.count("Exchange") == 4


def test_what_follows_from_other_columns_is_not_shuffled(spark, star, stored_fact, tmp_path):
    balanced = Star(RawTables(spark, DATA), balanced=True)
    above, _, below = plan(balanced.fact_orders).partition("REBALANCE_PARTITIONS_BY_COL")
    for name in ("item_revenue", "item_total_cost"):
        assert name in above and name not in below
    assert len(star.fact_rows.columns) == 13
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.write("fact_orders", balanced.fact_orders, balanced=True)
    written = warehouse.read("fact_orders").select(*stored_fact.columns)
    assert unordered(written) == unordered(stored_fact)


def test_dimension_keys_are_unique(star):
    for name, key in (("dim_customers", "customer_id"), ("dim_products", "product_id"),
                      ("dim_sellers", "seller_id"), ("dim_date", "date_key")):
        df = getattr(star, name)
        assert df.count() == df.select(key).distinct().count()


def test_products(spark):
    raw = spark.createDataFrame(
        [("p1", "cama", 10.0, 1, 2.0), ("p2", "cama", None, 1, None), ("p3", "so", 7.0, 1, 1.0),
         ("p4", None, None, None, 4.0), ("p5", "vazio", None, 1, 3.0)],
        "product_id string, product_category_name string, product_name_lenght double, "
        "product_description_lenght int, product_photos_qty double",
    )
    names = spark.createDataFrame(
        [("cama", "bed")], "product_category_name string, product_category_name_english string"
    )
    columns = ["product_id", "product_category_name_en", "product_name_length", "product_photos_qty", "is_imputed"]
    assert unordered(clean_products(raw, names).select(columns)) == [
        ("p1", "bed", 10, 2, False), ("p2", "bed", 10, 2, True), ("p3", "so", 7, 1, False),
        ("p4", "unknown", None, 4, True), ("p5", "vazio", None, 3, True),
    ]
    untranslated = clean_products(raw, None, photos="mode")
    assert unordered(untranslated.select(columns))[0] == ("p1", "cama", 10, 2, False)
    assert "product_description_length" in untranslated.columns


def test_dates(spark):
    orders = spark.sql(
        "SELECT explode(array(timestamp_ntz'2017-12-31 23:00:00', timestamp_ntz'2017-12-31 01:00:00', "
        "timestamp_ntz'2018-01-06 00:00:00', NULL)) AS order_purchase_timestamp"
    )
    got = rows(date_dimension(orders).orderBy(F.asc_nulls_last("date_key")))
    assert [r[1:] for r in got] == [
        (2017, 12, 4, 1, "Sunday", "December", 52, True),
        (2018, 1, 1, 7, "Saturday", "January", 1, True),
        (None,) * 8,
    ]


def test_geolocation_drops_repeated_coordinates_before_averaging(spark):
    raw = spark.createDataFrame(
        [(1, -23.5, -46.0, "x", "SP")] * 50 + [(1, -24.5, -47.0, "x", "SP"), (1, -23.5, -46.0, "z", "SP"),
                                               (2, 0.1, 0.2, None, None),
                                               (3, 123456.5, -46.0, "far", "off")],
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string",
    )
    assert unordered(clean_geolocation(raw)) == [
        (1, "SP", "x", -24.0, -46.5), (2, None, None, 0.1, 0.2),
        (3, "off", "far", 123456.5, -46.0),
    ]


def test_month_query_reads_one_year_of_the_warehouse(spark, stored_fact, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.write("fact_orders", stored_fact)
    fact = warehouse.read("fact_orders")
    for query in (business.revenue_by_month_and_payment(fact, 1997), business.monthly_revenue(fact, 1996, 1998)):
        text = plan(query)
        assert "order_year#" in text.split("PartitionFilters: [")[1].split("]")[0]
        schema = text.split("ReadSchema: ")[1].split(">")[0]
        assert "customer_id" not in schema and "raw_price" not in schema


def test_sellers_are_broadcast_only_while_small(spark, star, stored_fact, tmp_path):
    Warehouse(spark, str(tmp_path / "w")).write("dim_sellers", star.dim_sellers)
    sellers = Warehouse(spark, str(tmp_path / "w")).read("dim_sellers")
    assert "BroadcastHashJoin" in plan(business.with_seller(stored_fact, sellers))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "SortMergeJoin" in plan(business.with_seller(stored_fact, sellers))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_from_csv_to_queries(spark, star, stored_fact, tmp_path):
    """Write raw CSV, build the warehouse from it, and get the answers of the direct way."""
    names = {}
    for table in star.raw:
        if table != "category_translation":
            names[table] = f"raw_{table}"
            write_csv(star.raw[table], f"{tmp_path}/raw/raw_{table}")
    raw = build.load_raw(RawFiles(spark, f"{tmp_path}/raw", names))
    assert "category_translation" not in raw
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    build.build_warehouse(raw, warehouse)
    keys, counts = build.check_warehouse(raw, warehouse)
    assert {r["status"] for r in counts.collect()} == {"PASS"}
    quality.require_all_pass(counts)
    with pytest.raises(quality.QualityError, match="dim_date"):
        quality.require_all_pass(counts, keys)
    report = {r["table_name"]: r for r in keys.collect()}
    assert set(report) == set(TABLES)
    assert report["fact_orders"]["row_count"] == stored_fact.count()
    assert report["dim_sellers"]["status"] == "PASS" and report["dim_date"]["status"] == "FAIL"

    warehouse.register_views(VIEW_TABLES)
    assert spark.sql("SELECT count(*) FROM fact_orders").first()[0] == stored_fact.count()
    results = build.run_queries(warehouse)
    assert list(results) == list(build.QUERIES)
    direct = business.payment_analysis(star.dim_payments)
    assert rows(results["payment_analysis"]) == rows(direct)
    from_csv = business.monthly_revenue(warehouse.read("fact_orders"), 1996, 1998)
    assert rows(from_csv) == rows(business.monthly_revenue(stored_fact, 1996, 1998))
    assert "boleto" in build.preview(results["payment_analysis"])
    with pytest.raises(ValueError):
        build.to_client(results["payment_analysis"], max_rows=2)
    assert len(build.to_client(results["payment_analysis"])) == 21


CSV = {
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2017-01-05 10:00:00,2017-01-05 11:00:00,2017-01-06 10:00:00,2017-01-15 10:00:00,2017-01-10 00:00:00
o2,c2,shipped,2017-02-05 20:00:00,2017-02-05 21:00:00,,,2017-02-20 00:00:00
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2017-01-07 00:00:00,100.0,10.0
o1,2,p2,s1,2017-01-07 00:00:00,50.0,5.0
o2,1,p1,s1,2017-02-07 00:00:00,99.0,11.0
""",
    "customers": "customer_id,customer_zip_code_prefix,customer_city,customer_state\nc1,1234,a,sp\nc2,1235,b,rj\n",
    "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty\np1,cama,5,10,1\np2,,,,\n",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,99,c,mg\n",
    "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,credit_card,3,165.0\no2,1,boleto,1,110.0\n",
    "reviews": REVIEW_HEADER + 'r1,o1,5,,"good\nvery",2017-01-16,2017-01-17\n',
    "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n99,-1.5,2.5,c,MG\n",
}


def test_main(spark, tmp_path, capsys):
    (tmp_path / "raw").mkdir()
    for name, text in CSV.items():
        (tmp_path / "raw" / f"my_{name}.csv").write_text(text)
    names = {n: f"my_{n}.csv" for n in CSV}
    build.main(str(tmp_path / "raw"), str(tmp_path / "w"), names)
    out = capsys.readouterr().out
    assert [line for line in out.splitlines() if line.startswith("---")] == [
        f"--- {name}" for name in build.QUERIES
    ]
    assert "PartitionFilters" in out and "2017-02" in out
    months = rows(business.monthly_revenue(Warehouse(spark, str(tmp_path / "w")).read("fact_orders")))
    assert months == [
        (2017, 1, "2017-01", 1, 165.0, 5.0, None, None),
        (2017, 2, "2017-02", 1, 110.0, None, -55.0, -33.33),
    ]


def test_main_goes_on_after_a_finding_when_not_strict(spark, tmp_path, capsys):
    (tmp_path / "raw").mkdir()
    for name, text in CSV.items():
        if name == "orders":
            text += "o3,c2,shipped,never,,,,\n"
        (tmp_path / "raw" / f"{name}.csv").write_text(text.replace("99.0,11.0", "abc,11.0"))
    with pytest.raises(quality.QualityError, match="dim_date"):
        build.main(str(tmp_path / "raw"), str(tmp_path / "w"))
    capsys.readouterr()
    build.main(str(tmp_path / "raw"), str(tmp_path / "v"), strict=False)
    out = capsys.readouterr().out
    assert "orders without items: 1" in out and "order_items.price: 1 texts did not parse" in out
    assert out.count("\n--- ") == len(build.QUERIES)


def test_missing_tables_fail_loudly(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Warehouse(spark, str(tmp_path)).register_views()
