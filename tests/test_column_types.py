"""Types found on the way, and rows whose number of fields is wrong."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.build import build_warehouse, load_raw, notes
from starloom.plans import quality
from starloom.sources import column_types
from starloom.sources.raw import MALFORMED, RawFiles, read_csv, read_text
from tests.conftest import plan, rows, unordered


def types_of(spark, values):
    text = spark.createDataFrame([(v,) for v in values], "v string")
    return column_types.infer_types(text, ["v"]).get("v", "string")


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "-2", "+3", None, ""], "int"),
        (["1", "2147483648"], "bigint"),
        (["9223372036854775808", "1"], "decimal(19,0)"),
        (["00" + "9" * 38], "decimal(38,0)"),
        (["9" * 39], "double"),
        (["1", "2.5", "1e3", "-.5", "NaN", "Infinity"], "double"),
        (["2018-01-02", "2018-02-28"], "date"),
        (["2018-01-02", "2018-01-02 10:11:12"], "timestamp_ntz"),
        (["2018-01-02T10:11:12.123456"], "timestamp_ntz"),
        (["2018-02-30"], "string"),
        (["true", "False", None], "boolean"),
        (["1", "true"], "string"),
        (["1", "2018-01-02"], "string"),
        (["1", "x"], "string"),
        ([" 1"], "string"),
        ([None, ""], "string"),
        ([], "string"),
    ],
)
def test_the_narrowest_type_that_fits(spark, values, kind):
    assert types_of(spark, values) == kind


def test_tallies_add_up_over_tasks(spark):
    text = spark.range(1000).select(F.col("id").cast("string").alias("a.b")).repartition(7)
    assert column_types.infer_types(text, ["a.b"]) == {"a.b": "int"}
    assert column_types.infer_types(text, []) == {}


PRODUCTS = """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_ratio,product_note
p1,toys,10,100,1,250,0.5,a
p2,toys,,100,,300,1,b
"""


def test_unnamed_columns_get_types_in_the_pass_that_stores_them(spark, tmp_path):
    (tmp_path / "products.csv").write_text(PRODUCTS)
    files = RawFiles(spark, str(tmp_path))
    table, refused, counted = files.load("products")
    assert counted == 2
    kinds = dict(table.dtypes)
    assert (kinds["product_weight_g"], kinds["product_ratio"], kinds["product_note"]) == ("int", "double", "string")
    assert kinds["product_id"] == "string" and refused.count() == 0
    assert [r["product_weight_g"] for r in table.orderBy("product_id").collect()] == [250, 300]
    # What is read later is the stored copy, not the text.
    assert "csv" not in plan(table).lower().replace(str(tmp_path).lower(), "")


def test_the_text_is_read_once(spark, tmp_path):
    (tmp_path / "products.csv").write_text(PRODUCTS)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("load", "load")
    try:
        found = column_types.TypesOnTheWay(
            read_text(spark, str(tmp_path / "products.csv")), ["product_weight_g"], F.col(MALFORMED).isNull()
        )
        before = len(tracker.getJobIdsForGroup("load"))
        found.rows.write.parquet(str(tmp_path / "copy"))
        assert found.types() == {"product_weight_g": "int"}
        assert len(tracker.getJobIdsForGroup("load")) - before == 1
    finally:
        spark.sparkContext._jsc.clearJobGroup()


ITEMS = """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value,gift
o1,1,p1,s1,2018-01-01 00:00:00,10.5,1,1
o1,2,p1,s1,2018-01-01 00:00:00
o2,1,p2,Sao Paulo, SP,s2,2018-01-01 00:00:00,99,1,2
o3,1,p2,"Sao Paulo, SP",2018-01-01 00:00:00,99,1,3
o4,1,p2,s2,2018-01-01 00:00:00,20,1,x,y
o5,1,p2,s2,never,free,1,4
"""


def test_rows_of_wrong_length_are_set_apart(spark, tmp_path):
    (tmp_path / "order_items.csv").write_text(ITEMS)
    table, refused, counted = RawFiles(spark, str(tmp_path)).load("order_items")
    assert unordered(table.select("order_id", "seller_id", "price", "gift")) == [
        ("o1", "s1", 10.5, 1), ("o3", "Sao Paulo, SP", 99.0, 3), ("o5", "s2", None, 4),
    ]
    lines = ITEMS.splitlines()
    assert unordered(refused) == sorted([("order_items", lines[k]) for k in (2, 3, 5)])
    assert counted == table.count() and counted + refused.count() == 6
    report = quality.quarantined_rows(refused)
    assert rows(report) == [("order_items", 3, lines[2])]
    # A shifted field decides no type: only the three good rows were tallied.
    assert dict(table.dtypes)["gift"] == "int"
    texts = {k: v for r in table.collect() for k, v in r["unparsed_text"].items()}
    assert texts == {"price": "free", "shipping_limit_date": "never"}


def test_reading_raises_or_keeps_the_row(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n1,2,3\n1,2,3,4,5\n1\n")
    with pytest.raises(Exception, match="1,2,3,4,5"):
        read_csv(spark, str(path)).collect()
    # Also where only one column is asked for, and where rows are only counted.
    with pytest.raises(Exception, match="number of fields"):
        read_csv(spark, str(path)).select("a").collect()
    with pytest.raises(Exception, match="number of fields"):
        read_csv(spark, str(path)).count()
    kept = read_csv(spark, str(path), {"a": "int"}, malformed="bad", infer=True)
    assert rows(kept) == [(1, 2, 3, None), (None, None, None, "1,2,3,4,5"), (None, None, None, "1")]


def test_multiline_rows_of_wrong_length(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"two\nlines"\n2,x,"y\nz"\n3,ok\n')
    kept = read_csv(spark, str(path), multiline=True, malformed="bad")
    assert unordered(kept.where("bad IS NULL")) == [("1", "two\nlines", None), ("3", "ok", None)]
    assert [r["bad"] for r in kept.where("bad IS NOT NULL").collect()] == ['2,x,"y\nz"']


REVIEWS = """review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,4.7,,,2018-01-01 00:00:00,yesterday
r2,o1,3.0,,,2018-01-01 00:00:00,2018-01-02 00:00:00
r3,o1,five,123,,,
"""


def test_times_and_scores_that_do_not_parse_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(REVIEWS)
    table, _, _ = RawFiles(spark, str(tmp_path)).load("reviews")
    assert [r["review_score"] for r in table.orderBy("review_id").collect()] == [None, 3, None]
    assert unordered(quality.unparsed_values({"reviews": table})) == [
        ("reviews", "review_answer_timestamp", 1), ("reviews", "review_score", 2),
    ]
    assert table.where("review_id = 'r2'").first()["review_answer_timestamp"] == dt.datetime(2018, 1, 2)
    # Known text stays text, whatever it holds.
    assert dict(table.dtypes)["review_comment_title"] == "string"


def test_large_whole_numbers_keep_their_digits(spark, tmp_path):
    (tmp_path / "n.csv").write_text("n\n123456789012345678901234567890\n1\n")
    got = read_csv(spark, str(tmp_path / "n.csv"), infer=True)
    assert unordered(got) == [(Decimal(1),), (Decimal("123456789012345678901234567890"),)]


def test_empty_files_and_tables(spark, tmp_path):
    (tmp_path / "e.csv").write_text("a,b\n")
    got = read_csv(spark, str(tmp_path / "e.csv"), infer=True)
    assert got.count() == 0 and got.columns == ["a", "b"]
