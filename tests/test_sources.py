"""CSV and Parquet in and out."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starloom.plans import cleaning, quality
from starloom.sources.raw import RawFiles, read_csv, write_csv
from starloom.sources.scratch import scratch_path, stage
from starloom.sources.warehouse import Warehouse, write_table
from tests.conftest import plan, rows, unordered

REVIEWS = '''review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,,"line one
line two, with ""quotes""",2018-01-01 00:00:00,2018-01-02 10:11:12
r2,o2,five,"a, b",,2018-01-01 00:00:00,
'''


def test_multiline_quotes_and_malformed_scores(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(REVIEWS)
    raw = RawFiles(spark, str(tmp_path)).read("reviews")
    assert raw.count() == 2
    got = rows(
        cleaning.clean_reviews(raw).select("review_id", "review_score", "review_comment_message", "has_comment")
    )
    assert got == [
        ("r1", 5, 'line one\nline two, with "quotes"', True),
        ("r2", None, "", False),
    ]


def test_types_follow_names_and_further_columns_pass_through(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "extra,customer_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "e1,id1,01409,x,SP\n,id2,bad,y,RJ\n"
    )
    raw = RawFiles(spark, str(tmp_path), names={"customers": "c.csv"}).read("customers")
    assert raw.schema.simpleString() == (
        "struct<extra:string,customer_id:string,customer_zip_code_prefix:int,"
        "customer_city:string,customer_state:string,unparsed_text:map<string,string>>"
    )
    assert rows(raw.select("unparsed_text")) == [({},), ({"customer_zip_code_prefix": "bad"},)]
    counts = quality.unparsed_values({"customers": raw})
    assert rows(counts) == [("customers", "customer_zip_code_prefix", 1)]
    assert rows(raw.select("extra", "customer_zip_code_prefix")) == [("e1", 1409), (None, None)]


def test_column_types_can_be_added(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,product_weight_g\np,3\n")
    files = RawFiles(spark, str(tmp_path), column_types={"products": {"product_weight_g": "int"}})
    assert rows(files.read("products").drop("unparsed_text")) == [("p", 3)]


def test_optional_table(spark, tmp_path):
    files = RawFiles(spark, str(tmp_path))
    assert files.read_optional("category_translation") is None
    with pytest.raises(AnalysisException):
        files.read("orders")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, " padded ", 0.1), (2, 'quo"te', None), (3, "new\nline,comma", -1e300), (4, None, 1.0)],
        "id int, text string, x double",
    )
    path = str(tmp_path / "t")
    write_csv(df.repartition(2), path)
    back = read_csv(spark, path, {"id": "int", "x": "double"}, multiline=True)
    assert back.schema == df.schema
    assert unordered(back) == unordered(df)


def test_partitioned_write_prunes_and_keeps_rows_without_a_month(spark, tmp_path):
    df = spark.range(400).select(
        F.when(F.col("id") % 50 != 0, (2016 + F.col("id") % 3).cast("int")).alias("order_year"),
        F.when(F.col("id") % 50 != 0, (1 + F.col("id") % 12).cast("int")).alias("order_month"),
        "id",
    )
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.write("fact_orders", df)
    warehouse.write("fact_orders", df)  # replaces
    back = warehouse.read("fact_orders")
    assert dict(back.dtypes)["order_year"] == "int"
    assert unordered(back.select(df.columns)) == unordered(df)
    assert back.where("order_year IS NULL").count() == 8
    # One file per month: rows were brought together before writing.
    assert len(back.inputFiles()) == 13
    text = plan(back.where(F.col("order_year").between(2016, 2017)))
    assert "order_year#" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_scratch_goes_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared + "/starloom-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert rows(stage(spark.range(3), "three").orderBy("id")) == [(0,), (1,), (2,)]


def test_plain_table(spark, tmp_path):
    write_table(spark.range(5), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_files_with_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "items"
    folder.mkdir()
    (folder / "a.csv").write_text("order_id,price\no1,1.0\n")
    (folder / "b.csv").write_text("price,order_id\n2.0,o2\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(folder), {"price": "double"}).collect()
