"""Versions of the warehouse, months of the fact, and audits taken while writing."""

import json

import pytest
from pyspark.sql import functions as F

from checks.standin import RawTables
from starloom import build
from starloom.build import build_warehouse, check_warehouse, update_months
from starloom.plans import quality
from starloom.plans.star import Star
from starloom.sources.raw import Loaded
from starloom.sources.warehouse import TABLES, Warehouse
from tests.conftest import DATA, plan, rows, unordered


def fact(spark, n, months=12, mark="a"):
    return spark.range(n).select(
        F.when(F.col("id") % 50 != 0, F.lit(2016)).alias("order_year"),
        F.when(F.col("id") % 50 != 0, (1 + F.col("id") % months).cast("int")).alias("order_month"),
        "id",
        F.lit(mark).alias("mark"),
    )


def files_by_month(df):
    out = {}
    for name in df.inputFiles():
        out.setdefault("/".join(name.split("/")[-3:-1]), set()).add(name)
    return out


def test_a_build_that_dies_leaves_the_old_tables(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    with warehouse.replacing():
        warehouse.write("dim_sellers", spark.range(3))
        warehouse.write("fact_orders", fact(spark, 100))
    before = unordered(warehouse.read("fact_orders"))
    broken = fact(spark, 100, mark="b").withColumn("id", F.raise_error(F.lit("dies here")).cast("long"))
    with pytest.raises(Exception, match="dies here"):
        with warehouse.replacing():
            warehouse.write("dim_sellers", spark.range(9))
            # The build itself sees what it has just written, readers do not.
            assert warehouse.read("dim_sellers").count() == 9
            assert Warehouse(spark, warehouse.root).read("dim_sellers").count() == 3
            warehouse.write("fact_orders", broken)
    again = Warehouse(spark, warehouse.root)
    assert again.read("dim_sellers").count() == 3 and unordered(again.read("fact_orders")) == before
    assert [p.name for p in (tmp_path / "w" / "dim_sellers").iterdir()] == ["version=1"]
    assert not [p for p in (tmp_path / "w").iterdir() if p.name.startswith(".CURRENT") and p.suffix != ".crc"]
    warehouse.write("dim_sellers", spark.range(4))
    assert again.read("dim_sellers").count() == 4


def test_a_whole_build_that_dies_is_not_seen(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    raw = RawTables(spark, DATA)
    build_warehouse(raw, warehouse)
    state, customers = warehouse.published(), warehouse.read("dim_customers").count()
    monkeypatch.setattr(build.Star, "fact_orders", property(lambda self: 1 / 0))
    with pytest.raises(ZeroDivisionError):
        build_warehouse(raw, warehouse)
    assert warehouse.published() == state
    assert warehouse.read("dim_customers").count() == customers
    assert warehouse.read("fact_orders").count() == raw["order_items"].count()


def test_late_months_replace_only_themselves(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.write("fact_orders", fact(spark, 600))
    before = files_by_month(warehouse.read("fact_orders"))
    old = warehouse.read("fact_orders")
    late = fact(spark, 600, mark="late").where("order_month IN (3, 7) OR order_month IS NULL")
    warehouse.write_months(late)
    got = warehouse.read("fact_orders")
    null = "order_year=__HIVE_DEFAULT_PARTITION__/order_month=__HIVE_DEFAULT_PARTITION__"
    replaced = {"order_year=2016/order_month=3", "order_year=2016/order_month=7", null}
    after = files_by_month(got)
    assert after.keys() == before.keys()
    assert {m for m in before if before[m] != after[m]} == replaced
    want = fact(spark, 600).withColumn(
        "mark", F.when(F.coalesce(F.col("order_month"), F.lit(3)).isin(3, 7), "late").otherwise("a")
    )
    assert unordered(got.select(want.columns)) == unordered(want)
    # What was read before still is what it was.
    assert {r["mark"] for r in old.select("mark").collect()} == {"a"}
    # A month that the fact did not have, and one written twice.
    warehouse.write_months(fact(spark, 600, 13, "new").where("order_month = 13"))
    warehouse.write_months(fact(spark, 30, mark="x").where("order_month = 3"))
    months = {r["order_month"]: r["m"] for r in
              warehouse.read("fact_orders").groupBy("order_month").agg(F.max("mark").alias("m")).collect()}
    assert (months[13], months[3], months[7], months[1]) == ("new", "x", "late", "a")
    with pytest.raises(ValueError):
        warehouse.write_months(fact(spark, 10).drop("mark"))


def test_months_of_several_versions_are_pruned(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.write("fact_orders", fact(spark, 600))
    warehouse.write_months(fact(spark, 600).where("order_month = 5"))
    asked = warehouse.read("fact_orders").where("order_month = 5")
    assert plan(asked).count("FileScan") == 1
    assert "version#" in plan(asked).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert asked.count() == fact(spark, 600).where("order_month = 5").count()
    warehouse.write("fact_orders", fact(spark, 600))
    assert warehouse.drop_unused() == ["fact_orders/version=1", "fact_orders/version=2"]
    assert warehouse.read("fact_orders").count() == 600


def test_update_months_equals_a_whole_build(spark, tmp_path):
    raw = RawTables(spark, DATA)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    with warehouse.replacing():
        warehouse.write("fact_orders", Star(raw).fact_orders.withColumn("price", F.lit(0.0)))
    update_months(raw, warehouse, [(1997, 3), (1998, 11)])
    in_months = "(order_year, order_month) IN ((1997, 3), (1998, 11))"
    want = Star(raw).fact_orders.where(in_months)
    got = warehouse.read("fact_orders").where(in_months).select(want.columns)
    assert unordered(got) == unordered(want) and got.count()
    rest = warehouse.read("fact_orders").where(f"NOT coalesce({in_months}, false)")
    assert rest.agg(F.max("price")).first()[0] == 0.0


def test_audit_from_the_writes_equals_that_of_the_tables(spark, tmp_path):
    raw = Loaded()
    raw.update({name: df for name, df in RawTables(spark, DATA).items()})
    raw.rows = {name: df.count() for name, df in raw.items()}
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    watched = build_warehouse(raw, warehouse)
    keys, counts = check_warehouse(raw, warehouse)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("audit", "audit")
    try:
        mine = unordered(watched.audit()), unordered(watched.row_counts(raw.rows))
        assert not tracker.getJobIdsForGroup("audit")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert mine == (unordered(keys), unordered(counts))
    assert {r[0] for r in mine[0]} == set(TABLES)


def test_pointer_is_one_small_file(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    assert warehouse.published() == {"number": 0, "tables": {}, "months": {}}
    warehouse.write("dim_date", spark.range(1))
    state = json.loads((tmp_path / "w" / "CURRENT").read_text())
    assert state == {"number": 1, "tables": {"dim_date": 1}, "months": {}}
    with warehouse.replacing(), pytest.raises(ValueError):
        with warehouse.replacing():
            pass
    assert rows(warehouse.read("dim_date")) == [(0,)]


@pytest.mark.parametrize(
    "table, key", [("sellers", "seller_id"), ("products", "product_id"), ("category_translation", None)]
)
def test_repeated_keys_of_lookups_raise_and_leave_the_old_tables(spark, tmp_path, table, key):
    raw = dict(RawTables(spark, DATA).items())
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.write("dim_sellers", spark.range(2))
    raw[table] = raw[table].union(raw[table].limit(1))
    with pytest.raises(ValueError, match="unique"):
        build_warehouse(raw, warehouse)
    assert warehouse.published()["tables"] == {"dim_sellers": 1}


def test_orphans_are_counted_and_named(spark, tmp_path):
    used = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, None)], "k int, s string")
    tables = {"t": used, "known": spark.createDataFrame([(1,), (1,), (None,)], "k int")}
    got = rows(quality.orphans(tables, [("t", "k", "known")]))
    assert got == [("t.k", "known", 2, 2)]
    empty = {"t": used.limit(0), "known": tables["known"]}
    assert rows(quality.orphans(empty, [("t", "k", "known")])) == [("t.k", "known", 0, 0)]
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    raw = dict(RawTables(spark, DATA).items())
    raw["sellers"] = raw["sellers"].where("seller_id <> 1")
    build_warehouse(raw, warehouse)
    assert any(line.startswith("fact_orders.seller_id: 1 keys") for line in build.orphan_notes(warehouse))
