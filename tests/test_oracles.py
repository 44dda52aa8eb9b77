"""Every registered query against its DuckDB text, and the contract around them."""

import re

import pytest

import __spark_entry__ as contract
from checks.compare import difference, oracle
from checks.oracles import ORACLES
from checks.registry import QUERIES
from tests.conftest import DATA

SURVEY_KEYS = """
src_csv_header src_csv_multiline src_parquet_partitioned dim_products_no_translation
views_smoke fact_orders dim_date dim_products order_items_clean fact_sellers_broadcast
q2_category_revenue payments_per_order reviews_per_order dim_geolocation
month_paytype_revenue null_audit impute_group_median winsorize_p99 dedup_by_key
q1_monthly_revenue q3_seller_performance orders_clean time_of_day invalid_to_null
clamp_floor winsorize_payments item_totals dim_customers dim_sellers impute_flag
reviews_clean q4_delivery_by_state q5_payment_analysis viz_mom_sign viz_top15_category
viz_minmax_state viz_delay_scatter viz_payment_share viz_installment_curve
viz_state_top10 viz_sparkline
""".split()


@pytest.fixture(scope="module")
def duck():
    return oracle(DATA)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, duck, name):
    table = contract.queries()[name](spark, DATA).toArrow()
    assert table.num_rows > 0
    expected = duck.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert difference(table, expected) == ""


def test_every_operator_of_the_survey_is_registered():
    assert len(SURVEY_KEYS) == 41
    assert set(SURVEY_KEYS) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 36


def test_oracles_read_whole_tables():
    for name, sql in contract.oracle_sql().items():
        assert not re.search(r"TABLESAMPLE|USING SAMPLE", sql, re.I), name
