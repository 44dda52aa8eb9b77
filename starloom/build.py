"""Build the warehouse from raw CSV files, audit it, and run the named queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.dedup import require_unique
from starloom.plans import business, panels, quality
from starloom.plans.star import Star
from starloom.sources.raw import COLUMN_TYPES, Loaded, RawFiles
from starloom.sources.warehouse import FACT_PARTITIONS, TABLES, VIEW_TABLES, Warehouse


def load_raw(raw: RawFiles, columnar: bool = True) -> Mapping[str, DataFrame]:
    """Read all raw tables; the translation may be missing.

    Most tables are read more than once, for caps, joins and checks.  They are first
    turned into Parquet, so that the text is parsed once and later passes read only the
    columns they need; rows with another number of fields than their header are set apart
    (``quarantine``).  ``columnar=False`` reads the text each time instead, and raises at
    such a row.
    """
    if columnar:
        return raw.load_all()
    tables = Loaded()
    for name in COLUMN_TYPES:
        df = raw.read_optional(name) if name == "category_translation" else raw.read(name)
        if df is not None:
            tables[name] = df
    return tables


def build_warehouse(
    raw: Mapping[str, DataFrame], warehouse: Warehouse, **options
) -> quality.WatchedWrites:
    """Write all tables of the star schema; ``options`` are those of ``Star``.

    Readers see all the new tables at the end, or, if anything fails, the old ones: also if
    a category is translated twice, or a product or seller is there twice, as joins with
    them would multiply rows.  Raw rows that entered no table are written too, as the table
    ``quarantine``.  Returns the counts taken on the way, for an audit that reads nothing
    again.
    """
    if raw.get("category_translation") is not None:
        require_unique(raw["category_translation"], ["product_category_name"], "category_translation")
    star, watched = Star(raw, balanced=True, **options), quality.WatchedWrites(warehouse.spark)
    quarantine = getattr(raw, "quarantine", None)
    with warehouse.replacing():
        if quarantine is not None:
            warehouse.write("quarantine", quarantine)
        for table in TABLES:
            if table != "fact_orders":
                warehouse.write(table, getattr(star, table), watched.watch(table))
        for table, key in quality.UNIQUE_KEYS.items():
            require_unique(warehouse.read(table), [key], table)
        # The fact takes products, payments and reviews from the tables just written.
        star.dim_products = warehouse.read("dim_products")
        star.dim_payments = warehouse.read("dim_payments")
        star.dim_reviews = warehouse.read("dim_reviews")
        warehouse.write("fact_orders", star.fact_orders, watched.watch("fact_orders"), balanced=True)
    return watched


def update_months(
    raw: Mapping[str, DataFrame], warehouse: Warehouse, months: Sequence[tuple[int, int]]
) -> None:
    """Write the fact again for the given (year, month) pairs of purchase, and only those.

    ``raw`` has to hold all rows: caps and medians are those of the whole tables.  Months
    without an order any more keep what they have.
    """
    fact = Star(raw).fact_orders
    year, month = (F.col(c) for c in FACT_PARTITIONS)
    wanted = [(year == y) & (month == m) for y, m in months]
    warehouse.write_months(fact.where(reduce(Column.__or__, wanted, F.lit(False))))


def check_warehouse(
    raw: Mapping[str, DataFrame], warehouse: Warehouse
) -> tuple[DataFrame, DataFrame]:
    """Two reports: NULL keys of every table, and row counts against the raw tables."""
    keys = quality.audit({table: warehouse.read(table) for table in TABLES})
    counts = quality.compare_row_counts(
        {
            table: (raw[source], warehouse.read(table))
            for table, source in quality.ROW_SOURCES.items()
        }
    )
    return keys, counts


Query = Callable[[Warehouse], DataFrame]

# The named query set.  Nothing is caught: a query that fails, fails.
QUERIES: dict[str, Query] = {
    "monthly_revenue": lambda w: business.monthly_revenue(w.read("fact_orders")),
    "category_revenue": lambda w: business.category_revenue(
        w.read("fact_orders"), w.read("dim_products")
    ),
    "seller_performance": lambda w: business.seller_performance(
        w.read("fact_orders"), w.read("dim_sellers")
    ),
    "delivery_by_state": lambda w: business.delivery_by_state(
        w.read("fact_orders"), w.read("dim_sellers")
    ),
    "payment_analysis": lambda w: business.payment_analysis(w.read("dim_payments")),
}

# Other readings of the same questions, by name.
VARIANTS: dict[str, Query] = {
    "monthly_revenue_without_gaps": lambda w: business.monthly_revenue_without_gaps(
        w.read("fact_orders")
    ),
    "late_orders_by_state": lambda w: business.late_orders_by_state(
        w.read("fact_orders"), w.read("dim_sellers")
    ),
    "payment_share_of_orders": lambda w: panels.payment_share_of_orders(
        w.read("dim_payments")
    ),
    "top_states_of_all": lambda w: panels.top_states_of_all(
        w.read("fact_orders"), w.read("dim_sellers")
    ),
}


def run_queries(warehouse: Warehouse, variants: bool = False) -> dict[str, DataFrame]:
    chosen = QUERIES | VARIANTS if variants else QUERIES
    return {name: query(warehouse) for name, query in chosen.items()}


def preview(df: DataFrame, rows: int = 5) -> str:
    """The first rows as text."""
    return df.limit(rows).toPandas().to_string(index=False)


def to_client(df: DataFrame, max_rows: int = 100_000):
    """Bring a result to pandas; refuse one that is larger than expected."""
    frame = df.limit(max_rows + 1).toPandas()
    if len(frame) > max_rows:
        raise ValueError(f"more than {max_rows} rows; aggregate or limit first")
    return frame


def notes(raw: Mapping[str, DataFrame]) -> list[str]:
    """What the fact cannot show: orders without items, rows that were refused for their
    number of fields, and texts that did not parse."""
    lost = quality.orders_without_items(raw["orders"], raw["order_items"]).count()
    found = [f"orders without items: {lost}"]
    quarantine = getattr(raw, "quarantine", None)
    if quarantine is not None:
        # A row for each raw table at most.
        found += [
            f"{r['table_name']}: {r['quarantined']} rows set apart, as {r['example'][:200]!r}"
            for r in quality.quarantined_rows(quarantine).orderBy("table_name").collect()
        ]
    unparsed = quality.unparsed_values(raw)
    if unparsed is not None:
        # A row for each column of the raw tables at most.
        found += [
            f"{r['table_name']}.{r['column_name']}: {r['unparsed']} texts did not parse"
            for r in unparsed.orderBy("table_name", "column_name").collect()
        ]
    return found


def orphan_notes(warehouse: Warehouse) -> list[str]:
    """References of the warehouse's tables to keys that are not there."""
    tables = {name: warehouse.read(name) for name in TABLES}
    # A row per reference.
    return [
        f"{r['reference']}: {r['orphan_keys']} keys of {r['orphan_rows']} rows are not in {r['refers_to']}"
        for r in quality.orphans(tables).collect()
        if r["orphan_keys"]
    ]


def main(
    raw_root: str,
    warehouse_root: str,
    names: Mapping[str, str] | None = None,
    strict: bool = True,
    **options,
) -> None:
    """Build, check and query; ``options`` are those of ``Star``.

    With ``strict``, a failed check ends the run before any query; without, it is
    reported and the queries are answered all the same.
    """
    spark = SparkSession.builder.appName("starloom").getOrCreate()
    raw, warehouse = load_raw(RawFiles(spark, raw_root, names)), Warehouse(spark, warehouse_root)
    watched = build_warehouse(raw, warehouse, **options)
    warehouse.drop_unused()
    # A row for each table, counted while it was written.
    reports = watched.audit(), watched.row_counts(raw.rows)
    checked = [row for report in reports for row in report.collect()]
    for line in [*map(str, checked), *notes(raw), *orphan_notes(warehouse)]:
        print(line)
    failed = quality.failed_tables(checked)
    if failed and strict:
        raise quality.QualityError(f"failed checks: {', '.join(failed)}")
    warehouse.register_views(VIEW_TABLES)
    business.revenue_by_month_and_payment(warehouse.read("fact_orders")).explain("formatted")
    for name, df in run_queries(warehouse).items():
        print(f"--- {name}\n{preview(df)}")
