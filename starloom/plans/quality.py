"""Checks of finished tables.  Each table is read once, for all of its counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from starloom.functions.columns import UNPARSED
from starloom.sources.raw import MALFORMED

# The raw table whose rows a warehouse table must all hold.
ROW_SOURCES: dict[str, str] = {
    "fact_orders": "order_items",
    "dim_customers": "customers",
    "dim_products": "products",
    "dim_sellers": "sellers",
    "dim_payments": "payments",
    "dim_reviews": "reviews",
}

# The columns of each table that must not be NULL.
KEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "fact_orders": ("order_id", "product_id", "seller_id", "customer_id"),
    "dim_customers": ("customer_id",),
    "dim_products": ("product_id",),
    "dim_sellers": ("seller_id",),
    "dim_date": ("date_key",),
    "dim_payments": ("order_id",),
    "dim_reviews": ("review_id",),
    "dim_geolocation": ("geolocation_zip_code_prefix",),
}


# What must be unique in a table, and the keys that refer to other tables.
UNIQUE_KEYS: dict[str, str] = {
    "dim_products": "product_id",
    "dim_sellers": "seller_id",
}
REFERENCES: tuple[tuple[str, str, str], ...] = (
    ("fact_orders", "product_id", "dim_products"),
    ("fact_orders", "seller_id", "dim_sellers"),
    ("fact_orders", "customer_id", "dim_customers"),
    ("dim_payments", "order_id", "fact_orders"),
    ("dim_reviews", "order_id", "fact_orders"),
)


class QualityError(ValueError):
    """A table does not hold what it must."""


def _counts(keys: Sequence[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys],
    ]


def _report(counts: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    nulls = {k: F.col(f"null_{k}") for k in keys}
    detail = [
        F.when(n > 0, F.concat(F.lit(f"{k}="), n.cast("string"))) for k, n in nulls.items()
    ]
    total = reduce(lambda a, b: a + b, nulls.values())
    return counts.select(
        F.lit(name).alias("table_name"),
        "row_count",
        total.alias("null_keys"),
        F.concat_ws(", ", *detail).alias("null_detail"),
        F.when(total > 0, "FAIL").otherwise("PASS").alias("status"),
    )


def audit_table(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """One row: table, rows, NULLs in its key columns, which ones, PASS or FAIL."""
    return _report(df.agg(*_counts(keys)), name, keys)


class WatchedWrites:
    """Counts of tables taken while they are written, so that an audit reads nothing again.

    ``watch(name)`` goes to the write of a table; once that is done, ``audit`` tells what
    ``quality.audit`` would find in it, and ``row_counts`` what ``compare_row_counts`` would.
    """

    def __init__(self, spark: SparkSession, keys: Mapping[str, Sequence[str]] = KEY_COLUMNS):
        self.spark, self.keys = spark, keys
        self.seen: dict[str, Observation] = {}

    def watch(self, name: str) -> tuple[Observation, list[Column]] | None:
        """None for a table that has no keys to audit."""
        if name not in self.keys:
            return None
        self.seen[name] = Observation(f"rows of {name}")
        return self.seen[name], _counts(self.keys[name])

    def audit(self) -> DataFrame:
        rows = []
        for name, seen in self.seen.items():
            counts = seen.get
            nulls = {k: counts[f"null_{k}"] for k in self.keys[name]}
            detail = ", ".join(f"{k}={n}" for k, n in nulls.items() if n)
            total = sum(nulls.values())
            rows.append((name, counts["row_count"], total, detail, "FAIL" if total else "PASS"))
        return self._table(rows, table_name=str, row_count=int, null_keys=int, null_detail=str, status=str)

    def row_counts(self, raw_rows: Mapping[str, int]) -> DataFrame:
        """Raw and stored rows of the watched tables whose raw table's rows are known."""
        rows = [
            (name, raw_rows[source], self.seen[name].get["row_count"])
            for name, source in ROW_SOURCES.items()
            if name in self.seen and source in raw_rows
        ]
        rows = [(*row, "PASS" if row[1] == row[2] else "FAIL") for row in rows]
        return self._table(rows, table_name=str, raw_rows=int, row_count=int, status=str)

    def _table(self, rows: list[tuple], **columns: type) -> DataFrame:
        """Literal rows; collecting them runs no job."""
        kinds = [pa.string() if kind is str else pa.int64() for kind in columns.values()]
        values = list(zip(*rows)) or [()] * len(columns)
        arrays = [pa.array(v, k) for v, k in zip(values, kinds)]
        return self.spark.createDataFrame(pa.table(dict(zip(columns, arrays))))


def audit(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = KEY_COLUMNS
) -> DataFrame:
    """Audit every given table; one row each."""
    return reduce(
        DataFrame.unionByName,
        [audit_table(df, name, keys[name]) for name, df in tables.items()],
    )


def require(
    df: DataFrame, name: str, keys: Sequence[str], expected_rows: int | None = None
) -> None:
    """Raise if a key column holds NULL or the number of rows is not the expected one."""
    found = audit_table(df, name, keys).first()
    if found["null_keys"]:
        raise QualityError(f"{name}: NULL keys: {found['null_detail']}")
    if expected_rows is not None and found["row_count"] != expected_rows:
        raise QualityError(f"{name}: {found['row_count']} rows, expected {expected_rows}")


def compare_row_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Raw and stored rows of tables that must keep every row, and PASS or FAIL."""

    def count(name: str, df: DataFrame, into: str) -> DataFrame:
        counted = df.agg(F.count(F.lit(1)).alias("n"))
        return counted.select(
            F.lit(name).alias("table_name"),
            *[
                (F.col("n") if column == into else F.lit(0).cast("bigint")).alias(column)
                for column in ("raw_rows", "row_count")
            ],
        )

    counts = [
        count(name, df, into)
        for name, pair in pairs.items()
        for df, into in zip(pair, ("raw_rows", "row_count"))
    ]
    return (
        reduce(DataFrame.unionByName, counts)
        .groupBy("table_name")
        .agg(F.sum("raw_rows").alias("raw_rows"), F.sum("row_count").alias("row_count"))
        .withColumn(
            "status", F.when(F.col("raw_rows") == F.col("row_count"), "PASS").otherwise("FAIL")
        )
    )


def unparsed_values(raw: Mapping[str, DataFrame]) -> DataFrame | None:
    """Texts that did not parse, counted by raw table and column; None without such tables."""
    counted = [
        df.select(F.explode(F.map_keys(UNPARSED)).alias("column_name"))
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("unparsed"))
        .select(F.lit(name).alias("table_name"), "column_name", "unparsed")
        for name, df in raw.items()
        if UNPARSED in df.columns
    ]
    return reduce(DataFrame.unionByName, counted) if counted else None


def quarantined_rows(quarantine: DataFrame) -> DataFrame:
    """How many rows of each raw table were refused, and one of them as an example.

    A row for each table that has any; the example is the least in the order of text.
    """
    return quarantine.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("quarantined"), F.min(MALFORMED).alias("example")
    )


def orphans(
    tables: Mapping[str, DataFrame],
    references: Sequence[tuple[str, str, str]] = REFERENCES,
) -> DataFrame:
    """One row per reference: keys that the other table lacks, and the rows that have them.

    Both sides are reduced to a row per key before they meet, so a key with a third of the
    rows costs one row per task.  NULL keys refer to nothing.
    """

    def lacking(name: str, key: str, other: str) -> DataFrame:
        used = tables[name].where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        known = tables[other].select(key).distinct()
        return used.join(known, key, "left_anti").agg(
            F.lit(f"{name}.{key}").alias("reference"),
            F.lit(other).alias("refers_to"),
            F.count("*").alias("orphan_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        )

    return reduce(DataFrame.unionByName, [lacking(*reference) for reference in references])


def failed_tables(rows: Sequence[Row]) -> list[str]:
    """The tables of collected report rows that did not pass."""
    return [r["table_name"] for r in rows if r["status"] != "PASS"]


def require_all_pass(*reports: DataFrame) -> None:
    """Raise if a report has a row that did not pass."""
    failed = failed_tables([row for report in reports for row in report.collect()])
    if failed:
        raise QualityError(f"failed checks: {', '.join(failed)}")


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders that the fact does not show because they have no item."""
    # distinct() collapses an order's items before the shuffle, however many they are.
    return orders.join(items.select("order_id").distinct(), "order_id", "left_anti")
