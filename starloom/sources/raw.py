"""Raw CSV tables: typed by column name, and by what they hold where no type is named."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom.functions.columns import UNPARSED, whole_number
from starloom.sources.column_types import TypesOnTheWay, infer_types
from starloom.sources.scratch import stage

# A whole number that may be written with a fraction of zero, as review scores are.
WHOLE_NUMBER = "whole number"

# The columns of each raw table whose types are known.  Columns not named
# here get the narrowest type that all of their texts fit.
_TIME, _TEXT = "timestamp_ntz", "string"
COLUMN_TYPES: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": _TEXT,
        "customer_id": _TEXT,
        "order_status": _TEXT,
        "order_purchase_timestamp": _TIME,
        "order_approved_at": _TIME,
        "order_delivered_carrier_date": _TIME,
        "order_delivered_customer_date": _TIME,
        "order_estimated_delivery_date": _TIME,
    },
    "order_items": {
        "order_id": _TEXT,
        "order_item_id": "int",
        "product_id": _TEXT,
        "seller_id": _TEXT,
        "shipping_limit_date": _TIME,
        "price": "double",
        "freight_value": "double",
    },
    "customers": {
        "customer_id": _TEXT,
        "customer_unique_id": _TEXT,
        "customer_zip_code_prefix": "int",
        "customer_city": _TEXT,
        "customer_state": _TEXT,
    },
    "products": {
        "product_id": _TEXT,
        "product_category_name": _TEXT,
        "product_name_lenght": "double",
        "product_description_lenght": "int",
        "product_photos_qty": "double",
    },
    "category_translation": {
        "product_category_name": _TEXT,
        "product_category_name_english": _TEXT,
    },
    "sellers": {
        "seller_id": _TEXT,
        "seller_zip_code_prefix": "int",
        "seller_city": _TEXT,
        "seller_state": _TEXT,
    },
    "payments": {
        "order_id": _TEXT,
        "payment_sequential": "int",
        "payment_type": _TEXT,
        "payment_installments": "int",
        "payment_value": "double",
    },
    "reviews": {
        "review_id": _TEXT,
        "order_id": _TEXT,
        "review_score": WHOLE_NUMBER,
        "review_comment_title": _TEXT,
        "review_comment_message": _TEXT,
        "review_creation_date": _TIME,
        "review_answer_timestamp": _TIME,
    },
    "geolocation": {
        "geolocation_zip_code_prefix": "int",
        "geolocation_lat": "double",
        "geolocation_lng": "double",
        "geolocation_city": _TEXT,
        "geolocation_state": _TEXT,
    },
}

# Review comments hold line breaks and quotes inside quoted fields.
MULTILINE_TABLES = frozenset({"reviews"})


# The column that holds the text of a row whose number of fields is not the header's.
MALFORMED = "malformed_row"


def read_text(
    spark: SparkSession, path: str, multiline: bool = False, malformed: str = MALFORMED
) -> DataFrame:
    """CSV files with a header row, every field as text.

    A row with more or fewer fields than the header stands whole in the column
    ``malformed``, which is NULL for any other row; its fields are cut or shifted and should
    not be used.  Every file's header is compared with the first one's, and reading raises
    where it differs.  A multiline file is read by one task, so large inputs should come as
    many files.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    # A row's fields can only be counted where all of them are parsed.
    reader = reader.option("enforceSchema", False).option("columnPruning", False)
    if multiline:
        reader = reader.option("multiLine", True)
    names = reader.csv(path).schema.fields
    schema = StructType([*names, StructField(malformed, StringType())])
    return reader.option("columnNameOfCorruptRecord", malformed).schema(schema).csv(path)


def _parsed(name: str, kind: str) -> Column:
    return whole_number(f"`{name}`") if kind == WHOLE_NUMBER else F.col(f"`{name}`").try_cast(kind)


def typed(text: DataFrame, types: Mapping[str, str], unparsed: str | None = None) -> DataFrame:
    """Parse columns of text; what is no such value gives NULL.

    ``unparsed`` names a column to keep those texts in, as a map from column to text.
    """
    wanted = {c: t for c, t in types.items() if c in text.columns and t != _TEXT}
    parsed = {c: _parsed(c, t) for c, t in wanted.items()}
    if unparsed and wanted:
        texts = [
            (F.lit(c), F.when(value.isNull() & (F.trim(F.col(f"`{c}`")) != ""), F.col(f"`{c}`")))
            for c, value in parsed.items()
        ]
        every = F.create_map(*[x for pair in texts for x in pair])
        parsed[unparsed] = F.map_filter(every, lambda _, kept: kept.isNotNull())
    return text.withColumns(parsed) if parsed else text


def read_csv(
    spark: SparkSession,
    path: str,
    column_types: Mapping[str, str] | None = None,
    multiline: bool = False,
    unparsed: str | None = None,
    malformed: str | None = None,
    infer: bool = False,
) -> DataFrame:
    """Read CSV files with a header row (see ``read_text``), typed by column name.

    Text that is no value of its column's type gives NULL; ``unparsed`` names a column to
    keep such texts in.  A row with more or fewer fields than the header raises;
    ``malformed`` names a column to keep such rows in instead, whole, beside fields that are
    NULL.  With ``infer``, columns that ``column_types`` does not name get the narrowest
    type that fits, at the cost of one more pass; others stay text.
    """
    text = read_text(spark, path, multiline, malformed or MALFORMED)
    row = F.col(malformed or MALFORMED)
    fields = [c for c in text.columns if c != (malformed or MALFORMED)]
    if malformed:
        # A cut or shifted field is nobody's value.
        text = text.withColumns({c: F.when(row.isNull(), F.col(f"`{c}`")) for c in fields})
    else:
        # The first field is named as Spark refuses to read the marked rows' text alone.
        told = F.coalesce(row, F.col(f"`{fields[0]}`"))
        message = F.concat(F.lit("a row has another number of fields than the header: "), told)
        text = text.where(F.when(row.isNotNull(), F.raise_error(message)).otherwise(True)).drop(row)
    types = dict(column_types or {})
    if infer:
        types |= infer_types(text, [c for c in fields if c not in types])
    return typed(text, types, unparsed)


class Loaded(dict):
    """Raw tables by name, and the rows that entered none of them.

    ``quarantine`` has a row (table_name, malformed_row) for each such row; None without
    files.  ``rows`` are the tables' numbers of rows, where they were counted on the way.
    """

    def __init__(self) -> None:
        super().__init__()
        self.quarantine: DataFrame | None = None
        self.rows: dict[str, int] = {}


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV that ``read_csv`` reads back unchanged."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


class RawFiles:
    """The raw tables below one directory (local, HDFS or an object store).

    A table is looked for at ``<root>/<table>.csv``; ``names`` maps tables to other
    file names, and ``column_types`` adds types for further columns of a table.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        names: Mapping[str, str] | None = None,
        column_types: Mapping[str, Mapping[str, str]] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.names = dict(names or {})
        self.column_types = {
            table: {**types, **(column_types or {}).get(table, {})}
            for table, types in COLUMN_TYPES.items()
        }

    def path(self, table: str) -> str:
        return f"{self.root}/{self.names.get(table, table + '.csv')}"

    def text(self, table: str) -> DataFrame:
        """All rows as text, malformed ones marked."""
        return read_text(self.spark, self.path(table), table in MULTILINE_TABLES)

    def read(self, table: str) -> DataFrame:
        """The table straight from its files; columns without a named type stay text, and a
        malformed row raises."""
        return read_csv(
            self.spark,
            self.path(table),
            self.column_types[table],
            multiline=table in MULTILINE_TABLES,
            unparsed=UNPARSED,
        )

    def load(self, table: str) -> tuple[DataFrame, DataFrame, int]:
        """The table, its malformed rows (table_name, malformed_row) and its number of rows.

        The text is read once.  While it is written as Parquet, rows are counted and columns
        without a named type are tallied; later passes read only the columns they need.
        """
        text, named = self.text(table), self.column_types[table]
        unnamed = [c for c in text.columns if c not in named and c != MALFORMED]
        well = F.col(MALFORMED).isNull()
        found, counted = TypesOnTheWay(text, unnamed, well), Observation(f"rows of {table}")
        stored = stage(found.rows.observe(counted, F.count_if(well).alias("rows")), table)
        rows = stored.where(well).drop(MALFORMED)
        refused = stored.where(F.col(MALFORMED).isNotNull())
        return (
            typed(rows, {**named, **found.types()}, UNPARSED),
            refused.select(F.lit(table).alias("table_name"), MALFORMED),
            counted.get["rows"],
        )

    def load_all(self, optional: frozenset[str] = frozenset({"category_translation"})) -> Loaded:
        """Every table, and what was refused; an ``optional`` one may be missing."""
        tables, refused = Loaded(), []
        for name in COLUMN_TYPES:
            found = self._or_none(name, self.load) if name in optional else self.load(name)
            if found is not None:
                tables[name], malformed, tables.rows[name] = found
                refused.append(malformed)
        tables.quarantine = reduce(DataFrame.unionByName, refused)
        return tables

    def read_optional(self, table: str) -> DataFrame | None:
        """The table, or None if its file is missing; any other error is raised."""
        return self._or_none(table, self.read)

    @staticmethod
    def _or_none(table: str, read):
        try:
            return read(table)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
