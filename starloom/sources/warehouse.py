"""The warehouse: Parquet tables in versions, and a pointer that tells which ones count.

A table's files are in ``<root>/<table>/version=<n>``, the fact's below that by month.  What
readers see is told by one small file, ``<root>/CURRENT``, which is replaced last and in one
step: a build that dies leaves the tables of the one before as they were.  For the fact the
file names a version for each month, so that late months are written alone.

There is one writer at a time; readers need no lock.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.sources.scratch import remove

# The columns that the fact is split by, and the tables offered as SQL views.
FACT = "fact_orders"
FACT_PARTITIONS = ("order_year", "order_month")
VIEW_TABLES = (
    "fact_orders",
    "dim_customers",
    "dim_products",
    "dim_sellers",
    "dim_date",
    "dim_payments",
    "dim_reviews",
)
TABLES = (*VIEW_TABLES, "dim_geolocation")

POINTER = "CURRENT"
VERSION = "version"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    watch: tuple[Observation, Sequence[Column]] | None = None,
    balanced: bool = False,
) -> None:
    """Write a table, replacing what was there.

    With partition columns the rows are first rebalanced on them: a task then writes
    to few directories, and adaptive execution splits a month that holds far more
    rows than the others, so files come out at the advisory size either way.  Rows that
    come ``balanced`` are taken as they are.  ``watch`` takes aggregates of the rows as they
    are written; it stands behind the rebalancing, in the last stage, where each task counts
    once even if others are run again.
    """
    if partition_by and not balanced:
        df = df.hint("rebalance", *partition_by)
    if watch:
        df = df.observe(watch[0], *watch[1])
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._pending: dict | None = None

    # --- the pointer ---------------------------------------------------------------

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(path)
        return jvm, conf, folder, folder.getFileSystem(conf)

    def published(self) -> dict:
        """What the pointer says: the last version's number, the version of each table, and
        of each month of the fact; empty before the first write."""
        jvm, _, path, files = self._hadoop(f"{self.root}/{POINTER}")
        if not files.exists(path):
            return {"number": 0, "tables": {}, "months": {}}
        stream = files.open(path)
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, state: dict) -> None:
        """Replace the pointer by a rename, which file systems do in one step."""
        jvm, conf, path, files = self._hadoop(f"{self.root}/{POINTER}")
        jvm, _, fresh, _ = self._hadoop(f"{self.root}/.{POINTER}-{uuid.uuid4().hex}")
        stream = files.create(fresh)
        try:
            stream.write(json.dumps(state, sort_keys=True).encode())
        finally:
            stream.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(path).toUri(), conf)
        context.rename(files.makeQualified(fresh), files.makeQualified(path), options)

    @contextmanager
    def replacing(self) -> Iterator[None]:
        """Tables written inside appear to readers together, at the end.

        If anything raises, none of them does and their files are removed.  Inside, ``read``
        sees the tables that were just written.
        """
        if self._pending is not None:
            raise ValueError("the warehouse is being replaced already")
        before = self.published()
        self._pending = json.loads(json.dumps(before)) | {"number": before["number"] + 1}
        written = self._pending["number"]
        try:
            yield
            self._publish(self._pending)
        except BaseException:
            for table in {*self._pending["tables"], *([FACT] if self._pending["months"] else [])}:
                remove(self.spark, self._folder(table, written))
            raise
        finally:
            self._pending = None

    # --- tables --------------------------------------------------------------------

    def _folder(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/{VERSION}={version}"

    def _state(self) -> dict:
        return self._pending if self._pending is not None else self.published()

    def write(
        self,
        table: str,
        df: DataFrame,
        watch: tuple[Observation, Sequence[Column]] | None = None,
        balanced: bool = False,
    ) -> None:
        """Replace a table; a fact that is ``balanced`` on its months is not shuffled again."""
        self._write(table, df, watch, keep_months=False, balanced=balanced)

    def write_months(self, df: DataFrame) -> None:
        """Replace the months of the fact that ``df`` holds; all others keep their files.

        Rows without a month are a month of their own.  The columns must be the fact's.
        """
        if FACT in self._state()["tables"] and set(df.columns) != set(self.read(FACT).columns):
            raise ValueError("the months have other columns than the fact")
        self._write(FACT, df, None, keep_months=True)

    def _write(self, table: str, df: DataFrame, watch, keep_months: bool, balanced: bool = False) -> None:
        if self._pending is None:
            with self.replacing():
                self._write(table, df, watch, keep_months, balanced)
            return
        state = self._pending
        folder = self._folder(table, state["number"])
        if table != FACT:
            write_table(df, folder, watch=watch)
        else:
            write_table(df, folder, FACT_PARTITIONS, watch, balanced)
            months = state["months"] if keep_months else {}
            # One name for each month; the list of files is the driver's in any case.
            found = {_month_of(f) for f in self.spark.read.parquet(folder).inputFiles()}
            state["months"] = months | {m: state["number"] for m in found if m}
        state["tables"][table] = state["number"]

    def read(self, table: str) -> DataFrame:
        """A table as the pointer has it now; later writes do not change what this reads."""
        state, owners = self._state(), defaultdict(list)
        for month, version in state["months"].items() if table == FACT else ():
            owners[version].append(month)
        if len(owners) < 2:
            # A table without a version raises as any missing folder does.
            return self.spark.read.parquet(self._folder(table, state["tables"].get(table, 0)))
        # All versions in one scan, of which partition pruning keeps each month's own.
        kept = [
            (F.col(VERSION) == version) & reduce(Column.__or__, map(_in_month, months))
            for version, months in sorted(owners.items())
        ]
        rows = self.spark.read.parquet(f"{self.root}/{FACT}")
        return rows.where(reduce(Column.__or__, kept)).drop(VERSION)

    def drop_unused(self) -> list[str]:
        """Remove versions that the pointer does not name; readers of those must be done."""
        state, gone = self.published(), []
        for table, version in state["tables"].items():
            used = {version, *(state["months"].values() if table == FACT else ())}
            _, _, folder, files = self._hadoop(f"{self.root}/{table}")
            for found in files.listStatus(folder):
                name = found.getPath().getName()
                if name.startswith(f"{VERSION}=") and int(name.split("=")[1]) not in used:
                    remove(self.spark, f"{self.root}/{table}/{name}")
                    gone.append(f"{table}/{name}")
        return sorted(gone)

    def register_views(self, tables: Sequence[str] = VIEW_TABLES) -> None:
        """Offer tables to ``spark.sql``.  Nothing is cached: partitions get pruned."""
        for table in tables:
            self.read(table).createOrReplaceTempView(table)


def _month_of(file: str) -> str | None:
    """The month that a file belongs to, as year/month."""
    found = re.search("/".join(f"{c}=([^/]*)" for c in FACT_PARTITIONS), file)
    return "/".join(unquote(part) for part in found.groups()) if found else None


def _in_month(month: str) -> Column:
    parts = [None if p == NO_MONTH else int(p) for p in month.split("/")]
    return reduce(
        Column.__and__, [F.col(c).eqNullSafe(F.lit(p)) for c, p in zip(FACT_PARTITIONS, parts)]
    )
