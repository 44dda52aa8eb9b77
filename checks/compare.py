"""Run the registered queries and their oracles side by side.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starloom-checks")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def canonical(table) -> list[str]:
    """All rows as text, with columns and rows sorted."""
    columns = sorted(table.column_names)
    rows = zip(*[table.column(c).to_pylist() for c in columns]) if columns else ()
    return sorted(repr(row) for row in rows)


def kinds(table) -> dict[str, str]:
    """Column types, with the spellings that differ between the engines levelled."""
    same = {"large_string": "string", "timestamp[us, tz=UTC]": "timestamp[us]"}
    return {f.name: same.get(str(f.type), str(f.type)) for f in table.schema}


def difference(spark_table, oracle_table) -> str:
    mine, theirs = kinds(spark_table), kinds(oracle_table)
    if set(mine) != set(theirs):
        return f"columns {sorted(set(mine) ^ set(theirs))}"
    a, b = canonical(spark_table), canonical(oracle_table)
    if len(a) != len(b):
        return f"{len(a)} rows, oracle {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, first: {wrong[0]}"
    types = {c: (mine[c], theirs[c]) for c in mine if mine[c] != theirs[c]}
    types = {c: t for c, t in types.items() if not all("list" in x for x in t)}
    return f"types {types}" if types else ""


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    from checks.oracles import ORACLES
    from checks.registry import QUERIES

    spark, connection, bad = session(), oracle(sf_dir), 0
    for name, query in QUERIES.items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            table = query(spark, sf_dir).toArrow()
            took = time.time() - started
            problem = (
                difference(table, connection.sql(ORACLES[name]).to_arrow_table())
                if name in ORACLES
                else "no oracle"
            )
        except Exception as error:  # noqa: BLE001 - reported, and the run fails below
            problem, took, table = f"{type(error).__name__}: {error}"[:1500], 0.0, None
        bad += bool(problem)
        rows = "-" if table is None else table.num_rows
        print(f"{name:28} {rows:>8} rows {took:6.2f} s  {problem or 'equal'}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
