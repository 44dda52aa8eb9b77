"""Time every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

The warehouse is built first and timed as ``build_<table>``; the business queries then
read it, as in production.  Every query is run to its last row and column.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import registry  # noqa: E402
from checks.compare import session  # noqa: E402
from starloom.sources.warehouse import TABLES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times: dict[str, float] = {}

    def timed(name, run) -> None:
        started = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name:28} {times[name]:8.3f} s", file=sys.stderr, flush=True)

    # Starting executors and loading classes is not what is measured.
    spark.read.parquet(f"{sf_dir}/nation.parquet").collect()

    for table in sorted(TABLES, key=lambda t: t == "fact_orders"):
        timed(f"build_{table}", lambda t=table: registry.table(spark, sf_dir, t))
    for name, query in registry.QUERIES.items():
        timed(
            name,
            lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save(),
        )
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
