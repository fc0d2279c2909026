"""Time the headline queries on $BENCH_SF_DIR with $BENCH_CPUS cores; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vaultspan.plans.registry import queries  # noqa: E402
from vaultspan.session import local_session  # noqa: E402

HEADLINE = (
    "mart_aum_ytd",
    "mart_client_exposure",
    "mart_portfolio_performance",
    "mart_ptf_detail",
    "mart_rm_performance",
    "int_fct_ast",
    "int_fct_ptf",
    "int_ptf",
    "asof_fx_rate",
    "scd2_portfolios",
    "stg_fct_ast",
)


def seconds(spark, query, folder: str) -> float:
    """Planning and execution of every row and column, without collecting them."""
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores)
    registered = queries()
    # the better of two runs: the first one also compiles the generated code
    times = {name: min(seconds(spark, registered[name], folder) for _ in range(2)) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", folder)
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in times.items()},
        "sf": float(scale.group(1)) if scale else None,
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
