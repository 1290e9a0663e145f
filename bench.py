"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully executed with the ``noop`` sink (every row computed, no
driver collect). Queries that write tables (round trips) include the write.
A first, cold pass over the queries warms the JVM (JIT, generated-code cache)
and publishes the long table that the metadata queries read; its times are
reported as ``cold_queries`` and ``cold_sec``. The timed pass follows. Set
``BENCH_WARMUP=0`` to time cold runs only.

For context (the published baseline has no timings), the same queries' oracle
SQL is also timed in DuckDB on the same data and machine, warm, and reported
as ``duckdb_same_sql_sec``; set ``BENCH_DUCKDB=0`` to skip it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from areatab.plans.registry import QUERIES  # noqa: E402
from areatab.session import get_session  # noqa: E402

HEADLINE = (
    "freq_all",
    "publish_long",
    "long_roundtrip",
    "publish_metadata",
    "freq_left_chain",
    "join_coverage",
    "total_check",
    "label_categories",
    "freq_by_levels",
    "dataset_stats",
    "join_geometry",
    "tile_counts",
    "repair_text_2001",
    "repair_text_1991",
)


def _duckdb_total(sf_dir: str, names: list[str]) -> float | None:
    try:
        import duckdb

        from areatab.plans.oracle import oracle_sql
    except ImportError:
        return None
    sql = oracle_sql()
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    total = 0.0
    for name in names:
        if name not in sql:
            continue
        con.execute(sql[name]).fetchall()
        t0 = time.perf_counter()
        con.execute(sql[name]).fetchall()
        total += time.perf_counter() - t0
    return round(total, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE)
    spark = get_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        },
    )
    warm = os.environ.get("BENCH_WARMUP", "1") != "0"
    cold: dict[str, float] = {}
    for name in only if warm else ["freq_vivienda"]:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        cold[name] = round(time.perf_counter() - t0, 3)

    times: dict[str, float] = {}
    for name in only:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    duck = _duckdb_total(sf_dir, only) if os.environ.get("BENCH_DUCKDB", "1") != "0" else None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "warm": warm,
    }
    if warm:
        out |= {"cold_sec": round(sum(cold.values()), 3), "cold_queries": cold}
    if duck is not None:
        out["duckdb_same_sql_sec"] = duck
    print(json.dumps(out))


if __name__ == "__main__":
    main()
