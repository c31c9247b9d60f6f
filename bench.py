"""Benchmark; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3).


* ``load``: the warehouse build (K8): calendar, product and store
  dimensions, three Type-2 snapshot merges, staging, the fact resolve with
  dense sale keys and the month-partitioned write. Run once.
* ``wh_*``: the star-schema questions on the persisted warehouse (what a
  user runs after a load), median of ``BENCH_RUNS`` runs to the ``noop`` sink.
* ``e2e_*``: registered queries end to end from the raw tables (star
  built inside the query), median of ``BENCH_RUNS`` runs to ``noop``.

``value`` is the sum of all parts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from starloom.operators import conform, facts  # noqa: E402
from starloom.plans import analytics as A  # noqa: E402
from starloom.plans.registry import Q1_MONTHS, Q1_TOTAL, REGISTRY  # noqa: E402
from starloom.plans.warehouse import build, open_star  # noqa: E402
from starloom.session import build_session, checkpoint_dir  # noqa: E402

E2E = [
    "scd2_merge",
    "scd2_rebuild",
    "fact_resolve",
    "unknown_member",
    "category_month",
    "monthly_trend",
    "segment_pit_vs_current",
    "drill_across",
    "periodic_snapshot",
    "semi_additive",
    "accumulating_snapshot",
]


def warehouse_queries(star):
    d = star.date_dim("date_key", "year_month")
    cats = star.dim("product", "product_key", "category")
    return {
        "wh_category_month": lambda: A.category_month_revenue(star, Q1_MONTHS, Q1_TOTAL),
        "wh_monthly_trend": lambda: A.monthly_trend(star),
        "wh_customer_history": lambda: A.customer_history(star.dim_customer),
        "wh_segment_pit_vs_current": lambda: A.segment_pit_vs_current(star),
        "wh_preaggregate": lambda: facts.preaggregate(star.fact, d, cats),
        "wh_order_rollup": lambda: facts.order_rollup(star.fact),
        "wh_region_two_ways": lambda: conform.drill_across(
            star.fact.join(star.dim("store", "store_key", "region"), "store_key")
            .groupBy("region")
            .agg(F.sum("net_amount").alias("by_store")),
            star.fact.join(star.dim("customer", "customer_key", "region"), "customer_key")
            .groupBy("region")
            .agg(F.sum("net_amount").alias("by_customer")),
            ["region"],
        ),
    }


def timed(make) -> float:
    t0 = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    checkpoint_dir(spark)
    timed(lambda: REGISTRY["monthly_trend"][0](spark, root))  # warm-up: JVM, codegen, listing

    times: dict[str, float] = {}
    out = tempfile.mkdtemp(prefix="starloom-bench-wh-")
    t0 = time.perf_counter()
    build(spark, root, out)
    times["load"] = round(time.perf_counter() - t0, 3)

    star = open_star(spark, root, out)
    for name, make in warehouse_queries(star).items():
        times[name] = round(statistics.median(timed(make) for _ in range(runs)), 3)
    for name in E2E:
        fn = REGISTRY[name][0]
        times[f"e2e_{name}"] = round(statistics.median(timed(lambda: fn(spark, root)) for _ in range(runs)), 3)

    m = re.search(r"sf([0-9.]+)", root)
    wh = sum(v for k, v in times.items() if k.startswith("wh_"))
    e2e = sum(v for k, v in times.items() if k.startswith("e2e_"))
    print(
        json.dumps(
            {
                "metric": "sum_seconds_load_plus_median_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "load_sec": times["load"],
                "warehouse_query_sec": round(wh, 3),
                "e2e_query_sec": round(e2e, 3),
                "sf": float(m.group(1)) if m else root,
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
