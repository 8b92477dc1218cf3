"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; print one JSON line.

`value` is the sum of the per-query medians. A query on the raw tables includes
staging and building what it needs; a `mart.` entry runs on the published star.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from contract.bindings import QUERIES, trade_run
from orderloom.plans import reports
from orderloom.plans.checks import check_report
from orderloom.session import local_session
from orderloom.sources.trade_tables import TRADE_RULES

RAW = [
    "dim_customer",
    "dim_product",
    "dim_date",
    "fact_order",
    "dq_issues",
    "top_customers_by_orders",
    "top_customers_with_city",
    "orders_by_city",
    "city_revenue",
    "monthly_trend",
    "category_sales",
    "payment_breakdown",
    "top_products_by_units",
    "product_sales",
    "status_share",
    "quarterly_revenue",
    "duplicate_order_keys",
]


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def median_seconds(action: Callable[[], object], repeats: int) -> float:
    """Median of the timed runs after one run that is not timed."""
    action()
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cores)
    queries = {"star_build": median_seconds(lambda: trade_run(spark, folder), min(repeats, 2))}
    published = trade_run(spark, folder)
    star, issues = published.star(spark), published.issues(spark)
    on_mart = {
        "mart.monthly_trend": lambda: run(reports.monthly_order_trend(star)),
        "mart.city_revenue": lambda: run(reports.city_revenue(star)),
        "mart.product_sales": lambda: run(reports.product_sales(star)),
        "mart.status_share": lambda: run(reports.status_distribution(star)),
        "mart.headline_insights": lambda: run(reports.headline_insights(star)),
        "mart.quality_report": lambda: run(check_report(spark, star, issues, TRADE_RULES)),
    }
    for name, action in on_mart.items():
        queries[name] = median_seconds(action, repeats)
    for name in RAW:
        queries[name] = median_seconds(lambda: run(QUERIES[name](spark, folder)), repeats)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": int(cores),
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
