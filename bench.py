"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data directory (default sf0.1), BENCH_CPUS the local
cores. The staging tables and the warehouse are built first and timed as
queries of their own; every other query is then timed twice, all rows computed:
cold in "queries" and, with code compiled and files cached, in "warm".
"""

from __future__ import annotations

import json
import os
import time

from stallkeep.queries import built
from stallkeep.queries.registry import all_queries
from stallkeep.session import build_session

HEADLINE = (
    "ing_10_load", "ing_09_key_unique", "aud_06_orphan_references", "aud_11_payment_item_diagnostic",
    "dq_02_duplicate_groups", "dq_17_exact_duplicates", "dq_21_sequence_anomalies", "dq_24_mismatch_summary",
    "chk_reviews_metrics", "chk_geolocation_metrics", "geo_09_state_resolution", "geo_13_city_label",
    "geo_15_median_coordinates", "geo_16_conformed_geography", "cst_05_conformed_customer", "dat_07_dim_date",
    "dim_02_surrogate_keys", "dim_06_dim_customer", "dim_09_dim_product", "fct_02_fact_order",
    "fct_05_fact_order_item", "fct_08_fact_payment", "fct_11_fact_review", "rec_02_differences",
    "rule_fact_order", "rule_fact_review", "gate_03_facts", "kpi_01_item_sales", "kpi_03_delivery_performance",
    "kpi_04_average_order_value", "kpi_06_early_answers",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    timings: dict[str, float] = {}
    warm: dict[str, float] = {}

    def timed(name: str, work, into: dict[str, float] = timings) -> None:
        start = time.perf_counter()
        work()
        into[name] = round(time.perf_counter() - start, 3)

    timed("build_staging", lambda: built.staging(spark, sf_dir))
    timed("run_01_build_warehouse", lambda: built.warehouse(spark, sf_dir))
    for into in (timings, warm):
        for name in HEADLINE:
            timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save(), into)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": timings, "warm": warm, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
