"""Time the headline queries and print one JSON line.

Each query is run to completion without collecting rows (the noop sink), once to warm up
and then twice; the better of the two counts.
"""

from __future__ import annotations

import json
import os
import time

HEADLINES = (
    "dp01_sales_geo_score",
    "fact_lines",
    "fact_lines_delta",
    "fact_insert_ignore",
    "customer_sales_metrics",
    "product_sales_metrics",
    "check_format_timestamp",
    "check_pk_duplicates_composite",
    "check_foreign_keys",
    "check_fact_grain",
    "check_measures",
    "profile_columns",
    "dim_date",
    "dim_geography",
    "surrogate_keys",
    "scd2_apply",
    "score_upsert",
    "latest_check_status",
    "dp02_checks",
)


def main() -> None:
    from silostar import session
    from silostar.workload.queries import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session.build(f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINES:
        run(name)
        seconds[name] = round(min(run(name), run(name)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
