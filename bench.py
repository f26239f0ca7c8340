"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from grainmill.plans.catalog import CATALOG
from grainmill.session import local_session

HEADLINE = [
    "traffic_site",
    "site_dashboard",
    "hourly_site",
    "loyalty_site_alltime",
    "engine_rows",
    "keyword_rows",
    "bounce_engine_city_cascade",
    "table_out_link",
    "region_rows",
    "visitor_channel_bounce",
    "exit_page",
    "page_referrer_counts",
    "click_positions",
    "ip_region_range_join",
    "ip_region_window",
    "clean_hits",
    "clean_kind_counts",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    seconds = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            CATALOG[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}
        )
    )


if __name__ == "__main__":
    main()
