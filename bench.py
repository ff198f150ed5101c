"""Headline benchmark: runs the mart queries at $BENCH_SF_DIR on
local[$BENCH_CPUS] and prints one JSON line.

Each query is timed end to end (plan + execute) with a full materialisation
of the result through a no-op sink (``write.format("noop")``), so every row
and column is computed but nothing is collected to the driver.

Before timing, every headline query runs once over the smallest driver data
set (``$BENCH_WARMUP_DIR``, default sf0.001): this warms the JVM (class
loading, JIT, code-generation cache) the way a long-lived session is warm.
Different files, so no data or result can carry over to the timed runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from funnelworks.catalog import QUERIES  # noqa: E402
from funnelworks.session import get_session  # noqa: E402

HEADLINE = [
    "stg_leads",
    "audit_leads",
    "int_leads_enriched",
    "int_audit_by_month",
    "mart_cac_ltv",
    "mart_gtm_funnel",
    "mart_leading_indicators",
    "mart_data_quality_monitor",
    "vq_lead_tier_counts",
    "metric_query_cac_ltv_vs_demo_rate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    names = [q for q in HEADLINE if q in QUERIES]
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
