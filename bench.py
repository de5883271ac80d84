"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import crm  # noqa: E402
from checks.queries import MODELS, Crm  # noqa: E402
from funnelry.session import build_session  # noqa: E402
from funnelry.sources.tables import stored  # noqa: E402

HEADLINE = [
    "silver_activities",
    "dedup_latest",
    "funnel_events",
    "asof_first_after",
    "asof_heavy_keys",
    "fact_lead_funnel",
    "funnel_summary",
    "rpt_inbound",
    "rpt_outbound",
    "rpt_closer",
    "rpt_objections",
    "audit_types",
    "audit_fields",
    "audit_outcomes",
    "dim_user",
    "role_coverage",
    "duplicate_summary",
    "sale_source_compare",
    "cdc_classify",
    "upsert_latest",
    "executive_kpis",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The models start from landed raw tables; making those out of the driver tables is
    # the source system's part and is reported apart.
    start = time.perf_counter()
    landed = {n: stored(df, n) for n, df in crm.raw_tables(spark, sf_dir).items()}
    setup = round(time.perf_counter() - start, 3)
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # Every query builds all its layers anew: nothing is shared between queries.
        result = MODELS[name](Crm(spark, sf_dir, landed))
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "landing_setup_sec": setup,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
