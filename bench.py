"""Time the headline queries: one JSON line on stdout.

Data: $BENCH_SF_DIR (default /root/testdata/sf0.1); cores: $BENCH_CPUS (default 8).
Every query runs once untimed, so that code generation and file listing do not
count, then is timed end to end: plan construction, planning, execution, fetch.
"""

from __future__ import annotations

import json
import os
import time

from florin.plans.registry import QUERIES
from florin.session import build_session

HEADLINES = [
    "available_union",
    "money_market_settlement",
    "money_market_same_day",
    "concept_homologation",
    "unity_totals",
    "latest_account_version",
    "ach_time_slots",
    "credit_confirming",
    "sebra_net_movements",
    "ach_refunds",
    "bank_transaction_totals",
    "account_variation",
    "issuance_repurchase",
    "income_statement",
    "expense_statement",
    "cash_summary",
    "cash_summary_backfill",
    "report_transpose",
    "upsert_partitioned",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "florin-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        for _ in range(2):
            start = time.perf_counter()
            rows = QUERIES[name](spark, sf_dir).collect()
            seconds[name] = round(time.perf_counter() - start, 3)
        assert rows, name
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
