"""Print condensed physical plans of key queries (operators, pushed
filters, read schemas) as Markdown:

    python tests/plan_report.py /root/testdata/sf0.1 > docs/PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

KEYS = [
    ("stg_sales", "latest-wins dedup: partial WindowGroupLimit before the key shuffle; NULL-key filter and column pruning at the scan"),
    ("mart_sales_daily_kpi", "partial aggregation, single-distinct rewrite, bounded date dimension broadcast after the aggregate"),
    ("mart_product_category_sales_kpi", "two exact distinct counts via Expand + two-level aggregation"),
    ("mart_load_audit", "two per-file aggregates joined"),
    ("upsert_fact", "keyed merge = anti-join on the key + union; high-water mark as a scalar subquery"),
    ("usage_by_day", "time window and allow-list pushed to the scan"),
    ("top_queries_by_time", "top-k as TakeOrderedAndProject"),
    ("restate_kpi_dates", "restatement limited to touched dates (semi-join)"),
]
KEEP = ("Scan", "Exchange", "Aggregate", "Join", "WindowGroupLimit", "Window", "Expand", "TakeOrdered",
        "Subquery", "Union", "Filter", "Sort")


def condense(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: [^,]+,", "", line)
        out.append(line[:220])
    return out


def main() -> None:
    from tidemark.plans.catalog import QUERIES
    from tidemark.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Physical plans ({sf}, local[8], AQE on; initial plans before runtime re-optimisation)\n")
    print("Generated by `tests/plan_report.py`. Expression ids and plan ids are stripped.\n")
    for name, why in KEYS:
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## `{name}`\n\n{why}.\n\n```")
        print("\n".join(condense(plan)))
        print("```\n")


if __name__ == "__main__":
    main()
