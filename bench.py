"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local threads. Every query
runs to its last row (a no-op sink), once to warm up and then ``BENCH_RUNS`` times; the best time
counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from stratiform.plans import flow
from stratiform.queries import queries
from stratiform.queries.registry import table
from stratiform.queries.runs import ORDERS
from stratiform.session import local_session

HEADLINE = [
    "flow_orders", "bronze_annotate", "bronze_full_report", "uniqueness_check", "rules_full", "pk_unique",
    "conform_mapping", "publish_merge", "publish_merge_partitions", "merge_sequence", "zorder_cluster",
    "dq_rule_summary", "reject_envelope", "reconcile_counts", "multi_source_summary", "gate_by_run",
    "mon_run_health", "mon_fail_rate", "mon_rejections", "alert_dq_rate", "resume_point", "advise_layout",
    "validate_registry", "validate_references", "dry_run_plan", "payload_explode", "page_continuity",
    "json_rescue", "scan_batch_formats", "stream_landing",
]


def full_flow(spark, sf_dir: str) -> None:
    """Raw orders to silver with all audit tables, as a user would run it."""
    tag = f"t{time.time_ns()}"
    tables = flow.AuditTables(
        **{k: f"spark_catalog.default.{k}_{tag}" for k in flow.AuditTables.__dataclass_fields__}
    )
    spec = flow.with_rules(
        ORDERS,
        read=lambda s: table(s, sf_dir, "orders"),
        landing_table=f"spark_catalog.default.landing_{tag}",
        conformance_table=f"spark_catalog.default.conformed_{tag}",
        silver_table=f"spark_catalog.default.silver_{tag}",
    )
    flow.run_source(spark, spec, tables, "bench")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    chosen = sys.argv[1:] or HEADLINE
    jobs = {n: (lambda n=n: known[n](spark, sf_dir).write.format("noop").mode("overwrite").save()) for n in chosen if n in known}
    if not sys.argv[1:] or "full_flow" in chosen:
        jobs["full_flow"] = lambda: full_flow(spark, sf_dir)
    seconds = {}
    for name, job in jobs.items():
        job()
        best = None
        for _ in range(runs):
            began = time.perf_counter()
            job()
            spent = time.perf_counter() - began
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
