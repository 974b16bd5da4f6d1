"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the
timed runs (the median counts).  Each query is built anew and its whole result
is written to a sink that discards it, so every column of every row is computed.

``queries`` are whole queries, with the tables a load would find made first; ``value`` is
their sum.  ``operators`` are the same merges with those tables stored before the clock starts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests.sessions import local_session  # noqa: E402
from sedimenta.operators.history import scd2_apply  # noqa: E402
from sedimenta.operators.merge import upsert  # noqa: E402
from sedimenta.plans.facts import upsert_orders  # noqa: E402
from sedimenta.plans.snapshots import customer_monthly_snapshot  # noqa: E402
from sedimenta.session import stored  # noqa: E402
from workload import QUERIES, gold, silver  # noqa: E402
from workload.inputs import RUN_3, THIRD_LOAD  # noqa: E402

HEADLINE = (
    "bronze_initial_load",
    "latest_per_key",
    "cdc_apply_merge",
    "clean_strings",
    "dq_valid_rows",
    "dq_rejected_rows",
    "dq_ref_integrity_rule",
    "dq_table_rules",
    "ri_orphans",
    "scd1_upsert",
    "scd2_apply",
    "silver_transform",
    "surrogate_keys",
    "dim_date",
    "dim_product",
    "dim_customer_scd2",
    "fact_orders",
    "fact_orders_upsert",
    "fact_order_lines",
    "customer_monthly_snapshot",
    "v_customer_360",
    "v_monthly_sales_trend",
    "v_product_performance",
    "replace_where",
    "cluster_layout",
    "bronze_incremental_load",
    "silver_load_metrics",
    "partitioned_write",
    "dlq_summary",
    "star_build",
)
# Two builds of the whole star with their writes: timed once, after all others.
ONCE = ("star_build",)


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run(spark, name: str, sf_dir: str) -> float:
    return timed(lambda: QUERIES[name](spark, sf_dir))


def prepared(spark, sf_dir: str) -> dict:
    """Merges over tables that are stored already, as a load finds them."""
    first, later, third = (stored(silver._profile(spark, sf_dir, p), "profile") for p in ("profile_1", "profile_later", "profile_3"))
    history = silver._history_2(spark, sf_dir)
    older, newer = (stored(df, "facts") for df in gold._two_loads(spark, sf_dir))
    facts, days = stored(gold._fact_orders(spark, sf_dir), "facts"), stored(gold._dim_date(spark, sf_dir), "days")
    return {
        "scd1_upsert": lambda: upsert(first, later, silver.KEY),
        "scd2_apply": lambda: scd2_apply(history, third, silver.KEY, silver.TRACKED, THIRD_LOAD),
        "fact_orders_upsert": lambda: upsert_orders(older, newer),
        "customer_monthly_snapshot": lambda: customer_monthly_snapshot(facts, days, RUN_3, THIRD_LOAD),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    folder = tempfile.mkdtemp(prefix="bench-")  # one machine: tables of the loads and stored steps
    spark = local_session(
        os.environ.get("BENCH_CPUS", str(os.cpu_count())),
        **{"spark.checkpoint.dir": f"{folder}/shared", "spark.sql.warehouse.dir": f"{folder}/warehouse"},
    )
    seconds = {}
    for name in HEADLINE:
        if name not in ONCE:
            run(spark, name, sf_dir)  # warm-up: class loading and code generation
        times = 1 if name in ONCE else runs
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(times)), 3)
    operators = {}
    for name, make in prepared(spark, sf_dir).items():
        timed(make)
        operators[name] = round(statistics.median(timed(make) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "operators": operators,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
