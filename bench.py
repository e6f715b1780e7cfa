"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line.  ``build_<table>`` is the warehouse build, table by
table: stand-in inputs, dimensions, type-2 history and both facts, each
written once as parquet.  Every query then runs in full through the ``noop`` sink (no rows
travel to the driver) over that built star, as reports run over a built
warehouse; queries that do not use the star build their own inputs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimspark.plans import star as star_module  # noqa: E402
from claimspark.plans.catalog import QUERIES  # noqa: E402
from claimspark.session import get_session  # noqa: E402

HEADLINE = (
    "fact_claims_inner", "fact_claims_left", "scd2_history", "scd2_apply", "r02_by_state",
    "r06_by_month", "r10_point_in_time", "r12_occupation_rank", "r13_vehicle_risk", "r14_monthly_trend",
    "claims_flat", "risk_bucket", "column_profile", "column_inventory", "holder_snapshot_changed",
    "dq_report", "orphan_fk_report", "fact_drops_inner", "note_parse",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    scratch = tempfile.mkdtemp(prefix="claimspark-bench-")
    spark = get_session(
        f"local[{cpus}]",
        app_name="claimspark-bench",
        shuffle_partitions=int(cpus) * 2,
        conf={"spark.driver.memory": "8g", "spark.local.dir": scratch},
    )
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    # Warm-up: JVM start, class loading and file listing are not query time.
    QUERIES["r01_total"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    star_module._STARS.clear()
    times: dict[str, float] = {}
    star = star_module.star_for(spark, sf_dir)
    builds = {t: (lambda t=t: getattr(star, t)) for t in (
        "claims", "holder_snapshots", "dim_date", "dim_policy", "dim_vehicle", "dim_policyholder")}
    builds |= {f"fact_{m}": (lambda m=m: star.fact(m)) for m in ("inner", "left_keys")}
    for table, build in builds.items():
        t0 = time.perf_counter()
        build()
        times[f"build_{table}"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
