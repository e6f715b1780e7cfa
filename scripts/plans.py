"""Write PLANS.md: the executed physical plan shape of every registered query.

For each query: join strategies, exchanges, aggregates, windows and what
reaches each parquet scan (pushed filters, read schema).  Run after a change
to see whether a plan kept its shape.  Usage:
    python scripts/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from claimspark.operators.keys import first_by  # noqa: E402
from claimspark.plans import star as star_module  # noqa: E402
from claimspark.plans.catalog import QUERIES  # noqa: E402
from claimspark.session import get_session  # noqa: E402

KEEP = re.compile(r"(Join|Exchange|Aggregate|Window|Scan parquet|FileScan|Sort \[|Generate|Expand|MapInPandas|"
                  r"TakeOrdered|CollectLimit|Union)")


def shape(df) -> list[str]:
    df.write.format("noop").mode("overwrite").save()        # run, so AQE's final plan is shown
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"Location: [^,]*, ", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        out.append(line[:260])
    return out


STAR_TABLES = ("claims", "holder_snapshots", "dim_date", "dim_policy", "dim_vehicle", "dim_policyholder")


def main() -> None:
    sf = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01").rstrip("/")
    spark = get_session("local[8]", shuffle_partitions=8)
    print("# Physical plans\n")
    print(f"Generated by `scripts/plans.py` at `{sf}` on local[8]: AQE final plans, after execution.")
    print("Only joins, exchanges, aggregates, windows, sorts and scans are kept.\n")
    print("## 1. How each star table is built\n")
    print("Built lazily here so the whole plan shows.  The registered queries build each table once,")
    print("write it, and scan it (section 2).  A keyed table starts from the written ranges of `dense_key`; its")
    print("only single partition holds one row per range, in the running sum of the offsets.  What is keyed")
    print("is shown before it.\n")
    lazy = star_module.Star(spark, sf, materialize=False)
    keyed = {"dim_policy": lambda: first_by(lazy.claims.select("policy_number", "policy_state", "claim_id"),
                                            ["policy_number"], ["claim_id"]),
             "dim_vehicle": lambda: lazy.claims.select("auto_make", "auto_model", "auto_year").distinct()}
    for name, build in keyed.items():
        print(f"### {name}, before its keys\n\n```")
        print("\n".join(shape(build())))
        print("```\n")
    for name in STAR_TABLES:
        print(f"### {name}\n\n```")
        print("\n".join(shape(getattr(lazy, name))))
        print("```\n")
    for mode in ("inner", "left_keys"):
        print(f"### fact_claims ({mode})\n\n```")
        print("\n".join(shape(lazy.fact(mode))))
        print("```\n")
    print("## 2. Registered queries as they run\n")
    print("Over the written star tables, exactly as `queries()` executes them.\n")
    for name, fn in QUERIES.items():
        print(f"### {name}\n\n```")
        print("\n".join(shape(fn(spark, sf))))
        print("```\n")


if __name__ == "__main__":
    main()
