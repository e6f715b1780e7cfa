"""Command line: run the warehouse steps over a folder of input tables.

    python -m claimspark clean-wide  --input DIR --out ROOT
    python -m claimspark warehouse   --input DIR --out ROOT [--mode inner|left_keys]
    python -m claimspark all         --input DIR --out ROOT

``warehouse`` builds the dimensions, history and fact aside, checks them and
publishes them together under ROOT/gold/warehouse, then writes the check
report to ROOT/checks and every report mart to ROOT/marts/<name>.  When a
check fails it publishes nothing and exits non-zero.  Outputs are written by
the executors; only the check report's few rows reach the driver.
"""

from __future__ import annotations

import argparse
import sys

from claimspark.operators import checks as V
from claimspark.operators.contracts import conform
from claimspark.plans import pipeline
from claimspark.session import get_session
from claimspark.sources import layers, stand_ins


def _clean_wide(spark, args) -> None:
    root = layers.Layers(args.out)
    bronze = root.path("bronze", "wide_claims")
    layers.write_csv(stand_ins.wide_claims(spark, args.input), bronze)
    res = pipeline.clean_wide_file(spark, bronze, root.path("silver", "wide_claims"))
    layers.write_parquet(res.drift, root.path("silver", "wide_claims_drift"))
    print(f"wide claims: {res.input_rows} rows cleaned into {res.output_path}")


def _warehouse(spark, args) -> bool:
    root = layers.Layers(args.out)
    claims = stand_ins.claims(spark, args.input)
    snapshots = conform(stand_ins.holder_snapshots(spark, args.input), "policyholder_snapshot")
    out = args.out.rstrip("/")
    try:
        w, report = pipeline.publish_warehouse(spark, claims, snapshots, root.path("gold", "warehouse"), mode=args.mode)
    except V.CheckFailed as e:
        print(f"checks failed, nothing published: {e}", file=sys.stderr)
        return False
    layers.write_parquet(report, f"{out}/checks")
    for name, df in pipeline.run_marts(w).items():
        layers.write_parquet(df, f"{out}/marts/{name}")
    print(f"warehouse published under {root.path('gold', 'warehouse')} with all checks passing")
    return True


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="claimspark")
    parser.add_argument("step", choices=("clean-wide", "warehouse", "all"))
    parser.add_argument("--input", required=True, help="folder of input parquet tables")
    parser.add_argument("--out", required=True, help="output root (bronze/silver/gold/marts/checks)")
    parser.add_argument("--mode", default="inner", choices=("inner", "left_keys"))
    parser.add_argument("--master", default=None, help="Spark master; default: the environment's")
    args = parser.parse_args(argv)
    spark = get_session(args.master)
    ok = True
    if args.step in ("clean-wide", "all"):
        _clean_wide(spark, args)
    if args.step in ("warehouse", "all"):
        ok = _warehouse(spark, args)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
