"""End-to-end runs: wide-file cleaning, warehouse build, marts and checks.

Each step is a lazy ``DataFrame`` function; actions happen only at the
writes (and at the size checks the key and join operators need).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from claimspark.operators import checks as V
from claimspark.operators import contracts as C
from claimspark.operators import dims, facts, quality, scd2
from claimspark.plans import reports as R
from claimspark.sources import layers
from claimspark.sources.published import PublishedTables


@dataclass
class CleanResult:
    drift: DataFrame
    distribution: DataFrame
    input_rows: int
    output_path: str


def clean_wide_file(spark: SparkSession, bronze_csv: str, silver_path: str) -> CleanResult:
    """Wide sentinel-coded file to silver parquet partitioned by risk bucket.

    Drift is reported from the schema; the input row count is an
    observation of the single write job rather than a second pass.
    """
    raw, drift = layers.load_with_drift_check(spark, bronze_csv, C.EXPECTED_WIDE_COLUMNS)
    observed, obs = quality.with_row_count(raw)
    cleaned = quality.clean_wide(observed)
    layers.write_partitioned(cleaned, silver_path, "risk_bucket")
    silver = spark.read.parquet(silver_path)
    return CleanResult(drift, quality.bucket_distribution(silver), obs.get["input_rows"], silver_path)


@dataclass
class Warehouse:
    dim_date: DataFrame
    dim_policy: DataFrame
    dim_vehicle: DataFrame
    dim_policyholder: DataFrame
    fact_claims: DataFrame


def build_warehouse(
    spark: SparkSession,
    claims: DataFrame,
    snapshots: DataFrame,
    gold: layers.Layers,
    mode: str = "inner",
    history_mode: str = "strict",
) -> Warehouse:
    """Dimensions, type-2 history and the fact, each written to the gold layer.

    The claims are written to the silver layer first: the date range, three
    dimensions and the fact read that table instead of deriving it again.
    """
    def table(name: str, df: DataFrame) -> DataFrame:
        return layers.materialize(df, name, "table", gold.path("silver" if name == "claims" else "gold", name))

    return _build(spark, claims, snapshots, table, mode, history_mode)


def publish_warehouse(
    spark: SparkSession,
    claims: DataFrame,
    snapshots: DataFrame,
    root: str,
    mode: str = "inner",
    history_mode: str = "strict",
) -> tuple[Warehouse, DataFrame]:
    """Build every table aside, check them all, then publish them by one record.

    Returns the published warehouse and its check report.  Where a check
    fails, ``CheckFailed`` is raised and readers of ``root`` keep the
    warehouse that was published before, whole.
    """
    tables = PublishedTables(spark, root)
    staged = _build(spark, claims, snapshots, tables.stage, mode, history_mode)
    report = warehouse_checks(staged)
    tables.publish(report)
    return staged, report


def read_warehouse(spark: SparkSession, root: str, version: int | None = None) -> Warehouse:
    """The published warehouse, by default the newest; all its tables are of one build."""
    tables = PublishedTables(spark, root)
    return Warehouse(**{f: tables.read(f, version) for f in Warehouse.__dataclass_fields__})


def _build(spark: SparkSession, claims: DataFrame, snapshots: DataFrame, table: Callable[[str, DataFrame], DataFrame],
           mode: str, history_mode: str) -> Warehouse:
    claims = table("claims", claims)
    start, end = dims.dim_date_range_for(claims, "incident_date")
    dim_date = table("dim_date", dims.generate_dim_date(spark, start, end))
    dim_policy = table("dim_policy", dims.build_dim_policy(claims))
    dim_vehicle = table("dim_vehicle", dims.build_dim_vehicle(claims))
    dim_holder = table("dim_policyholder", scd2.build_history(snapshots, mode=history_mode))
    fact = table("fact_claims", facts.build_fact(claims, dim_policy, dim_holder, dim_vehicle, dim_date, mode=mode))
    return Warehouse(dim_date, dim_policy, dim_vehicle, dim_holder, fact)


def warehouse_checks(w: Warehouse) -> DataFrame:
    """Primary keys, NOT NULL foreign keys, references and single current version (V1-V6), one scan a table."""
    fks = [("policy_key", w.dim_policy, "policy_key"), ("policyholder_key", w.dim_policyholder, "policyholder_key"),
           ("vehicle_key", w.dim_vehicle, "vehicle_key"), ("incident_date_key", w.dim_date, "date_key")]
    keys = {"dim_policy": "policy_key", "dim_vehicle": "vehicle_key", "dim_date": "date_key"}
    return V.report([
        V.audit(w.fact_claims, "fact_claims", unique=[["claim_key"]], not_null=["claim_key", *[f for f, _, _ in fks]], references=fks),
        V.audit(w.dim_policyholder, "dim_policyholder", unique=[["policyholder_key"]], single_current="policyholder_id"),
        *[V.audit(getattr(w, name), name, unique=[[key]]) for name, key in keys.items()],
    ])


def run_marts(w: Warehouse) -> dict[str, DataFrame]:
    """All report marts over a built warehouse."""
    f = w.fact_claims
    return {
        "r01_total": R.r01_total(f),
        "r02_by_state": R.r02_by_state(f, w.dim_policy),
        "r03_fraud_by_severity": R.r03_fraud_by_severity(f),
        "r04_by_make": R.r04_by_make(f, w.dim_vehicle),
        "r05_by_year": R.r05_by_year(f, w.dim_date),
        "r06_by_month": R.r06_by_month(f, w.dim_date),
        "r07_by_education": R.r07_by_education(f, w.dim_policyholder),
        "r08_by_occupation": R.r08_by_occupation(f, w.dim_policyholder),
        "r09_fraud_by_make": R.r09_fraud_by_make(f, w.dim_vehicle),
        "r10_point_in_time": R.r10_point_in_time(f, w.dim_date, w.dim_policyholder),
        "r11_fraud_by_state": R.r11_fraud_by_state(f, w.dim_policy),
        "r12_occupation_rank": R.r12_occupation_rank(f, w.dim_date, w.dim_policyholder),
        "r13_vehicle_risk": R.r13_vehicle_risk(f, w.dim_vehicle),
        "r14_monthly_trend": R.r14_monthly_trend(f, w.dim_date),
    }
