"""Schema contracts, conformance, required columns and drift."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The 55 column names the wide claims file is expected to carry.
# ---------------------------------------------------------------------------
EXPECTED_WIDE_COLUMNS = (
    "id", "target",
    "ps_ind_01", "ps_ind_02_cat", "ps_ind_03", "ps_ind_04_cat", "ps_ind_05_cat",
    "ps_ind_06_bin", "ps_ind_07_bin", "ps_ind_08_bin", "ps_ind_09_bin",
    "ps_ind_10_bin", "ps_ind_11_bin", "ps_ind_12_bin", "ps_ind_13_bin",
    "ps_car_01_cat", "ps_car_02_cat", "ps_car_03_cat", "ps_car_04_cat",
    "ps_car_05_cat", "ps_car_06_cat", "ps_car_07_cat", "ps_car_08_cat",
    "ps_car_09_cat", "ps_car_10_cat", "ps_car_11_cat",
    "ps_car_01", "ps_car_02", "ps_car_03", "ps_car_04", "ps_car_05", "ps_car_06",
    "ps_car_07", "ps_car_08", "ps_car_09", "ps_car_10", "ps_car_11", "ps_car_12",
    "ps_car_13", "ps_car_14", "ps_car_15",
    "ps_calc_01", "ps_calc_02", "ps_calc_03", "ps_calc_04", "ps_calc_05",
    "ps_calc_06", "ps_calc_07", "ps_calc_08", "ps_calc_09", "ps_calc_10",
    "ps_calc_11", "ps_calc_12", "ps_calc_13", "ps_calc_14",
)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
DEC12, DEC15 = T.DecimalType(12, 2), T.DecimalType(15, 2)

# Output contracts of the star schema; VARCHAR(n) becomes a string column.
DIM_DATE = _schema(("date_key", I), ("full_date", D), ("day_of_week", S), ("month", I),
                   ("quarter", I), ("year", I), ("is_weekend", T.BooleanType()))
DIM_POLICY = _schema(("policy_key", L), ("policy_number", S), ("policy_state", S), ("policy_csl", S),
                     ("policy_deductable", DEC12), ("policy_annual_premium", DEC12),
                     ("umbrella_limit", DEC15), ("policy_bind_date", D))
DIM_VEHICLE = _schema(("vehicle_key", L), ("auto_make", S), ("auto_model", S), ("auto_year", I))
DIM_POLICYHOLDER = _schema(("policyholder_key", L), ("policyholder_id", S), ("age", I), ("sex", S),
                           ("education_level", S), ("occupation", S), ("hobbies", S),
                           ("relationship", S), ("zip_code", S), ("valid_from", D), ("valid_to", D),
                           ("is_current", T.BooleanType()))
POLICYHOLDER_SNAPSHOT = _schema(("policyholder_id", S), ("age", I), ("sex", S), ("education_level", S),
                                ("occupation", S), ("hobbies", S), ("relationship", S),
                                ("zip_code", S), ("snapshot_date", D))
FACT_CLAIMS = _schema(("claim_key", L), ("policy_key", L), ("policyholder_key", L), ("vehicle_key", L),
                      ("incident_date_key", I), ("incident_type", S), ("collision_type", S),
                      ("incident_severity", S), ("number_of_vehicles_involved", I),
                      ("total_claim_amount", DEC15), ("injury_claim", DEC15), ("property_claim", DEC15),
                      ("vehicle_claim", DEC15), ("fraud_reported", S))

RAW_CLAIMS = _schema(("claim_id", L), ("policy_number", S), ("policyholder_id", S), ("incident_date", D),
                     ("incident_type", S), ("collision_type", S), ("incident_severity", S),
                     ("number_of_vehicles_involved", I), ("total_claim_amount", DEC15), ("injury_claim", DEC15),
                     ("property_claim", DEC15), ("vehicle_claim", DEC15), ("fraud_reported", S),
                     ("auto_make", S), ("auto_model", S), ("auto_year", I), ("policy_state", S),
                     ("policy_csl", S), ("policy_deductable", DEC12), ("policy_annual_premium", DEC12),
                     ("umbrella_limit", DEC15), ("policy_bind_date", D))

CONTRACTS: dict[str, T.StructType] = {
    "raw_claims": RAW_CLAIMS,
    "dim_date": DIM_DATE,
    "dim_policy": DIM_POLICY,
    "dim_vehicle": DIM_VEHICLE,
    "dim_policyholder": DIM_POLICYHOLDER,
    "policyholder_snapshot": POLICYHOLDER_SNAPSHOT,
    "fact_claims": FACT_CLAIMS,
}


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise, before any job runs, naming the missing columns in contract order."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns absent from the input: {missing}")


def conform(df: DataFrame, contract: str | T.StructType, *, safe: bool = False) -> DataFrame:
    """Project ``df`` onto a contract: its names, order and types (C4).

    Absent columns become typed NULLs; extra columns are dropped.  ``safe``
    uses ``try_cast`` so a dirty value becomes NULL instead of failing the
    job; ``conform_rejects`` counts such values.  One ``select``, no shuffle.
    """
    schema = CONTRACTS[contract] if isinstance(contract, str) else contract
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name)
            c = c.try_cast(f.dataType) if safe else c.cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def conform_rejects(df: DataFrame, contract: str | T.StructType) -> DataFrame:
    """One row per contract column: values present but not castable to its type."""
    schema = CONTRACTS[contract] if isinstance(contract, str) else contract
    present = [f for f in schema.fields if f.name in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, rejects long")
    counts = df.agg(*[
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
        for f in present
    ])
    stack = ", ".join(f"'{f.name}', `{f.name}`" for f in present)
    return counts.selectExpr(f"stack({len(present)}, {stack}) as (column, rejects)")


def drift_report(df: DataFrame, expected: Iterable[str] | T.StructType) -> DataFrame:
    """Compare actual columns with expected ones; never fails.

    One row per column of either side: status ``missing`` (expected,
    absent), ``new`` (present, unexpected) or ``ok``; with a ``StructType``
    contract an ``ok`` column of another type is ``type_changed``.  The
    statuses come from ``df.schema`` alone; ``non_null`` adds, for present
    columns, how many rows carry a value (one aggregate pass), so a column
    that arrives empty is visible too.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(expected, T.StructType):
        exp_types = {f.name: f.dataType for f in expected.fields}
    else:
        exp_types = {n: None for n in expected}
    rows = []
    for name in sorted(set(actual) | set(exp_types)):
        if name not in actual:
            status = "missing"
        elif name not in exp_types:
            status = "new"
        elif exp_types[name] is not None and exp_types[name] != actual[name]:
            status = "type_changed"
        else:
            status = "ok"
        rows.append((name, status, actual[name].simpleString() if name in actual else None))
    present = [n for n in sorted(actual)]
    counts = df.agg(*[F.count(F.col(f"`{n}`")).alias(n) for n in present])
    stack = ", ".join(f"'{n}', `{n}`" for n in present)
    long = counts.selectExpr(f"stack({len(present)}, {stack}) AS (column, non_null)")
    statuses = df.sparkSession.createDataFrame(rows, "column string, status string, actual_type string")
    return statuses.join(F.broadcast(long), "column", "left")
