"""Registered queries: one Spark plan and one independent DuckDB spelling each."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.operators import checks as V
from claimspark.operators import colocated as Co
from claimspark.operators import contracts as C
from claimspark.operators import dims as Dm
from claimspark.operators import facts as Fc
from claimspark.operators import notes as N
from claimspark.operators import profile as P
from claimspark.operators import quality as Q
from claimspark.operators import scd2 as H
from claimspark.operators.joins import DuplicateKeyError, key_profile, lookup_join, point_in_time_join
from claimspark.operators.keymap import KeyMap
from claimspark.operators.keys import first_by
from claimspark.plans import oracle as O
from claimspark.plans import reports as R
from claimspark.plans.star import star_for
from claimspark.session import checkpoint_dir, package_on_workers
from claimspark.sources import csv_files as Cf
from claimspark.sources import layers as Ly
from claimspark.sources import published as Pb
from claimspark.sources import stand_ins as SI
from claimspark.sources import warehouse as Wh
from claimspark.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.with_ctes(sql)
        return fn
    return deco


# ------------------------------------------------------------------ dimensions
@register("dim_date", "SELECT * FROM dim_date")
def q_dim_date(spark, sf):
    return star_for(spark, sf).dim_date


@register("dim_policy", "SELECT * FROM dim_policy")
def q_dim_policy(spark, sf):
    return star_for(spark, sf).dim_policy


@register("dim_vehicle", "SELECT * FROM dim_vehicle")
def q_dim_vehicle(spark, sf):
    return star_for(spark, sf).dim_vehicle


@register("scd2_history", "SELECT * FROM dim_policyholder")
def q_scd2_history(spark, sf):
    return star_for(spark, sf).dim_policyholder


# ------------------------------------------------------------------ facts
@register("fact_claims_inner", "SELECT * FROM fact_claims")
def q_fact_inner(spark, sf):
    return star_for(spark, sf).fact("inner")


@register("fact_claims_left", "SELECT * FROM fact_claims_left")
def q_fact_left(spark, sf):
    return star_for(spark, sf).fact("left_keys")


def _drops_sql(mode: str) -> str:
    eq = "IS NOT DISTINCT FROM" if mode == "left_keys" else "="
    strict = "TRUE" if mode == "inner" else "FALSE"
    return f"""
SELECT reason, COUNT(*) AS claims FROM (
  SELECT CASE WHEN {strict} AND NOT EXISTS (SELECT 1 FROM dim_policy p WHERE p.policy_number = CAST(r.policy_number AS VARCHAR)) THEN 'no_policy'
              WHEN {strict} AND NOT EXISTS (SELECT 1 FROM dim_vehicle v WHERE v.auto_make {eq} r.auto_make
                                            AND v.auto_model {eq} r.auto_model AND v.auto_year {eq} r.auto_year) THEN 'no_vehicle'
              WHEN NOT EXISTS (SELECT 1 FROM dim_policyholder ph WHERE ph.policyholder_id = r.policyholder_id
                               AND r.incident_date >= ph.valid_from AND (ph.valid_to IS NULL OR r.incident_date < ph.valid_to))
                   THEN 'no_holder_version'
              WHEN {strict} AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.full_date = r.incident_date) THEN 'no_date'
         END AS reason
  FROM claims r) x
WHERE reason IS NOT NULL GROUP BY reason"""


@register("fact_drops_inner", _drops_sql("inner"))
def q_fact_drops_inner(spark, sf):
    s = star_for(spark, sf)
    return Fc.drop_reasons(s.claims, s.dim_policy, s.dim_policyholder, s.dim_vehicle, s.dim_date, "inner")


@register("fact_drops_left", _drops_sql("left_keys"))
def q_fact_drops_left(spark, sf):
    s = star_for(spark, sf)
    return Fc.drop_reasons(s.claims, s.dim_policy, s.dim_policyholder, s.dim_vehicle, s.dim_date, "left_keys")


# ------------------------------------------------------------------ reports
MONEY = "DECIMAL(18,2)"


@register("r01_total", f"SELECT CAST(SUM(total_claim_amount) AS {MONEY}) AS total_claim_amount FROM fact_claims")
def q_r01(spark, sf):
    return R.r01_total(star_for(spark, sf).fact())


# Each claim is put beside its row of one dimension and grouped by that row's attributes.
MEASURES = {
    "claim_count": "COUNT(*)",
    "total_claims": "COUNT(*)",
    "total_claim_amount": f"CAST(SUM(amount) AS {MONEY})",
    "average_claim_amount": O.exact_avg("amount", 6),
    "fraudulent_claims": "CAST(COUNT(*) FILTER (WHERE fraud) AS BIGINT)",
    "fraud_claims": "CAST(COUNT(*) FILTER (WHERE fraud) AS BIGINT)",
    "fraud_rate_percent": O.exact_rate("COUNT(*) FILTER (WHERE fraud)", "COUNT(*)"),
}


def _report_sql(attributes: str, measures: str, dimension: str | None = None, key: str = "", claim_key: str = "") -> str:
    claims = "SELECT *, total_claim_amount AS amount, fraud_reported = 'Y' AS fraud FROM fact_claims"
    beside = f"(SELECT {key} AS {claim_key or key}, {attributes} FROM {dimension}) USING ({claim_key or key})"
    source = f"({claims}) JOIN {beside}" if dimension else f"({claims})"
    columns = ", ".join(f"{MEASURES[m]} AS {m}" for m in measures.split())
    return f"SELECT {attributes}, {columns} FROM {source} GROUP BY {attributes}"


@register("r02_by_state", _report_sql("policy_state", "claim_count total_claim_amount", "dim_policy", "policy_key"))
def q_r02(spark, sf):
    s = star_for(spark, sf)
    return R.r02_by_state(s.fact(), s.dim_policy)


@register("r03_fraud_by_severity", _report_sql("incident_severity", "total_claims fraudulent_claims fraud_rate_percent"))
def q_r03(spark, sf):
    return R.r03_fraud_by_severity(star_for(spark, sf).fact())


@register("r04_by_make", _report_sql(
    "auto_make", "claim_count total_claim_amount average_claim_amount", "dim_vehicle", "vehicle_key"))
def q_r04(spark, sf):
    s = star_for(spark, sf)
    return R.r04_by_make(s.fact(), s.dim_vehicle)


@register("r05_by_year", _report_sql("year", "claim_count total_claim_amount", "dim_date", "date_key", "incident_date_key"))
def q_r05(spark, sf):
    s = star_for(spark, sf)
    return R.r05_by_year(s.fact(), s.dim_date)


@register("r06_by_month", _report_sql(
    "year, month", "claim_count total_claim_amount", "dim_date", "date_key", "incident_date_key"))
def q_r06(spark, sf):
    s = star_for(spark, sf)
    return R.r06_by_month(s.fact(), s.dim_date)


@register("r07_by_education", _report_sql(
    "education_level", "claim_count total_claim_amount", "dim_policyholder", "policyholder_key"))
def q_r07(spark, sf):
    s = star_for(spark, sf)
    return R.r07_by_education(s.fact(), s.dim_policyholder)


@register("r08_by_occupation", _report_sql(
    "occupation", "claim_count average_claim_amount", "dim_policyholder", "policyholder_key"))
def q_r08(spark, sf):
    s = star_for(spark, sf)
    return R.r08_by_occupation(s.fact(), s.dim_policyholder)


@register("r09_fraud_by_make", _report_sql("auto_make", "total_claims fraudulent_claims", "dim_vehicle", "vehicle_key"))
def q_r09(spark, sf):
    s = star_for(spark, sf)
    return R.r09_fraud_by_make(s.fact(), s.dim_vehicle)


@register("r10_point_in_time", """
WITH versions AS (SELECT policyholder_key, struct_pack(policyholder_id, occupation, relationship, zip_code, valid_from, valid_to) AS holder
                  FROM dim_policyholder),
days AS (SELECT date_key AS incident_date_key, full_date AS incident_date FROM dim_date)
SELECT claim_key, incident_date, unnest(holder) FROM fact_claims JOIN versions USING (policyholder_key) JOIN days USING (incident_date_key)""")
def q_r10(spark, sf):
    s = star_for(spark, sf)
    return R.r10_point_in_time(s.fact(), s.dim_date, s.dim_policyholder)


@register("r11_fraud_by_state", _report_sql(
    "policy_state", "total_claims fraud_claims fraud_rate_percent", "dim_policy", "policy_key"))
def q_r11(spark, sf):
    s = star_for(spark, sf)
    return R.r11_fraud_by_state(s.fact(), s.dim_policy)


@register("r06_one_year", _report_sql("year, month", "claim_count total_claim_amount", "dim_date", "date_key", "incident_date_key")
          .replace(" GROUP BY", " WHERE year = 2000 GROUP BY"))
def q_r06_one_year(spark, sf):
    """One year of the monthly report from a fact by month: only that year's folders are read."""
    s, path = star_for(spark, sf), _scratch(spark, "fact-by-month")
    Fc.write_by_month(s.fact(), path)
    claims = Fc.in_period(Fc.read_by_month(spark, path), s.dim_date.select("date_key", "year", "month"), F.col("year") == 2000)
    return claims.groupBy("year", "month").agg(F.count(F.lit(1)).alias("claim_count"),
                                               F.sum("total_claim_amount").cast("decimal(18,2)").alias("total_claim_amount"))


# R12 to R14 are derived another way than the reports: a rank is one more than the number of groups
# (for a dense rank, of distinct values) that pay more, and the previous month is found by lookup.
PAID = """
SELECT (SELECT h.occupation FROM dim_policyholder h WHERE h.policyholder_key = c.policyholder_key) AS occupation,
       c.total_claim_amount AS amount, c.fraud_reported = 'Y' AS fraud FROM fact_claims c"""


@register("r12_occupation_rank", f"""
WITH paid AS ({PAID}), totals AS (
  SELECT occupation, COUNT(*) AS claims, CAST(SUM(amount) AS {MONEY}) AS total_paid,
         {O.exact_avg("amount", 2, MONEY)} AS avg_claim, CAST(COUNT(*) FILTER (WHERE fraud) AS BIGINT) AS fraud_flags
  FROM paid GROUP BY occupation)
SELECT t.*, CAST(1 + (SELECT COUNT(*) FROM totals u WHERE u.total_paid > t.total_paid) AS INTEGER) AS payout_rank
FROM totals t""")
def q_r12(spark, sf):
    s = star_for(spark, sf)
    return R.r12_occupation_rank(s.fact(), s.dim_date, s.dim_policyholder)


@register("r13_vehicle_risk", f"""
WITH cars AS (
  SELECT v.auto_make, v.auto_year, c.total_claim_amount AS amount
  FROM dim_vehicle v, fact_claims c WHERE c.vehicle_key = v.vehicle_key
), means AS (
  SELECT auto_make, auto_year, COUNT(*) AS claims, SUM(amount) / COUNT(amount) AS mean,
         {O.exact_avg("amount", 2, MONEY)} AS avg_claim
  FROM cars GROUP BY auto_make, auto_year
), risky AS (SELECT * FROM means WHERE claims >= 3)
SELECT r.auto_make, r.auto_year, r.claims, r.avg_claim,
       CAST(1 + (SELECT COUNT(DISTINCT o.mean) FROM risky o WHERE o.mean > r.mean) AS INTEGER) AS risk_rank
FROM risky r""")
def q_r13(spark, sf):
    s = star_for(spark, sf)
    return R.r13_vehicle_risk(s.fact(), s.dim_vehicle)


@register("r14_monthly_trend", f"""
WITH months AS (
  SELECT c.incident_date_key // 100 AS ym, COUNT(*) AS claims, CAST(SUM(c.total_claim_amount) AS {MONEY}) AS total_paid
  FROM fact_claims c GROUP BY ym
), ordered AS (
  SELECT m.*, (SELECT MAX(e.ym) FROM months e WHERE e.ym < m.ym) AS last_ym FROM months m)
SELECT CAST(o.ym // 100 AS INTEGER) AS year, CAST(o.ym % 100 AS INTEGER) AS month, o.claims, o.total_paid,
       p.total_paid AS prev_month, CAST(o.total_paid - p.total_paid AS {MONEY}) AS change
FROM ordered o LEFT JOIN months p ON p.ym = o.last_ym""")
def q_r14(spark, sf):
    s = star_for(spark, sf)
    return R.r14_monthly_trend(s.fact(), s.dim_date)


# ------------------------------------------------------------------ contracts


def _drift_sql() -> str:
    expected = set(C.EXPECTED_WIDE_COLUMNS)
    actual = ["id", "target", "ps_ind_01", "ps_ind_02_cat", "ps_reg_01", "ps_car_01_cat", "ps_car_11",
              "ps_calc_01", "note"]
    types = {"id": "bigint", "target": "int", "ps_ind_01": "int", "ps_ind_02_cat": "int", "ps_reg_01": "double",
             "ps_car_01_cat": "int", "ps_car_11": "bigint", "ps_calc_01": "double", "note": "string"}
    parts = []
    for name in sorted(expected | set(actual)):
        if name in actual:
            status = "ok" if name in expected else "new"
            parts.append(f"SELECT '{name}' AS column, '{status}' AS status, '{types[name]}' AS actual_type, "
                         f"COUNT({name}) AS non_null FROM wide_claims")
        else:
            parts.append(f"SELECT '{name}' AS column, 'missing' AS status, CAST(NULL AS VARCHAR) AS actual_type, "
                         f"CAST(NULL AS BIGINT) AS non_null")
    return "\nUNION ALL ".join(parts)


@register("drift_report", _drift_sql())
def q_drift(spark, sf):
    return C.drift_report(SI.wide_claims(spark, sf), C.EXPECTED_WIDE_COLUMNS)


@register("conform_claims", """
SELECT claim_id, CAST(policy_number AS VARCHAR) AS policy_number, policyholder_id, incident_date, incident_type,
       collision_type, incident_severity, number_of_vehicles_involved, total_claim_amount, injury_claim,
       property_claim, vehicle_claim, fraud_reported, auto_make, auto_model, auto_year, policy_state, policy_csl,
       CAST(NULL AS DECIMAL(12,2)) AS policy_deductable, policy_annual_premium,
       CAST(NULL AS DECIMAL(15,2)) AS umbrella_limit, CAST(NULL AS DATE) AS policy_bind_date
FROM claims""")
def q_conform(spark, sf):
    return C.conform(star_for(spark, sf).claims, "raw_claims", safe=True)


RAW_CLAIM_TYPES = {
    "claim_id": "BIGINT", "policy_number": "VARCHAR", "policyholder_id": "VARCHAR", "incident_date": "DATE",
    "incident_type": "VARCHAR", "collision_type": "VARCHAR", "incident_severity": "VARCHAR",
    "number_of_vehicles_involved": "INTEGER", "total_claim_amount": "DECIMAL(15,2)", "injury_claim": "DECIMAL(15,2)",
    "property_claim": "DECIMAL(15,2)", "vehicle_claim": "DECIMAL(15,2)", "fraud_reported": "VARCHAR",
    "auto_make": "VARCHAR", "auto_model": "VARCHAR", "auto_year": "INTEGER", "policy_state": "VARCHAR",
    "policy_csl": "VARCHAR", "policy_annual_premium": "DECIMAL(12,2)"}


def _rejects_sql(table: str = "claims") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) "
        f"AS rejects FROM {table}" for c, t in RAW_CLAIM_TYPES.items())


@register("conform_rejects", _rejects_sql())
def q_conform_rejects(spark, sf):
    """Values of the raw claims that the contract's types cannot hold (C4), per column."""
    return C.conform_rejects(star_for(spark, sf).claims, "raw_claims")


DIRTY_SQL = """(SELECT * REPLACE (
  CASE WHEN claim_id % 13 = 0 THEN 'on ' || CAST(incident_date AS VARCHAR) ELSE CAST(incident_date AS VARCHAR) END AS incident_date,
  CASE WHEN claim_id % 17 = 0 THEN 'n/a' ELSE CAST(total_claim_amount AS VARCHAR) END AS total_claim_amount,
  CASE WHEN claim_id % 19 = 0 THEN '' ELSE CAST(auto_year AS VARCHAR) END AS auto_year) FROM claims)"""


@register("conform_rejects_dirty", _rejects_sql(DIRTY_SQL))
def q_conform_rejects_dirty(spark, sf):
    """Claims as text, with dates, amounts and years that do not parse (C4's failing side)."""
    cid, text = F.col("claim_id"), lambda c: F.col(c).cast("string")
    dirty = star_for(spark, sf).claims.withColumns({
        "incident_date": F.when(cid % 13 == 0, F.concat(F.lit("on "), text("incident_date"))).otherwise(text("incident_date")),
        "total_claim_amount": F.when(cid % 17 == 0, "n/a").otherwise(text("total_claim_amount")),
        "auto_year": F.when(cid % 19 == 0, "").otherwise(text("auto_year"))})
    return C.conform_rejects(dirty, "raw_claims")


# ------------------------------------------------------------------ layers: files written and read back
def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("csv_round_trip", """
SELECT claim_id, policyholder_id, incident_date, incident_severity, total_claim_amount, auto_model FROM claims""")
def q_csv(spark, sf):
    """CSV export and contract-typed scan of it."""
    out = star_for(spark, sf).claims.select("claim_id", "policyholder_id", "incident_date", "incident_severity",
                                            "total_claim_amount", "auto_model")
    path = _scratch(spark, "csv")
    Ly.write_csv(out, path)
    return Ly.read_csv(spark, path, out.schema)


@register("csv_drift", """
SELECT * FROM (VALUES ('id', 'ok', 'int'), ('target', 'ok', 'int'), ('note', 'new', 'string'), ('ps_ind_03', 'missing', NULL))
  v("column", status, actual_type),
LATERAL (SELECT CASE v.column WHEN 'id' THEN COUNT(id) WHEN 'target' THEN COUNT(target) WHEN 'note' THEN COUNT(note) END
         AS non_null FROM wide_claims) n""")
def q_csv_drift(spark, sf):
    """A CSV scan with inferred types and its drift report."""
    path = _scratch(spark, "csv")
    Ly.write_csv(SI.wide_claims(spark, sf).select("id", "target", "note"), path)
    return Ly.load_with_drift_check(spark, path, ["id", "target", "ps_ind_03"])[1]


def _supplier_note(claim_type: str = "incident_type", model: str = "auto_model"):
    return F.concat(F.lit('said "'), claim_type, F.lit('", of a\n'), model)


def _supplier_files(spark, sf) -> str:
    """Claims as three suppliers send them: columns in another order, one lacking, one new; quotes and line breaks."""
    claims = star_for(spark, sf).claims.withColumn("note", _supplier_note())
    part, path = F.col("claim_id") % 3, _scratch(spark, "suppliers")
    Ly.write_csv(claims.where(part == 0).select("claim_id", "policyholder_id", "incident_date", "total_claim_amount", "note"), f"{path}/a")
    Ly.write_csv(claims.where(part == 1).select("note", "total_claim_amount", "claim_id", "policyholder_id"), f"{path}/b")
    Ly.write_csv(claims.where(part == 2).select("policyholder_id", F.col("incident_severity").alias("severity"), "note", "incident_date",
                                                "total_claim_amount", "claim_id"), f"{path}/c")
    return path


def _supplied(*names: str) -> T.StructType:
    """Fields of the raw claims' contract; other names are text."""
    types = {f.name: f.dataType for f in C.RAW_CLAIMS.fields}
    return T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])


SUPPLIED = _supplied("claim_id", "policyholder_id", "incident_date", "total_claim_amount", "note")


@register("csv_by_name", """
SELECT claim_id, policyholder_id, CASE WHEN claim_id % 3 <> 1 THEN incident_date END AS incident_date, total_claim_amount,
       'said "' || incident_type || '", of a' || chr(10) || auto_model AS note,
       CASE WHEN claim_id % 3 = 2 THEN incident_severity END AS severity
FROM claims""")
def q_csv_by_name(spark, sf):
    """A folder of files with shuffled, missing and new columns, read by name."""
    return Cf.rows(spark, _supplier_files(spark, sf), SUPPLIED).drop(Cf.FILE, Cf.RAW, Cf.REASONS)


@register("csv_drift_by_file", """
WITH sent AS (SELECT *, 'abc'[CAST(claim_id % 3 AS INTEGER) + 1] AS supplier FROM claims)
SELECT supplier, c.column, CASE WHEN c.pos < 0 THEN 'missing' WHEN c.column = 'severity' THEN 'new' ELSE 'ok' END AS status,
       CASE WHEN c.pos >= 0 THEN c.pos END AS place,
       CASE WHEN c.pos >= 0 THEN SUM(CASE c.column WHEN 'total_claim_amount' THEN (total_claim_amount IS NOT NULL)::INTEGER
         WHEN 'severity' THEN (incident_severity IS NOT NULL)::INTEGER
         WHEN 'note' THEN (incident_type IS NOT NULL AND auto_model IS NOT NULL)::INTEGER ELSE 1 END)::BIGINT END AS non_null
FROM sent JOIN (VALUES ('a', 'claim_id', 0), ('a', 'policyholder_id', 1), ('a', 'incident_date', 2), ('a', 'total_claim_amount', 3),
  ('a', 'note', 4), ('b', 'note', 0), ('b', 'total_claim_amount', 1), ('b', 'claim_id', 2), ('b', 'policyholder_id', 3),
  ('b', 'incident_date', -1), ('c', 'policyholder_id', 0), ('c', 'severity', 1), ('c', 'note', 2), ('c', 'incident_date', 3),
  ('c', 'total_claim_amount', 4), ('c', 'claim_id', 5)) c(supplier, "column", pos) USING (supplier)
GROUP BY supplier, c.column, c.pos""")
def q_csv_drift_by_file(spark, sf):
    """Drift of every file of that folder, its files added up by supplier."""
    path = _supplier_files(spark, sf)
    found = Cf.layouts(spark, path)
    report = Cf.drift(spark, found, SUPPLIED.names, Cf.rows(spark, path, SUPPLIED, found=found))
    supplier = F.regexp_extract("file", "/([abc])/[^/]*$", 1).alias("supplier")
    return report.groupBy(supplier, "column", "status", "place").agg(F.sum("non_null").alias("non_null"))


LEDGER = _supplied("claim_id", "incident_date", "total_claim_amount", "policyholder_id")
LEDGER_LINE = """
  CASE WHEN claim_id % 31 = 0 THEN 'no ' ELSE '' END || CAST(claim_id AS VARCHAR) || ',' ||
  CASE WHEN claim_id % 13 = 0 THEN 'on ' ELSE '' END || CAST(incident_date AS VARCHAR) || ',' ||
  CASE WHEN claim_id % 17 = 0 THEN 'n/a' ELSE COALESCE(CAST(total_claim_amount AS VARCHAR), '') END ||
  CASE WHEN claim_id % 23 = 0 THEN '' ELSE ',' || policyholder_id END || CASE WHEN claim_id % 29 = 0 THEN ',more' ELSE '' END"""


@register("csv_quarantine", f"""
WITH lines AS (
  SELECT claim_id AS id, incident_date AS day, total_claim_amount AS amount, policyholder_id, {LEDGER_LINE} AS line,
         (claim_id % 23 = 0) <> (claim_id % 29 = 0) AS torn FROM claims
), judged AS (
  SELECT *, CASE WHEN torn THEN '*: wrong number of fields' ELSE concat_ws('; ',
    CASE WHEN id % 31 = 0 THEN 'claim_id: not bigint' END, CASE WHEN id % 13 = 0 THEN 'incident_date: not date' END,
    CASE WHEN id % 17 = 0 THEN 'total_claim_amount: not decimal(15,2)' END) END AS reasons FROM lines
)
SELECT CASE WHEN reasons = '' THEN id END AS claim_id, CASE WHEN reasons = '' THEN day END AS incident_date,
       CASE WHEN reasons = '' THEN amount END AS total_claim_amount,
       CASE WHEN reasons = '' THEN CASE WHEN id % 23 = 0 THEN 'more' ELSE policyholder_id END END AS policyholder_id,
       CASE WHEN reasons <> '' THEN line END AS raw, NULLIF(reasons, '') AS reasons
FROM judged""")
def q_csv_quarantine(spark, sf):
    """Claims with values of other kinds and torn lines: good rows typed, bad rows with their text and reasons.

    One write parts them; each input row is in one of the two parts.
    """
    text = lambda c: F.col(c).cast("string")
    bad = lambda n, yes, no: F.when(F.col("claim_id") % n == 0, yes).otherwise(no)
    line = F.concat(bad(31, F.lit("no "), F.lit("")), text("claim_id"), F.lit(","), bad(13, F.lit("on "), F.lit("")), text("incident_date"),
                    F.lit(","), bad(17, F.lit("n/a"), F.coalesce(text("total_claim_amount"), F.lit(""))),
                    bad(23, F.lit(""), F.concat(F.lit(","), "policyholder_id")), bad(29, F.lit(",more"), F.lit("")))
    path = _scratch(spark, "ledger")
    # One column named like the header, written without quoting: the lines as they are.
    star_for(spark, sf).claims.select(line.alias(",".join(LEDGER.names))) \
        .write.option("header", True).option("sep", "|").option("quote", "").csv(f"{path}/in")
    good, rejects = Cf.split(Cf.rows(spark, f"{path}/in", LEDGER), f"{path}/out")
    reasons = F.array_join(F.transform("reasons", lambda r: F.concat(F.coalesce(r["column"], F.lit("*")), F.lit(": "), r["reason"])), "; ")
    return good.withColumns({"raw": F.lit(None).cast("string"), "reasons": F.lit(None).cast("string")}).unionByName(
        rejects.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in LEDGER.fields], "raw", reasons.alias("reasons")))


@register("partitioned_round_trip", "SELECT risk_bucket, COUNT(*) AS n, SUM(id) AS ids FROM risk_bucket GROUP BY risk_bucket")
def q_partitioned(spark, sf):
    """Parquet by risk bucket in a layer's folder, read back by folder."""
    path = Ly.Layers(_scratch(spark, "layers")).path("silver", "wide_claims")
    clean = Q.clean_wide(SI.wide_claims(spark, sf))
    Ly.write_partitioned(clean, path, "risk_bucket")
    back = spark.read.schema(clean.schema).parquet(path)
    return back.groupBy("risk_bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("id").cast("decimal(38,0)").alias("ids"))


@register("view_and_table", """
SELECT 'view' AS kind, COUNT(*) AS n, CAST(SUM(total_claim_amount) AS DECIMAL(25,2)) AS amount FROM claims WHERE total_claim_amount IS NOT NULL
UNION ALL SELECT 'table', COUNT(*), CAST(SUM(total_claim_amount) AS DECIMAL(25,2)) FROM claims WHERE total_claim_amount IS NOT NULL""")
def q_view_and_table(spark, sf):
    """The staging model as a view and as a written table."""
    staged = Fc.stage_claims(star_for(spark, sf).claims)
    made = {"view": Ly.materialize(staged, "stg_claims_view", "view"),
            "table": Ly.materialize(staged, "stg_claims_table", "table", _scratch(spark, "stg"))}
    each = [df.agg(F.lit(k).alias("kind"), F.count(F.lit(1)).alias("n"),
                   F.sum("total_claim_amount").cast("decimal(25,2)").alias("amount")) for k, df in made.items()]
    return each[0].unionByName(each[1])


# ------------------------------------------------------------------ quality
@register("sentinel_clean", "SELECT * FROM sentinel_clean")
def q_sentinel(spark, sf):
    return Q.replace_sentinel_with_null(SI.wide_claims(spark, sf))


@register("null_density", "SELECT * FROM null_density")
def q_null_density(spark, sf):
    cleaned = Q.replace_sentinel_with_null(SI.wide_claims(spark, sf))
    return Q.add_null_density(cleaned, Q.completeness_columns(cleaned))


@register("risk_bucket", "SELECT * FROM risk_bucket")
def q_risk_bucket(spark, sf):
    return Q.clean_wide(SI.wide_claims(spark, sf))


@register("bucket_distribution", "SELECT risk_bucket, COUNT(*) AS count FROM risk_bucket GROUP BY risk_bucket")
def q_bucket_distribution(spark, sf):
    return Q.bucket_distribution(Q.clean_wide(SI.wide_claims(spark, sf)))


@register("bucket_count", """
SELECT COUNT(*) AS buckets, (SELECT COUNT(*) FROM wide_claims) AS input_rows
FROM (SELECT risk_bucket FROM risk_bucket GROUP BY risk_bucket)""")
def q_bucket_count(spark, sf):
    """Distinct buckets, and the input rows observed during that same pass (Q7, Q9)."""
    seen, rows = Q.with_row_count(SI.wide_claims(spark, sf))
    n = Q.bucket_count(Q.clean_wide(seen))
    return spark.createDataFrame([(n, rows.get["input_rows"])], "buckets long, input_rows long")


# ------------------------------------------------------------------ profiling
# The group of each stand-in column.
WIDE_GROUPS = {"id": None, "target": None, "ps_ind_01": "ind", "ps_ind_02_cat": "ind", "ps_reg_01": "reg",
               "ps_car_01_cat": "car", "ps_car_11": "car", "ps_calc_01": "calc", "note": "other"}


WIDE_TYPES = {"id": "bigint", "target": "int", "ps_ind_01": "int", "ps_ind_02_cat": "int", "ps_reg_01": "double",
              "ps_car_01_cat": "int", "ps_car_11": "bigint", "ps_calc_01": "double", "note": "string"}


def _column_values_sql() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, {f"'{g}'" if g else 'CAST(NULL AS VARCHAR)'} AS \"group\", '{WIDE_TYPES[c]}' AS type, "
        f"COUNT(*) - COUNT({c}) AS null_count, COUNT(DISTINCT {c}) AS distinct_values FROM sentinel_clean"
        for c, g in WIDE_GROUPS.items())


@register("column_groups", _column_values_sql())
def q_column_groups(spark, sf):
    """Group, type, missing and distinct values of every column of the cleaned wide file."""
    return P.column_values(Q.replace_sentinel_with_null(SI.wide_claims(spark, sf)))


@register("group_sizes", f"""SELECT "group", COUNT(*) AS columns, CAST(SUM(null_count) AS BIGINT) AS null_count,
  CAST(SUM(distinct_values) AS BIGINT) AS distinct_values
FROM ({_column_values_sql()}) WHERE "group" IS NOT NULL GROUP BY "group\"""")
def q_group_sizes(spark, sf):
    """The same added up by group."""
    return P.group_values(Q.replace_sentinel_with_null(SI.wide_claims(spark, sf)))


@register("persisted_reuse", """
SELECT 'buckets' AS result, risk_bucket AS name, COUNT(*) AS n FROM risk_bucket GROUP BY risk_bucket
UNION ALL SELECT 'targets', CAST(target AS VARCHAR), COUNT(*) FROM risk_bucket GROUP BY target""")
def q_persisted_reuse(spark, sf):
    """Two results of one persisted plan, released after both are written (Q8)."""
    def by(column: str):
        return lambda df: df.groupBy(F.col(column).cast("string").alias("name")).agg(F.count(F.lit(1)).alias("n"))

    made = Q.reusing(Q.clean_wide(SI.wide_claims(spark, sf)), {"buckets": by("risk_bucket"), "targets": by("target")}, _scratch(spark, "reuse"))
    each = [df.select(F.lit(k).alias("result"), "name", "n") for k, df in made.items()]
    return each[0].unionByName(each[1])


def _profile_sql(threshold: float | None = None) -> str:
    parts = []
    for c, g in WIDE_GROUPS.items():
        gsql = f"'{g}'" if g else "CAST(NULL AS VARCHAR)"
        nulls = f"COUNT(*) FILTER (WHERE {c} IS NULL)"
        parts.append(f"SELECT '{c}' AS column, {gsql} AS \"group\", {nulls} AS null_count, COUNT(*) AS rows, "
                     f"{O.exact_bround(nulls, 'COUNT(*)', 100, 2, 'DECIMAL(7,2)')} AS null_pct FROM sentinel_clean")
    sql = "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") p"
    if threshold is not None:
        sql += f" WHERE null_pct > {threshold}"
    return sql


def _profiled(spark, sf):
    cleaned = Q.replace_sentinel_with_null(SI.wide_claims(spark, sf))
    groups = P.classify_columns(spark, cleaned)
    return P.null_profile(cleaned).join(F.broadcast(groups), "column", "left").select(
        "column", "group", "null_count", "rows", "null_pct")


@register("column_profile", _profile_sql())
def q_column_profile(spark, sf):
    return _profiled(spark, sf)


@register("high_null_columns", _profile_sql(20))
def q_high_null(spark, sf):
    return P.high_null_columns(_profiled(spark, sf))


def _imbalance_sql(table: str, col: str) -> str:
    pos = f"COUNT(*) FILTER (WHERE {col} = 1)"
    neg = f"COUNT(*) FILTER (WHERE {col} = 0)"
    return f"""
SELECT COUNT(*) AS total_rows, {pos} AS positive_count, {neg} AS negative_count,
       {O.exact_bround(pos, 'COUNT(*)', 100, 3, 'DECIMAL(10,3)')} AS positive_rate_pct,
       {O.exact_bround(neg, f'GREATEST({pos}, 1)', 1, 1, 'DECIMAL(21,1)')} AS imbalance_ratio
FROM {table}"""


@register("imbalance", _imbalance_sql("wide_claims", "target"))
def q_imbalance(spark, sf):
    return P.imbalance_report(SI.wide_claims(spark, sf), "target")


@register("imbalance_labels", _imbalance_sql("labels", "toxic"))
def q_imbalance_labels(spark, sf):
    return P.imbalance_report(read_table(spark, sf, "labels"), "toxic")


def _inventory_sql() -> str:
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    tokens = "'', 'NA', 'N/A', 'null'"
    parts = []
    for i, c in enumerate(cols, 1):
        txt = f"replace(CAST({c} AS VARCHAR), '\"', '')"
        parts.append(
            f"SELECT {i} AS ordinal, '{c}' AS column, "
            f"(SELECT string_agg(COALESCE({txt}, ''), '|' ORDER BY c_custkey) FROM "
            f"(SELECT * FROM customer ORDER BY c_custkey LIMIT 5)) AS samples, "
            f"(SELECT COUNT(*) FILTER (WHERE {c} IS NULL OR trim({txt}) IN ({tokens})) FROM customer) AS null_tokens")
    return "\nUNION ALL ".join(parts)


@register("column_inventory", _inventory_sql())
def q_inventory(spark, sf):
    return P.column_inventory(read_table(spark, sf, "customer"), ["c_custkey"])


# ------------------------------------------------------------------ holder base and snapshots
@register("holder_base", "SELECT * FROM holder_base")
def q_holder_base(spark, sf):
    return Dm.create_policyholder_base(SI.holder_claims(spark, sf), sample_size=None, order=("claim_id",))


@register("holder_sample", "SELECT * FROM holder_base ORDER BY CAST(policyholder_id AS BIGINT) LIMIT 30")
def q_holder_sample(spark, sf):
    """The modelled pipeline's sample of 30 holders, by policy number."""
    return Dm.create_policyholder_base(SI.holder_claims(spark, sf), sample_size=30, order=("policy_number", "claim_id"))


@register("holder_snapshot_changed", """
WITH last AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY policyholder_id ORDER BY snapshot_date DESC) AS rn
                 FROM holder_snapshots) WHERE rn = 1)
SELECT b.policyholder_id, b.age, b.sex, b.education_level,
       CASE WHEN l.policyholder_id IS NULL THEN b.occupation ELSE l.occupation END AS occupation,
       b.hobbies,
       CASE WHEN l.policyholder_id IS NULL THEN b.relationship ELSE l.relationship END AS relationship,
       CASE WHEN l.policyholder_id IS NULL THEN b.zip_code ELSE l.zip_code END AS zip_code,
       DATE '2002-01-01' AS snapshot_date
FROM holder_base b LEFT JOIN last l ON b.policyholder_id = l.policyholder_id""")
def q_holder_snapshot_changed(spark, sf):
    """Base holders re-dated, with the tracked values of each holder's latest
    quarterly snapshot applied as a change table (D8)."""
    base = Dm.create_policyholder_base(SI.holder_claims(spark, sf), sample_size=None, order=("claim_id",))
    snaps = star_for(spark, sf).holder_snapshots
    last = _latest(snaps)
    return Dm.create_snapshot(base, "2002-01-01", last.select("policyholder_id", *H.TRACKED_COLUMNS))


def _latest(snaps):
    return first_by(snaps, ["policyholder_id"], ["snapshot_date"], last=True)


# ------------------------------------------------------------------ type-2 history variants
@register("scd2_history_null_as_empty", "SELECT * FROM dim_policyholder_nae")
def q_scd2_nae(spark, sf):
    return H.build_history(star_for(spark, sf).holder_snapshots, mode="null_as_empty")


@register("scd2_apply", "SELECT * FROM dim_policyholder_nae")
def q_scd2_apply(spark, sf):
    """History of the snapshots before 2001 written to an append-only history
    store, then all later snapshots applied to it in one pass; the newest
    version must equal the batch history (same mode)."""
    snaps = star_for(spark, sf).holder_snapshots
    cut = F.lit("2001-01-01").cast("date")
    store = H.HistoryStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/history-{uuid.uuid4().hex}")
    store.create(H.build_history(snaps.where(F.col("snapshot_date") < cut), mode="null_as_empty"))
    store.apply(None, snaps.where(F.col("snapshot_date") >= cut))
    return store.read()


@register("scd2_retention", "SELECT * FROM dim_policyholder_nae")
def q_scd2_retention(spark, sf):
    """Two applies, a part that was written but never published, then retention of the newest version alone:
    readers still see the whole history (H6, S6)."""
    snaps = star_for(spark, sf).holder_snapshots
    day = F.col("snapshot_date")
    store = H.HistoryStore(spark, _scratch(spark, "history"))
    store.create(H.build_history(snaps.where(day < "2000-01-01"), mode="null_as_empty"))
    store.apply(None, snaps.where((day >= "2000-01-01") & (day < "2001-07-01")))
    store.apply(None, snaps.where(day >= "2001-07-01"))
    store.current().write.partitionBy("is_current").parquet(store.log.part_path(store.log.new_part()))
    store.expire(keep=1, orphan_age=0)
    return store.read()


@register("scd2_versions", """
SELECT policyholder_id, COUNT(*) AS version_count FROM dim_policyholder GROUP BY policyholder_id""")
def q_scd2_versions(spark, sf):
    return H.version_counts(star_for(spark, sf).dim_policyholder)


@register("scd2_version_distribution", """
SELECT version_count, COUNT(*) AS holders
FROM (SELECT policyholder_id, COUNT(*) AS version_count FROM dim_policyholder GROUP BY policyholder_id)
GROUP BY version_count""")
def q_scd2_distribution(spark, sf):
    return H.version_distribution(star_for(spark, sf).dim_policyholder)


@register("scd2_single_current", """
SELECT policyholder_id, COUNT(*) AS current_version_count FROM dim_policyholder
WHERE is_current GROUP BY policyholder_id HAVING COUNT(*) > 1""")
def q_scd2_single_current(spark, sf):
    return H.multiple_current(star_for(spark, sf).dim_policyholder)


ORACLE_PIT = """
SELECT r.claim_id, r.policyholder_id, r.incident_date, ph.policyholder_key, ph.valid_from, ph.valid_to
FROM claims r JOIN dim_policyholder ph ON r.policyholder_id = ph.policyholder_id
 AND r.incident_date >= ph.valid_from AND (r.incident_date < ph.valid_to OR ph.valid_to IS NULL)"""


@register("pit_lookup", ORACLE_PIT)
def q_pit(spark, sf):
    s = star_for(spark, sf)
    holder = s.dim_policyholder.select("policyholder_key", F.col("policyholder_id").alias("_hid"),
                                       "valid_from", "valid_to")
    fact = s.claims.select("claim_id", "policyholder_id", "incident_date")
    return point_in_time_join(fact, holder, "policyholder_id", "_hid", "incident_date").select(
        "claim_id", "policyholder_id", "incident_date", "policyholder_key", "valid_from", "valid_to")


STAR_DIMENSIONS = [("dim_policyholder", "policyholder_key", "policyholder_key", ["sex"]),
                   ("dim_policy", "policy_key", "policy_key", ["policy_state"]),
                   ("dim_vehicle", "vehicle_key", "vehicle_key", ["auto_make"]),
                   ("dim_date", "incident_date_key", "date_key", ["year"])]


def _saved_star(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The inner fact and its dimensions as catalog tables with statistics of keys and attributes."""
    s, root, run = star_for(spark, sf), _scratch(spark, "warehouse"), uuid.uuid4().hex
    tables = [("fact", s.fact(), [fact_key for _, fact_key, _, _ in STAR_DIMENSIONS]),
              *[(name, getattr(s, name), [key, *attributes]) for name, _, key, attributes in STAR_DIMENSIONS]]
    return [Wh.save(df, f"{name}_{run}", f"{root}/{name}", columns) for name, df, columns in tables]


@register("star_by_statistics", f"""
SELECT sex, policy_state, auto_make, year, COUNT(*) AS claim_count, CAST(SUM(total_claim_amount) AS {MONEY}) AS total_claim_amount
FROM fact_claims NATURAL JOIN (SELECT policyholder_key, sex FROM dim_policyholder)
NATURAL JOIN (SELECT policy_key, policy_state FROM dim_policy) NATURAL JOIN (SELECT vehicle_key, auto_make FROM dim_vehicle)
NATURAL JOIN (SELECT date_key AS incident_date_key, year FROM dim_date)
WHERE year = 2000 GROUP BY ALL""")
def q_star_by_statistics(spark, sf):
    """A year's claims by attributes of four dimensions, over catalog tables joined in the order of their statistics (S3)."""
    fact, *dims = _saved_star(spark, sf)
    totals = R.star_totals(fact, [(d, *of[1:]) for d, of in zip(dims, STAR_DIMENSIONS, strict=True)], F.col("year") == 2000)
    with Wh.cost_based(spark):
        return Ly.materialize(totals, "star_totals", "table", _scratch(spark, "star-totals"))


@register("pit_lookup_colocated", ORACLE_PIT)
def q_pit_colocated(spark, sf):
    """The same over facts and history in buckets of the holder, joined without a shuffle."""
    s = star_for(spark, sf)
    facts = s.claims.select("claim_id", "policyholder_id", "incident_date")
    history = s.dim_policyholder.select("policyholder_key", F.col("policyholder_id").alias("_hid"), "valid_from", "valid_to")
    layout = Co.lay_out(facts, history, "policyholder_id", "_hid", _scratch(spark, "colocated"), buckets=8)
    return Co.join(spark, layout, "incident_date").select(
        "claim_id", "policyholder_id", "incident_date", "policyholder_key", "valid_from", "valid_to")


# ------------------------------------------------------------------ staging and flat mart
@register("stg_claims", """
SELECT policy_number, incident_date, incident_type, collision_type, incident_severity, total_claim_amount,
       injury_claim, property_claim, vehicle_claim, fraud_reported
FROM claims WHERE total_claim_amount IS NOT NULL""")
def q_stg(spark, sf):
    return Fc.stage_claims(star_for(spark, sf).claims)


@register("dim_policy_reload", """
WITH early AS (SELECT DISTINCT policy_number FROM claims WHERE claim_id % 3 <> 0),
late AS (SELECT DISTINCT policy_number FROM claims WHERE claim_id % 5 <> 0),
old AS (SELECT policy_number, row_number() OVER (ORDER BY policy_number) AS policy_key FROM early),
new AS (SELECT policy_number, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY policy_number) AS policy_key
        FROM late WHERE policy_number NOT IN (SELECT policy_number FROM early))
SELECT CAST(policy_number AS VARCHAR) AS policy_number, CAST(policy_key AS BIGINT) AS policy_key,
       policy_number IN (SELECT policy_number FROM late) AS in_reload
FROM (SELECT * FROM old UNION ALL SELECT * FROM new)""")
def q_dim_policy_reload(spark, sf):
    """Two loads of policies, the second with lost and new ones: keys of the first stay."""
    claims = star_for(spark, sf).claims
    natural = T.StructType([f for f in claims.schema.fields if f.name == "policy_number"])
    keys = KeyMap(spark, _scratch(spark, "policy-keys"), natural, "policy_key")
    Dm.build_dim_policy(claims.where("claim_id % 3 <> 0"), keys=keys)
    second = Dm.build_dim_policy(claims.where("claim_id % 5 <> 0"), keys=keys).select("policy_number", F.lit(True).alias("in_reload"))
    known = keys.read().withColumn("policy_number", F.col("policy_number").cast("string"))
    return known.join(second, "policy_number", "left").withColumn("in_reload", F.coalesce("in_reload", F.lit(False)))


@register("claims_flat", """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY incident_date, claim_id) AS BIGINT) AS claim_key, policy_number,
       incident_date, incident_type, total_claim_amount, injury_claim, property_claim, vehicle_claim, fraud_reported
FROM claims WHERE total_claim_amount IS NOT NULL""")
def q_flat(spark, sf):
    # The star's claims are a written table: a second scan of some columns is less than another copy.
    return Fc.claims_flat(Fc.stage_claims(star_for(spark, sf).claims, keep=("claim_id",)), evaluated=True)


@register("claims_flat_ranged", """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY incident_date, claim_id) AS BIGINT) AS claim_key, policy_number,
       incident_date, incident_type, total_claim_amount, injury_claim, property_claim, vehicle_claim, fraud_reported
FROM claims WHERE total_claim_amount IS NOT NULL""")
def q_flat_ranged(spark, sf):
    """The flat mart numbered over many more ranges than the shuffle setting asks for."""
    return Fc.claims_flat(Fc.stage_claims(star_for(spark, sf).claims, keep=("claim_id",)), ranges=61)


# ------------------------------------------------------------------ data-quality checks
def _check_sql(check: str, target: str, failures_sql: str) -> str:
    return (f"SELECT '{check}' AS \"check\", '{target}' AS target, CAST(({failures_sql}) AS BIGINT) AS failures, "
            f"({failures_sql}) = 0 AS passed")


FLAT_CTE = """(SELECT ROW_NUMBER() OVER (ORDER BY incident_date, claim_id) AS claim_key, total_claim_amount
               FROM claims WHERE total_claim_amount IS NOT NULL)"""


@register("dq_report", "\nUNION ALL ".join([
    _check_sql("unique", "claims_flat.claim_key",
               f"SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM {FLAT_CTE} WHERE claim_key IS NOT NULL "
               "GROUP BY claim_key HAVING COUNT(*) > 1)"),
    _check_sql("not_null", "claims_flat.claim_key", f"SELECT COUNT(*) FROM {FLAT_CTE} WHERE claim_key IS NULL"),
    _check_sql("not_null", "claims_flat.total_claim_amount",
               f"SELECT COUNT(*) FROM {FLAT_CTE} WHERE total_claim_amount IS NULL"),
    _check_sql("unique", "fact_claims.claim_key",
               "SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM fact_claims WHERE claim_key IS NOT NULL "
               "GROUP BY claim_key HAVING COUNT(*) > 1)"),
    _check_sql("single_current", "dim_policyholder.policyholder_id",
               "SELECT COUNT(*) FROM (SELECT policyholder_id FROM dim_policyholder WHERE is_current "
               "GROUP BY policyholder_id HAVING COUNT(*) > 1)"),
]))
def q_dq(spark, sf):
    s = star_for(spark, sf)
    return V.report([
        V.audit(q_flat(spark, sf), "claims_flat", unique=[["claim_key"]], not_null=["claim_key", "total_claim_amount"]),
        V.audit(s.fact(), "fact_claims", unique=[["claim_key"]]),
        V.audit(s.dim_policyholder, "dim_policyholder", single_current="policyholder_id"),
    ])


FKS = (("policy_key", "dim_policy", "policy_key"), ("policyholder_key", "dim_policyholder", "policyholder_key"),
       ("vehicle_key", "dim_vehicle", "vehicle_key"), ("incident_date_key", "dim_date", "date_key"))


@register("null_fk_report", "\nUNION ALL ".join(
    _check_sql("not_null", f"fact_claims_left.{fk}", f"SELECT COUNT(*) FROM fact_claims_left WHERE {fk} IS NULL")
    for fk, _, _ in FKS))
def q_null_fk(spark, sf):
    return V.not_null(star_for(spark, sf).fact("left_keys"), [fk for fk, _, _ in FKS], "fact_claims_left")


@register("orphan_fk_report", "\nUNION ALL ".join(
    _check_sql("relationships", f"fact_claims_left.{fk}",
               f"SELECT COUNT(*) FROM fact_claims_left f WHERE f.{fk} IS NOT NULL AND NOT EXISTS "
               f"(SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})")
    for fk, dim, pk in FKS))
def q_orphan_fk(spark, sf):
    s = star_for(spark, sf)
    return V.audit(s.fact("left_keys"), "fact_claims_left", references=[(fk, getattr(s, d), pk) for fk, d, pk in FKS])


def _dim_check_sql(dim: str, key: str) -> list[str]:
    return [_check_sql("unique", f"{dim}.{key}", f"SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM {dim} "
                       f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1)"),
            _check_sql("not_null", f"{dim}.{key}", f"SELECT COUNT(*) FROM {dim} WHERE {key} IS NULL")]


DIM_KEYS = {"dim_date": "date_key", "dim_policy": "policy_key", "dim_vehicle": "vehicle_key",
            "dim_policyholder": "policyholder_key"}


@register("dim_checks", "\nUNION ALL ".join(q for d, k in DIM_KEYS.items() for q in _dim_check_sql(d, k)))
def q_dim_checks(spark, sf):
    """Primary keys of the dimensions are unique and present (V5)."""
    s = star_for(spark, sf)
    return V.report([V.audit(getattr(s, d), d, unique=[[k]], not_null=[k]) for d, k in DIM_KEYS.items()])


BROKEN_FACT = """(SELECT claim_key, CASE WHEN claim_key % 5 = 0 THEN NULL ELSE policy_key END AS policy_key,
                  CASE WHEN claim_key % 7 = 0 THEN -policyholder_key ELSE policyholder_key END AS policyholder_key FROM fact_claims
                  UNION ALL SELECT claim_key, policy_key, policyholder_key FROM fact_claims WHERE claim_key % 11 = 0)"""
BROKEN_HOLDERS = "(SELECT policyholder_id, is_current OR policyholder_key % 3 = 0 AS is_current FROM dim_policyholder)"


@register("dq_report_damaged", "\nUNION ALL ".join([
    _check_sql("unique", "fact.claim_key", f"SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM {BROKEN_FACT} "
               "GROUP BY claim_key HAVING COUNT(*) > 1)"),
    _check_sql("not_null", "fact.claim_key", f"SELECT COUNT(*) FROM {BROKEN_FACT} WHERE claim_key IS NULL"),
    _check_sql("not_null", "fact.policy_key", f"SELECT COUNT(*) FROM {BROKEN_FACT} WHERE policy_key IS NULL"),
    _check_sql("relationships", "fact.policy_key", f"SELECT COUNT(*) FROM {BROKEN_FACT} b WHERE b.policy_key IS NOT NULL "
               "AND b.policy_key NOT IN (SELECT policy_key FROM dim_policy)"),
    _check_sql("relationships", "fact.policyholder_key", f"SELECT COUNT(*) FROM {BROKEN_FACT} b WHERE "
               "b.policyholder_key IS NOT NULL AND b.policyholder_key NOT IN (SELECT policyholder_key FROM dim_policyholder)"),
    _check_sql("single_current", "dim_policyholder.policyholder_id", f"SELECT COUNT(*) FROM (SELECT policyholder_id "
               f"FROM {BROKEN_HOLDERS} WHERE is_current GROUP BY policyholder_id HAVING COUNT(*) > 1)"),
]))
def q_dq_damaged(spark, sf):
    """The checks over a damaged star: repeated claims, lost and dangling keys, holders with two open versions."""
    s = star_for(spark, sf)
    fact = s.fact().select("claim_key", "policy_key", "policyholder_key")
    key = F.col("claim_key")
    broken = fact.withColumns({
        "policy_key": F.when(key % 5 != 0, F.col("policy_key")),
        "policyholder_key": F.when(key % 7 == 0, -F.col("policyholder_key")).otherwise(F.col("policyholder_key")),
    }).unionByName(fact.where(key % 11 == 0))
    holders = s.dim_policyholder.withColumn("is_current", F.col("is_current") | (F.col("policyholder_key") % 3 == 0))
    return V.report([
        V.audit(broken, "fact", unique=[["claim_key"]], not_null=["claim_key", "policy_key"],
                references=[("policy_key", s.dim_policy, "policy_key"), ("policyholder_key", s.dim_policyholder, "policyholder_key")]),
        V.audit(holders, "dim_policyholder", single_current="policyholder_id")])


@register("run_then_test", """
SELECT 'whole' AS star, 0 AS failed UNION ALL
SELECT 'damaged', CAST((SELECT COUNT(*) > 0 FROM fact_claims WHERE claim_key % 5 = 0) AS INTEGER)""")
def q_run_then_test(spark, sf):
    """Building and then testing raises on a damaged table only (V8)."""
    fact = star_for(spark, sf).fact().select("claim_key", "policy_key")
    out = []
    for name, df in (("whole", fact), ("damaged", fact.withColumn("policy_key", F.when(F.col("claim_key") % 5 != 0, F.col("policy_key"))))):
        try:
            V.run_checks([V.not_null(df, ["policy_key"], "fact")])
            out.append((name, 0))
        except V.CheckFailed:
            out.append((name, 1))
    return spark.createDataFrame(out, "star string, failed int")


@register("publish_audited", """
SELECT CAST(1 AS BIGINT) AS version, 'unique' AS refused, COUNT(*) AS "rows", CAST(SUM(total_claim_amount) AS DECIMAL(25,2)) AS amount
FROM fact_claims""")
def q_publish_audited(spark, sf):
    """The fact published twice; a third, damaged one fails its audit and leaves the second in place."""
    s = star_for(spark, sf)
    fact = s.fact().select("claim_key", "policy_key", "total_claim_amount")
    table = Pb.PublishedTable(spark, _scratch(spark, "published"), fact.schema)
    audit = lambda df: V.audit(df, "fact", unique=[["claim_key"]], not_null=["claim_key"],
                               references=[("policy_key", s.dim_policy, "policy_key")])
    table.publish(fact.where("policy_key > 10"), audit)
    table.publish(fact, audit)
    refused = None
    try:
        table.publish(fact.unionByName(fact.where("claim_key % 11 = 0")), audit)
    except V.CheckFailed as e:
        refused = str(e).partition("(")[0]
    return table.read().agg(F.lit(table.latest()).cast("long").alias("version"), F.lit(refused).alias("refused"),
                            F.count(F.lit(1)).alias("rows"), F.sum("total_claim_amount").cast("decimal(25,2)").alias("amount"))


@register("guard_report", """
SELECT 'dim_policy' AS dimension, COUNT(*) AS "rows", COALESCE(MAX(n), 0) AS largest, COALESCE(MAX(n), 0) > 1 AS rejected FROM
  (SELECT COUNT(*) AS n FROM dim_policy GROUP BY policy_number) UNION ALL
SELECT 'dim_policyholder', CAST(SUM(n) AS BIGINT), COALESCE(MAX(n), 0), COALESCE(MAX(n), 0) > 1 FROM
  (SELECT COUNT(*) AS n FROM dim_policyholder GROUP BY policyholder_id)""")
def q_guard(spark, sf):
    """What the many-to-one guard measures, and whether a lookup on that key is refused."""
    s = star_for(spark, sf)
    out = []
    for name, dim, key in (("dim_policy", s.dim_policy, "policy_number"),
                           ("dim_policyholder", s.dim_policyholder, "policyholder_id")):
        rows, largest = key_profile(dim, [key])
        try:
            lookup_join(s.claims.select("policyholder_id"), dim.select(key), [("policyholder_id", key)])
            out.append((name, rows, largest, False))
        except DuplicateKeyError:
            out.append((name, rows, largest, True))
    return spark.createDataFrame(out, "dimension string, rows long, largest long, rejected boolean")


# ------------------------------------------------------------------ notes
def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The prompt's text, written out again for the oracle.
PROMPT = """
Extract structured fields from this insurance
adjuster note. Return ONLY valid JSON, no
other text, in this exact shape:

{
  "incident_category": one of ["collision",
      "weather", "theft", "vandalism",
      "fire", "animal_strike", "road_hazard"],
  "at_fault_party": one of ["insured",
      "other_party", "unknown", "not_applicable"],
  "injury_mentioned": true or false,
  "severity_hint": one of ["minor", "moderate",
      "severe", "total_loss"]
}

Note: """


@register("note_prompt", f"""
SELECT conv_id, turn, {_sql_text(PROMPT)} || COALESCE(text, 'nan') || chr(10) AS prompt
FROM conversations""")
def q_note_prompt(spark, sf):
    conv = read_table(spark, sf, "conversations")
    return conv.select("conv_id", "turn", N.render_prompt(F.col("text")).alias("prompt"))


# The allowed value of each field of an answer.
ANSWERS = {
    "incident_category": ("collision", "weather", "theft", "vandalism", "fire", "animal_strike", "road_hazard"),
    "at_fault_party": ("insured", "other_party", "unknown", "not_applicable"),
    "severity_hint": ("minor", "moderate", "severe", "total_loss")}


def _parse_sql(table: str = "events", keep: str = "event_id") -> str:
    r = f"regexp_replace(props, '{O.OUTER_SPACE}', '', 'g')"
    # Text that is no JSON is not handed to JSON functions, whatever order DuckDB evaluates in.
    r = f"(CASE WHEN json_valid({r}) THEN {r} END)"
    obj = f"(props IS NOT NULL AND COALESCE(json_type({r}) = 'OBJECT', FALSE))"
    fields = {f: f"json_extract_string({r}, '$.{f}')" for f in ("incident_category", "at_fault_party", "severity_hint")}
    inj_type = f"json_type({r}, '$.injury_mentioned')"
    inj_present = f"({inj_type} IS NOT NULL AND {inj_type} <> 'NULL')"
    inj = f"CASE WHEN {inj_type} = 'BOOLEAN' THEN CAST(json_extract_string({r}, '$.injury_mentioned') AS BOOLEAN) END"
    bad = " OR ".join(
        [f"({fields[f]} IS NOT NULL AND {fields[f]} NOT IN ({', '.join(_sql_text(v) for v in vals)}))"
         for f, vals in ANSWERS.items()] + [f"({inj_present} AND {inj_type} <> 'BOOLEAN')"])
    missing = " OR ".join([f"{fields[f]} IS NULL" for f in fields] + [f"NOT {inj_present}"])
    status = (f"CASE WHEN NOT COALESCE({obj}, FALSE) THEN 'parse_failed' WHEN {bad} THEN 'invalid_value' "
              f"WHEN {missing} THEN 'incomplete' ELSE 'ok' END")
    return f"""
SELECT {keep}, {', '.join(f'CASE WHEN {obj} THEN {e} END AS {f}' for f, e in fields.items())},
       CASE WHEN {obj} THEN {inj} END AS injury_mentioned, {status} AS status,
       CASE WHEN {status} <> 'ok' THEN props END AS raw_response
FROM {table}"""


@register("note_parse", _parse_sql())
def q_note_parse(spark, sf):
    """Model answers are parsed (N2); the ``events.props`` JSON column stands in for them."""
    ev = read_table(spark, sf, "events")
    return N.parse_responses(ev.select("event_id", F.col("props").alias("raw_response")), keep=("event_id",))


ANSWER_SQL = """(SELECT event_id, CASE event_id % 5
  WHEN 0 THEN '{"incident_category": "theft", "at_fault_party": "unknown", "injury_mentioned": ' ||
              CASE WHEN value > 50 THEN 'true' ELSE 'false' END || ', "severity_hint": "minor"}'
  WHEN 1 THEN '{"incident_category": "' || event_type || '", "at_fault_party": "insured", "injury_mentioned": true, "severity_hint": "severe"}'
  WHEN 2 THEN ' {"incident_category": "fire", "injury_mentioned": null, "severity_hint": "total_loss"} '
  WHEN 3 THEN 'The answer is ' || event_type
  ELSE props END AS props FROM events)"""


def _answers(spark, sf):
    """Model answers of every kind, made of the events: whole, of unknown values, partial, no JSON, other JSON."""
    kind, text = F.col("event_id") % 5, F.concat
    return read_table(spark, sf, "events").select("event_id", F.when(kind == 0, text(
        F.lit('{"incident_category": "theft", "at_fault_party": "unknown", "injury_mentioned": '),
        F.when(F.col("value") > 50, "true").otherwise("false"), F.lit(', "severity_hint": "minor"}')))
        .when(kind == 1, text(F.lit('{"incident_category": "'), "event_type", F.lit(
            '", "at_fault_party": "insured", "injury_mentioned": true, "severity_hint": "severe"}')))
        .when(kind == 2, F.lit(' {"incident_category": "fire", "injury_mentioned": null, "severity_hint": "total_loss"} '))
        .when(kind == 3, text(F.lit("The answer is "), "event_type")).otherwise(F.col("props")).alias("raw_response"))


@register("note_parse_kinds", _parse_sql(ANSWER_SQL))
def q_note_parse_kinds(spark, sf):
    """Answers of all four statuses."""
    return N.parse_responses(_answers(spark, sf), keep=("event_id",))


def _answer_by_rule(prompts: list[str]) -> list[str]:
    """A deterministic stand-in for a model: fails on notes that hold "?", else answers by the note's length."""
    out = []
    for p in prompts:
        note = p.partition("Note: ")[2][:-1]
        if "?" in note:
            raise ValueError("no answer")
        kind = "theft" if len(note) % 2 else "storm"
        out.append('{"incident_category": "%s", "at_fault_party": "unknown", "injury_mentioned": false, '
                   '"severity_hint": "minor"}' % kind)
    return out


@register("note_extract", """
SELECT conv_id * 1000 + turn AS note_id,
       CASE WHEN text LIKE '%?%' THEN 'no answer' END AS error,
       CASE WHEN text LIKE '%?%' THEN NULL WHEN length(COALESCE(text, 'nan')) % 2 = 1 THEN 'theft' ELSE 'storm' END AS incident_category,
       CASE WHEN text LIKE '%?%' THEN 'call_failed' WHEN length(COALESCE(text, 'nan')) % 2 = 1 THEN 'ok' ELSE 'invalid_value' END AS status
FROM conversations""")
def q_note_extract(spark, sf):
    """Extraction end to end: every note is asked about, a failing one marks only its own row."""
    package_on_workers(spark)
    notes = read_table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("note_id"), F.col("text").alias("note_text"))
    return N.process_notes(notes, _answer_by_rule, id_col="note_id").select("note_id", "error", "incident_category", "status")


@register("note_extract_resumed", """
SELECT conv_id * 1000 + turn AS note_id, CASE WHEN text LIKE '%?%' THEN 'no answer' END AS error,
       CASE WHEN text LIKE '%?%' THEN 3 ELSE 1 END AS attempt,
       CASE WHEN text LIKE '%?%' THEN 'call_failed' WHEN length(COALESCE(text, 'nan')) % 2 = 1 THEN 'ok' ELSE 'invalid_value' END AS status,
       TRUE AS resumed
FROM conversations""")
def q_note_extract_resumed(spark, sf):
    """An extraction over some notes, resumed over all: distinct prompts are asked once, failing ones three times,
    and a third run asks nothing (N3, N4)."""
    package_on_workers(spark)
    notes = read_table(spark, sf, "conversations").select(
        "turn", (F.col("conv_id") * 1000 + F.col("turn")).alias("note_id"), F.col("text").alias("note_text"))
    store = N.AnswerStore(spark, _scratch(spark, "answers"))
    store.ask(notes.where("turn % 2 = 1"), _answer_by_rule, attempts=3)
    out = store.process(notes, _answer_by_rule, id_col="note_id", attempts=3)
    resumed = store.ask(notes, _answer_by_rule, attempts=3) == 0
    return out.select("note_id", "error", "attempt", "status", F.lit(resumed).alias("resumed"))
