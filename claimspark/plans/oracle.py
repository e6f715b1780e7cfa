"""Independent DuckDB spellings of every registered query.

Each query is ``WITH <needed views> <final select>`` over the driver tables
only.  Rounding that Spark performs on exact decimals is spelled here with
integer arithmetic, because DuckDB divides decimals as doubles.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}

# Python's str.strip() whitespace (see functions.expressions), in RE2 syntax.
_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
OUTER_SPACE = f"^{_WS}+|{_WS}+$"


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def _deps(body: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", body)]


def with_ctes(final: str) -> str:
    """Prefix ``final`` with every CTE it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str, seen: tuple[str, ...] = ()) -> None:
        if name in order:
            return
        for d in _deps(CTES[name]):
            if d != name and d not in seen:
                visit(d, seen + (name,))
        order.append(name)

    final = final.strip()
    for n in _deps(final):
        visit(n)
    if not order:
        return final
    head = "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order)
    if final[:5].upper() == "WITH ":
        return head + ",\n" + final[5:]
    return head + "\n" + final


def exact_avg(col: str, scale: int, out: str = "DECIMAL(18,6)") -> str:
    """Half-up rounded mean of a non-negative DECIMAL(x,2) column, exactly."""
    units = 10 ** (scale - 2)
    n = f"COUNT({col})"
    cents = f"CAST(ROUND(SUM({col}) * 100) AS HUGEINT)"
    q = f"(({cents} * {2 * units} + {n}) // (2 * {n}))"
    step = f"CAST('{1 / 10 ** scale:.{scale}f}' AS DECIMAL({scale + 1},{scale}))"
    return f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(CAST({q} AS DECIMAL(18,0)) * {step} AS {out}) END"


def exact_rate(num: str, den: str) -> str:
    """round(100 * num / den, 2) half-up for non-negative integers, as DECIMAL(9,2)."""
    q = f"((CAST({num} AS HUGEINT) * 20000 + {den}) // (2 * {den}))"
    return f"CASE WHEN {den} = 0 THEN NULL ELSE CAST(CAST({q} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(9,2)) END"


# ---------------------------------------------------------------- inputs
cte("li_summary", """
SELECT l_orderkey, COUNT(*) AS n_lines, MIN(l_partkey) AS partkey,
       SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(15,2)) ELSE CAST(0 AS DECIMAL(15,2)) END) AS a_amt,
       SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(15,2)) ELSE CAST(0 AS DECIMAL(15,2)) END) AS n_amt,
       SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(15,2)) ELSE CAST(0 AS DECIMAL(15,2)) END) AS r_amt,
       MAX(l_linestatus) AS linestatus
FROM lineitem GROUP BY l_orderkey
""")

cte("claims", """
SELECT o.o_orderkey AS claim_id,
       o.o_custkey AS policy_number,
       CAST(o.o_custkey AS VARCHAR) AS policyholder_id,
       CAST(o.o_orderdate AS DATE) AS incident_date,
       o.o_orderstatus AS incident_type,
       li.linestatus AS collision_type,
       o.o_orderpriority AS incident_severity,
       CAST(COALESCE(li.n_lines, 0) AS INT) AS number_of_vehicles_involved,
       CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE CAST(o.o_totalprice AS DECIMAL(15,2)) END AS total_claim_amount,
       CAST(COALESCE(li.a_amt, 0) AS DECIMAL(15,2)) AS injury_claim,
       CAST(COALESCE(li.n_amt, 0) AS DECIMAL(15,2)) AS property_claim,
       CAST(COALESCE(li.r_amt, 0) AS DECIMAL(15,2)) AS vehicle_claim,
       CASE WHEN li.r_amt > li.a_amt THEN 'Y' ELSE 'N' END AS fraud_reported,
       p.p_brand AS auto_make, p.p_type AS auto_model, p.p_size AS auto_year,
       n.n_name AS policy_state, c.c_mktsegment AS policy_csl,
       CAST(c.c_acctbal AS DECIMAL(12,2)) AS policy_annual_premium
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN li_summary li ON o.o_orderkey = li.l_orderkey
LEFT JOIN part p ON li.partkey = p.p_partkey
""")

cte("holder_snapshots", """
SELECT policyholder_id, CAST(NULL AS INTEGER) AS age, CAST(NULL AS VARCHAR) AS sex, education_level,
       occupation, CAST(NULL AS VARCHAR) AS hobbies, relationship, zip_code, snapshot_date
FROM (
  SELECT CAST(o.o_custkey AS VARCHAR) AS policyholder_id,
         o.o_orderpriority AS occupation,
         CASE o.o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || o.o_orderstatus || ' '
                               ELSE o.o_orderstatus END AS relationship,
         CAST(c.c_nationkey AS VARCHAR) AS zip_code, c.c_mktsegment AS education_level,
         CAST(date_trunc('quarter', o.o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS snapshot_date,
         ROW_NUMBER() OVER (PARTITION BY o.o_custkey, date_trunc('quarter', o.o_orderdate)
                            ORDER BY o.o_orderdate DESC, o.o_orderkey DESC) AS rn
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
) s WHERE rn = 1
""")

cte("wide_claims", """
SELECT o_orderkey AS id,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS target,
       CASE WHEN o_custkey % 3 = 0 THEN -1 ELSE CAST(o_custkey % 7 AS INT) END AS ps_ind_01,
       CASE WHEN o_orderkey % 4 = 0 THEN -1 ELSE CAST(o_orderkey % 5 AS INT) END AS ps_ind_02_cat,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(-1 AS DOUBLE) ELSE o_totalprice END AS ps_reg_01,
       CASE WHEN o_custkey % 11 = 0 THEN -1 ELSE CAST(o_custkey % 2 AS INT) END AS ps_car_01_cat,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(-1 AS BIGINT) ELSE o_custkey END AS ps_car_11,
       CAST(o_orderkey % 10 AS DOUBLE) AS ps_calc_01,
       CASE WHEN o_orderstatus = 'P' THEN '-1' ELSE o_orderstatus END AS note
FROM orders
""")

# ---------------------------------------------------------------- dimensions
cte("dim_date", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, dayname(d) AS day_of_week,
       CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(year(d) AS INTEGER) AS year, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT CAST(generate_series AS DATE) AS d
      FROM generate_series((SELECT CAST(make_date(CAST(year(MIN(incident_date)) AS INT), 1, 1) AS TIMESTAMP) FROM claims),
                           (SELECT CAST(make_date(CAST(year(MAX(incident_date)) AS INT), 12, 31) AS TIMESTAMP) FROM claims),
                           INTERVAL 1 DAY))
""")

cte("dim_policy", """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY policy_number) AS BIGINT) AS policy_key,
       CAST(policy_number AS VARCHAR) AS policy_number, policy_state, policy_csl,
       CAST(NULL AS DECIMAL(12,2)) AS policy_deductable, policy_annual_premium,
       CAST(NULL AS DECIMAL(15,2)) AS umbrella_limit, CAST(NULL AS DATE) AS policy_bind_date
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY policy_number ORDER BY claim_id) AS rn FROM claims)
WHERE rn = 1
""")

cte("dim_vehicle", """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY auto_make NULLS LAST, auto_model NULLS LAST, auto_year NULLS LAST) AS BIGINT) AS vehicle_key,
       auto_make, auto_model, auto_year
FROM (SELECT DISTINCT auto_make, auto_model, auto_year FROM claims)
""")


def history_sql(source: str, mode: str) -> str:
    """Type-2 history of a snapshot relation, in the given change mode."""
    if mode == "strict":
        norm = "regexp_replace(CAST({c} AS VARCHAR), '" + OUTER_SPACE + "', '', 'g')"
    else:
        norm = "COALESCE(CAST({c} AS VARCHAR), '')"
    tracked = ("zip_code", "relationship", "occupation")
    w = "OVER (PARTITION BY policyholder_id ORDER BY snapshot_date)"
    changed = " OR ".join(
        f"LAG({norm.replace('{c}', t)}) {w} IS DISTINCT FROM {norm.replace('{c}', t)}" for t in tracked
    )
    return f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY snapshot_date, policyholder_id) AS BIGINT) AS policyholder_key,
       policyholder_id, age, sex, education_level, occupation, hobbies, relationship, zip_code,
       snapshot_date AS valid_from,
       LEAD(snapshot_date) {w} AS valid_to,
       LEAD(snapshot_date) {w} IS NULL AS is_current
FROM (SELECT *, ROW_NUMBER() {w} = 1 OR {changed} AS opens FROM {source}) s
WHERE opens
"""


cte("dim_policyholder", history_sql("holder_snapshots", "strict"))
cte("dim_policyholder_nae", history_sql("holder_snapshots", "null_as_empty"))

FACT_COLUMNS = """r.incident_type, r.collision_type, r.incident_severity, r.number_of_vehicles_involved,
       r.total_claim_amount, r.injury_claim, r.property_claim, r.vehicle_claim, r.fraud_reported"""

cte("fact_claims", f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY r.incident_date, r.policy_number, r.claim_id) AS BIGINT) AS claim_key,
       p.policy_key, ph.policyholder_key, v.vehicle_key, d.date_key AS incident_date_key,
       {FACT_COLUMNS}
FROM claims r
JOIN dim_policy p ON CAST(r.policy_number AS VARCHAR) = p.policy_number
JOIN dim_policyholder ph ON r.policyholder_id = ph.policyholder_id
     AND r.incident_date >= ph.valid_from AND (r.incident_date < ph.valid_to OR ph.valid_to IS NULL)
JOIN dim_vehicle v ON r.auto_make = v.auto_make AND r.auto_model = v.auto_model AND r.auto_year = v.auto_year
JOIN dim_date d ON r.incident_date = d.full_date
""")

cte("fact_claims_left", f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY r.incident_date, r.policy_number, r.claim_id) AS BIGINT) AS claim_key,
       p.policy_key, ph.policyholder_key, v.vehicle_key, d.date_key AS incident_date_key,
       {FACT_COLUMNS}
FROM claims r
LEFT JOIN dim_policy p ON CAST(r.policy_number AS VARCHAR) = p.policy_number
LEFT JOIN dim_vehicle v ON r.auto_make IS NOT DISTINCT FROM v.auto_make
     AND r.auto_model IS NOT DISTINCT FROM v.auto_model AND r.auto_year IS NOT DISTINCT FROM v.auto_year
JOIN dim_policyholder ph ON r.policyholder_id = ph.policyholder_id
     AND r.incident_date >= ph.valid_from AND (r.incident_date < ph.valid_to OR ph.valid_to IS NULL)
LEFT JOIN dim_date d ON r.incident_date = d.full_date
""")


def exact_bround(num: str, den: str, mult: int, scale: int, out: str) -> str:
    """round_half_even(num * mult / den, scale) for non-negative integers, exactly."""
    a = f"(CAST({num} AS HUGEINT) * {mult * 10 ** scale})"
    q, r = f"({a} // ({den}))", f"({a} % ({den}))"
    q2 = f"(CASE WHEN 2 * {r} > ({den}) THEN {q} + 1 WHEN 2 * {r} < ({den}) THEN {q} ELSE {q} + ({q} % 2) END)"
    step = f"CAST('{1 / 10 ** scale:.{scale}f}' AS DECIMAL({scale + 1},{scale}))" if scale else "1"
    return f"CASE WHEN ({den}) = 0 THEN NULL ELSE CAST(CAST({q2} AS DECIMAL(18,0)) * {step} AS {out}) END"


cte("holder_claims", """
SELECT o.o_orderkey AS claim_id, o.o_custkey AS policy_number, CAST(NULL AS INTEGER) AS age,
       CAST(NULL AS VARCHAR) AS insured_sex, c.c_mktsegment AS insured_education_level,
       o.o_orderpriority AS insured_occupation, CAST(NULL AS VARCHAR) AS insured_hobbies,
       o.o_orderstatus AS insured_relationship, c.c_nationkey AS insured_zip
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")

cte("holder_base", """
SELECT CAST(policy_number AS VARCHAR) AS policyholder_id, age, insured_sex AS sex,
       insured_education_level AS education_level, insured_occupation AS occupation,
       insured_hobbies AS hobbies, insured_relationship AS relationship, CAST(insured_zip AS VARCHAR) AS zip_code
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY policy_number ORDER BY claim_id) AS rn FROM holder_claims)
WHERE rn = 1
""")

cte("sentinel_clean", """
SELECT id, target, NULLIF(ps_ind_01, -1) AS ps_ind_01, NULLIF(ps_ind_02_cat, -1) AS ps_ind_02_cat,
       NULLIF(ps_reg_01, -1) AS ps_reg_01, NULLIF(ps_car_01_cat, -1) AS ps_car_01_cat,
       NULLIF(ps_car_11, -1) AS ps_car_11, NULLIF(ps_calc_01, -1) AS ps_calc_01, note
FROM wide_claims
""")

WIDE_FEATURES = ("ps_ind_01", "ps_ind_02_cat", "ps_reg_01", "ps_car_01_cat", "ps_car_11", "ps_calc_01", "note")
_nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in WIDE_FEATURES)
_n = len(WIDE_FEATURES)
cte("null_density", f"""
SELECT *, CAST((({_n} - null_field_count) * 2000 + {_n}) // {2 * _n} AS DOUBLE) / 10 AS data_completeness_pct
FROM (SELECT *, CAST({_nulls} AS INTEGER) AS null_field_count FROM sentinel_clean)
""")

cte("risk_bucket", """
SELECT *, CASE WHEN data_completeness_pct >= 90 THEN 'LOW_RISK'
               WHEN data_completeness_pct >= 70 THEN 'MEDIUM_RISK' ELSE 'HIGH_RISK' END AS risk_bucket
FROM null_density
""")
