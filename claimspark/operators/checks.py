"""Data-quality checks (V1-V8).

Each check is one aggregate over the tested table (partial aggregation, no
collect of rows); ``run_checks`` unions the one-row results and raises when
any fails, as a failing test fails a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECK_SCHEMA = "check string, target string, failures long, passed boolean"


def _result(df: DataFrame, check: str, target: str, failures) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(target).alias("target"),
                     failures.cast("long").alias("failures")).withColumn("passed", F.col("failures") == 0)


def unique(df: DataFrame, cols: Sequence[str], table: str = "") -> DataFrame:
    """V1: rows sharing a non-NULL key with another row (NULL keys are ignored)."""
    keyed = df.select(*cols).where(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))
    dup = keyed.groupBy(*cols).count().where("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("f"))
    return _result(dup, "unique", f"{table}.{','.join(cols)}".lstrip("."), F.col("f"))


def not_null(df: DataFrame, cols: Sequence[str], table: str = "") -> DataFrame:
    """V2, V3: NULL count per column, from one aggregate over all columns."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{table + '.' if table else ''}{c}', `{c}`" for c in cols)
    long = agg.selectExpr(f"stack({len(cols)}, {stack}) AS (target, f)")
    return long.select(F.lit("not_null").alias("check"), "target", F.col("f").cast("long").alias("failures")) \
        .withColumn("passed", F.col("failures") == 0)


def relationships(fact: DataFrame, fk: str, dim: DataFrame, pk: str, table: str = "") -> DataFrame:
    """V4: non-NULL foreign keys with no row in the dimension (a left-anti join)."""
    orphans = fact.select(fk).where(F.col(fk).isNotNull()).join(
        dim.select(F.col(pk).alias(fk)), fk, "left_anti")
    return _result(orphans.agg(F.count(F.lit(1)).alias("f")), "relationships",
                   f"{table + '.' if table else ''}{fk}", F.col("f"))


def single_current(dim: DataFrame, natural_key: str = "policyholder_id", table: str = "dim_policyholder") -> DataFrame:
    """V6: natural keys with more than one current version."""
    multi = dim.where(F.col("is_current")).groupBy(natural_key).count().where("count > 1")
    return _result(multi.agg(F.count(F.lit(1)).alias("f")), "single_current", f"{table}.{natural_key}", F.col("f"))


def audit(df: DataFrame, table: str, *, unique: Sequence[Sequence[str]] = (), not_null: Sequence[str] = (),
          references: Sequence[tuple[str, DataFrame, str]] = (), single_current: str | None = None) -> DataFrame:
    """All checks of a table from one scan of it (V1-V6): rows as ``unique``, ``not_null`` and so on give them.

    Every row gives its keys, each under the name of its check; a count per
    distinct key combines in each task before the one shuffle, so a hot
    foreign key travels as one row a task.  The distinct keys of all
    references then meet the dimensions' keys in one join.  Counts answer
    the rest: of the null key for ``not_null``, above one for ``unique``.
    A column that is asked for NULLs only gives one key for all its values.
    """
    def key(*cols: str):
        texts = [F.col(c).cast("string") for c in cols]
        if len(cols) == 1:
            return texts[0]
        whole = F.lit(True)
        for c in cols:
            whole = whole & F.col(c).isNotNull()
        return F.when(whole, F.to_json(F.array(*texts)))

    # (check, target, key): checks of one key share its counts.
    asked: list[tuple[str, str, str]] = []
    keys: dict[str, object] = {}
    for cols in unique:
        name = ",".join(cols)
        keys[name] = key(*cols)
        asked.append(("unique", name, name))
    for c in not_null:
        asked.append(("not_null", c, c))
    known = None
    for fk, dim, pk in references:
        keys[fk] = key(fk)
        asked.append(("relationships", fk, fk))
        of = dim.select(F.lit(fk).alias("name"), F.col(pk).cast("string").alias("key")).where("key IS NOT NULL").distinct()
        known = of if known is None else known.unionByName(of)
    if single_current:
        name = f"current {single_current}"
        keys[name] = F.when(F.col("is_current"), key(single_current))
        asked.append(("single_current", single_current, name))
    for c in not_null:
        # Of a column that no other check reads, only whether it is null.
        keys.setdefault(c, F.when(F.col(c).isNotNull(), F.lit("")))
    if not asked:
        return df.sparkSession.createDataFrame([], CHECK_SCHEMA)
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), k.alias("key")) for n, k in keys.items()]))
    counts = df.select(pairs.alias("x")).groupBy("x.name", "x.key").agg(F.count(F.lit(1)).alias("n"))
    held = F.col("key").isNotNull()
    lost = F.lit(False)
    if known is not None:
        counts = counts.join(known.withColumn("known", F.lit(True)), ["name", "key"], "left")
        lost = held & F.col("known").isNull()
    found = counts.groupBy("name").agg(
        F.sum(F.when(held & (F.col("n") > 1), F.col("n")).otherwise(0)).alias("unique"),
        F.count_if(held & (F.col("n") > 1)).alias("single_current"),
        F.sum(F.when(~held, F.col("n")).otherwise(0)).alias("not_null"),
        F.sum(F.when(lost, F.col("n")).otherwise(0)).alias("relationships"))
    wanted = df.sparkSession.createDataFrame(
        [(i, c, f"{table}.{t}" if table else t, n) for i, (c, t, n) in enumerate(asked)], "place int, check string, target string, name string")
    of_check = F.coalesce(*[F.when(F.col("check") == c, F.col(c)) for c in ("unique", "single_current", "not_null", "relationships")])
    return _result_rows(wanted.join(found, "name", "left").select("check", "target", F.coalesce(of_check, F.lit(0)).alias("failures")))


def _result_rows(df: DataFrame) -> DataFrame:
    return df.select("check", "target", F.col("failures").cast("long").alias("failures")).withColumn("passed", F.col("failures") == 0)


def report(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


class CheckFailed(AssertionError):
    pass


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """V8: evaluate all checks and raise if any failed; the result rows are not evaluated again."""
    checked = report(checks)
    rows = checked.collect()
    result = checked.sparkSession.createDataFrame(rows, checked.schema)
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise CheckFailed("; ".join(f"{r['check']}({r['target']}): {r['failures']}" for r in failed))
    return result
