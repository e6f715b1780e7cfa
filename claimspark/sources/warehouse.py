"""Warehouse tables by name, with statistics that order the joins over them (S3).

A table is saved under a name of the session's catalog, its files where the
caller says.  Statistics are counted when it is saved: rows and bytes, and for
the columns named (join keys and filter columns) distinct values, bounds and
missing values, from one scan of those columns.  Inside ``cost_based`` Spark orders
inner joins by them instead of by the order they are written in, so a selective dimension
meets the fact first.

A name that is missing, or a table without a column that its reader needs,
raises before any job runs.  Statistics tell of the saved rows; ``save`` over an
old name counts them anew.  An empty table has statistics of no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.operators.contracts import require_columns

_BY_COST = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
}


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def save(df: DataFrame, name: str, path: str, statistics_of: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` to ``path`` as table ``name``, count its statistics and return a read of it.

    ``path`` is a folder that no earlier table uses: a table of the same name is
    replaced only when the new files are complete, and its own stay for those who read them.
    """
    spark, columns = df.sparkSession, list(statistics_of)
    require_columns(df, columns)
    df.write.mode("errorifexists").parquet(path)
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)
    which = f" FOR COLUMNS {', '.join(map(_quoted, columns))}" if columns else ""
    spark.sql(f"ANALYZE TABLE {_quoted(name)} COMPUTE STATISTICS{which}")
    return spark.table(name)


def read(spark: SparkSession, name: str, columns: Iterable[str] = ()) -> DataFrame:
    """A scan of table ``name``; ``columns`` are those it must have."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"unknown table {name!r}")
    df = spark.table(name)
    require_columns(df, columns)
    return df


def statistics(spark: SparkSession, name: str, columns: Iterable[str]) -> DataFrame:
    """(column_name, distinct_count, missing, least, greatest) as the catalog has them; null where it has none."""
    rows = []
    for column in columns:
        told = {r["info_name"]: r["info_value"] for r in
                spark.sql(f"DESCRIBE EXTENDED {_quoted(name)} {_quoted(column)}").collect()}
        rows.append((column, *[None if told.get(k) in (None, "NULL") else told[k]
                               for k in ("distinct_count", "num_nulls", "min", "max")]))
    out = spark.createDataFrame(rows, "column_name string, distinct_count string, missing string, least string, greatest string")
    return out.withColumns({c: F.col(c).cast("long") for c in ("distinct_count", "missing")})


@contextmanager
def cost_based(spark: SparkSession) -> Iterator[None]:
    """Plans made inside order their inner joins by statistics; the session's settings come back after it.

    A plan is made when its job starts, so the job belongs inside as well.
    """
    before = {k: spark.conf.get(k, None) for k in _BY_COST}
    try:
        for k, v in _BY_COST.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
