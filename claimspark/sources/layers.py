"""Layer I/O: CSV sources, parquet and CSV sinks, views vs tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from claimspark.operators.contracts import drift_report
from claimspark.sources import csv_files


@dataclass(frozen=True)
class Layers:
    """Bronze / silver / gold folders under one root (S7); passed as arguments, no global config."""

    root: str

    def path(self, layer: str, name: str) -> str:
        if layer not in ("bronze", "silver", "gold"):
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{name}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with a header row.

    With a contract ``schema`` columns are bound by the names in each file's
    own header: nothing is inferred, columns a file lacks are null, and
    columns outside the contract are dropped.  A value that its type cannot
    hold is null; ``csv_files.rows`` and ``split`` keep such rows apart.
    Without one, types are inferred, which costs a further pass.
    """
    if schema is not None:
        return csv_files.rows(spark, path, schema, extra=False, multi_line=multi_line).select(*schema.names)
    return spark.read.options(**csv_files.QUOTING, header=True, inferSchema=True,
                              multiLine=multi_line).csv(path)


def load_with_drift_check(
    spark: SparkSession, path: str, expected: Iterable[str] | T.StructType, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """Read a CSV and report drift against the expected columns (S1 + C1); never fails.

    Returns ``(data, drift)``.  New columns are carried through.  The report
    compares names that the files have: with a contract ``schema``, a
    contract column that no file names is ``missing``, not ``ok``.
    """
    if schema is None:
        df = read_csv(spark, path)
        return df, drift_report(df, expected)
    found = csv_files.layouts(spark, path)
    df = csv_files.rows(spark, path, schema, found=found)
    data = df.drop(csv_files.FILE, csv_files.RAW, csv_files.REASONS)
    named = {n for layout in found for n in layout.header}
    return data, drift_report(data.select(*[f"`{c}`" for c in data.columns if c in named]), expected)


def write_partitioned(df: DataFrame, path: str, by: str | list[str], mode: str = "overwrite") -> None:
    """Parquet with one folder per value of ``by`` (S4); later filters on it prune folders.

    Rows are clustered by the partition columns with a ``rebalance`` hint, so
    each task writes few files per value, and AQE splits a value that holds
    a large share of the rows (a risk bucket can hold a third of them) into
    advisory-size chunks instead of one task writing it all.  A plain
    ``repartition`` on a low-cardinality column would funnel each value
    through a single task.
    """
    cols = [by] if isinstance(by, str) else list(by)
    df.hint("rebalance", *cols).write.mode(mode).partitionBy(*cols).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with a header (S5): a folder of part files written by all tasks, quotes doubled."""
    csv_files.write(df, path, mode)


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """Staging models are views, marts are tables.

    ``view``: a temporary view over the plan (recomputed when read);
    ``table``: the plan is written to ``path`` as parquet and the view
    ``name`` points at the written files.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "table":
        if path is None:
            raise ValueError("a table needs a path")
        write_parquet(df, path)
        out = spark.read.schema(df.schema).parquet(path)
        out.createOrReplaceTempView(name)
        return out
    raise ValueError("kind must be 'view' or 'table'")
