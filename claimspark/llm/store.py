"""Tables written to the cluster's shared folder between the jobs of an operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from claimspark.session import checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder; return a scan of it.

    This cuts the lineage: what follows reads finished files, so a lost
    executor costs a read and never the work before.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, with underscores put before those that ``df`` has already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
