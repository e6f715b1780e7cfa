"""claimspark: a Spark-native insurance-claims warehouse.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
built-in expressions, joins, windows and aggregates, so Catalyst can prune,
push down and plan it.  Sub-packages:

* ``sources``    reading/writing layers and the stand-in inputs derived from
                 the driver tables
* ``functions``  column-expression helpers (sentinels, buckets, change tests)
* ``operators``  contracts, quality, profiling, keys, dimensions, SCD2,
                 joins, facts, checks, notes
* ``plans``      report marts, the end-to-end pipeline and the query catalog
* ``llm``        operators of a training-data pipeline, which nothing else here
                 imports
"""

from claimspark.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
