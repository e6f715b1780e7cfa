"""Exact top-k by inner product with vector-approximation files (operator 7).

Vectors are integers: component x becomes floor(scale * x).  They are dealt
into blocks of bounded size.  A block keeps, besides the exact vectors, an
approximation of each: every dimension is cut into cells and a vector is the
list of its cell numbers.  The scan of the approximations gives an upper
bound of each score; exact vectors are then read in descending order of that
bound until no unread bound can reach the k-th score found.

Every block of queries meets every block of vectors in a group of its own,
so no task holds more than one block of each, and a group sends on at most k
rows for each query; a window takes the k best of those.

Results: vectors that are null or hold a null or non-finite component, and
rows without an id, take no part.  A query's own row (any row of the same
id) is no candidate for it.  Repeated rows of one id are candidates one by
one; of repeated query rows of one id and vector one counts, and of several
vectors with one query id the smallest in array order.  Ties go to the
smaller id.  Shorter vectors count as filled with zeros.  With no queries or
no candidates the result is empty.  Finite components of any size take part;
scores are exact, and one that 64 bits cannot hold ends the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_VECTORS = 8192
BLOCK_QUERIES = 2048
CELLS = 16
#: Candidates read at a time, in order of their bounds.
READ = 64


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, vec array<double>) of the rows that take part: whole numbers, each exact, of any size."""
    x = F.transform(vector_col, lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))  # NaN is above every number
    # Whole numbers beyond 64 bits are still exact as doubles: a component's bits are at most a double's.
    whole = F.transform("x", lambda c: F.when(F.abs(c * scale) < float(1 << 53), F.floor(c * scale).cast("double")).otherwise(c * scale))
    return (df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
            .where(fine).select("id", whole.alias("vec")))


class Approximation:
    """Cells of a block: for each dimension equal counts between cuts, and the range each cell covers."""

    def __init__(self, vectors: np.ndarray, cells: int = CELLS):
        n, dims = vectors.shape
        at = (np.arange(1, cells) * n) // cells
        cuts = np.sort(vectors, axis=0)[at] if n else np.zeros((cells - 1, dims), vectors.dtype)
        self.codes = np.empty((n, dims), dtype=np.uint8)
        self.low, self.high = np.zeros((cells, dims)), np.zeros((cells, dims))
        for d in range(dims):
            code = np.searchsorted(cuts[:, d], vectors[:, d], side="right")
            self.codes[:, d] = code
            low, high = np.full(cells, np.inf), np.full(cells, -np.inf)
            np.minimum.at(low, code, vectors[:, d])
            np.maximum.at(high, code, vectors[:, d])
            used = low <= high
            self.low[used, d], self.high[used, d] = low[used], high[used]

    def upper_bounds(self, queries: np.ndarray) -> np.ndarray:
        """Bound of each (query, vector) score: cell centres' score plus what the half widths and rounding allow.

        Each sum of ``dims`` products in doubles is off by less than
        ``dims + 2`` rounding units of the sum of the products' sizes; four
        such sums, of sizes that the largest cells bound, cover both terms.
        """
        dims = np.arange(self.codes.shape[1])
        low, high = self.low[self.codes, dims], self.high[self.codes, dims]
        size = np.abs(queries) @ np.maximum(np.abs(self.low), np.abs(self.high)).max(axis=0, initial=0)
        rounding = 4 * (len(dims) + 4) * np.finfo(np.float64).eps * size
        return queries @ (low / 2 + high / 2).T + np.abs(queries) @ (high / 2 - low / 2).T + rounding[:, None]


def _exact(vectors: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers where no inner product can pass them, else as Python's."""
    largest = [float(np.abs(m).max(initial=0)) for m in (vectors, others)]
    if max(largest) < 2 ** 62 and largest[0] * largest[1] * max(1, vectors.shape[1]) < 2 ** 62:
        return vectors.astype(np.int64), others.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return whole(vectors), whole(others)


def top_of_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                 k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: (its id, ids, scores) of its k best vectors of a block.  Both are whole numbers as doubles."""
    approximation = Approximation(vectors)
    exact_queries, exact = _exact(queries, vectors)
    for first in range(0, len(queries), 256):
        bounds = approximation.upper_bounds(queries[first:first + 256])
        for row, bound in enumerate(bounds):
            q, query = query_ids[first + row], exact_queries[first + row]
            bound[ids == q] = -np.inf
            left = int(np.count_nonzero(bound > -np.inf))
            order = np.argsort(-bound, kind="stable")[:left]
            best_ids, best = np.zeros(0, np.int64), np.zeros(0, exact.dtype)
            at = 0
            # A bound equal to the k-th score may hide a tie with a smaller id.
            while at < left and (len(best) < k or bound[order[at]] >= float(best[-1])):
                some = order[at:at + READ]
                at += READ
                best_ids = np.concatenate((best_ids, ids[some]))
                best = np.concatenate((best, exact[some] @ query))
                keep = np.lexsort((best_ids, -best))[:k] if best.dtype != object else \
                    np.array(sorted(range(len(best)), key=lambda i: (-best[i], best_ids[i]))[:k])
                best_ids, best = best_ids[keep], best[keep]
            if len(best):
                yield q, best_ids, best


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), dtype=np.float64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_vectors: int = BLOCK_VECTORS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each row of ``queries``.

    Both are (id, vec) as ``integer_vectors`` makes them.
    """
    queries = queries.groupBy("id").agg(F.min("vec").alias("vec"))
    n_vectors, n_queries = vectors.count(), queries.count()
    vector_blocks, query_blocks = max(1, -(-n_vectors // block_vectors)), max(1, -(-n_queries // block_queries))
    # Rows are dealt by their whole content and a number in their task, so equal rows spread too.
    salt = F.xxhash64("id", "vec", F.monotonically_increasing_id())
    dealt = vectors.select(
        F.lit(False).alias("is_query"), "id", "vec", F.pmod(salt, F.lit(vector_blocks)).cast("int").alias("v_block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q_block"))
    asked = queries.select(
        F.lit(True).alias("is_query"), "id", "vec",
        F.explode(F.sequence(F.lit(0), F.lit(vector_blocks - 1))).alias("v_block"),
        F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("q_block"))

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        asked_here = rows["is_query"].to_numpy(dtype=bool)
        dims = int(rows["vec"].map(len).max())
        q, v = rows[asked_here], rows[~asked_here]
        found = list(top_of_block(q["id"].to_numpy(), _matrix(q["vec"], dims), v["id"].to_numpy(),
                                  _matrix(v["vec"], dims), k)) if len(q) and len(v) else []
        return pd.DataFrame({
            "query_id": np.repeat(np.array([f[0] for f in found], np.int64), [len(f[1]) for f in found]),
            "vec_id": np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)]),
            # A score beyond 64 bits has no place in the result: it ends the job with an error.
            "score": np.array([int(s) for f in found for s in f[2]], dtype=np.int64),
        })

    near = (dealt.unionByName(asked).groupBy("v_block", "q_block")
            .applyInPandas(block, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
