"""Exact top-k inner products over an impact-ordered index, score at a time.

Components are quantised to integers ``floor(scale * x)``. Vectors are dealt to
blocks; each block indexes its vectors by posting segments, one for every
dimension and level of quantised impact (the size of a component). For a block of
queries, segments are processed by falling impact: each adds its postings'
exact products to the accumulators. What is still missing from a score is at
most the query's length times the length of the vector's unprocessed rest
(Cauchy-Schwarz). Processing stops early only on that proof, when few vectors
can still be among a query's best; all possible members are scored exactly.

Vectors that are null or hold null or non-finite components take no part, nor
rows without id. A vector meets only vectors of its own length. A row never
answers a query of its own id; where a query's id repeats, its least vector asks.
Scores are exact while they fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Vectors and queries of a cell; a task holds one cell. Every vector travels once for each QUERIES queries.
BLOCK, QUERIES = 8192, 8192
#: Queries that a task scores together.
TOGETHER = 512
LEVELS = 10
#: Possible members for each query, as a multiple of k, at which scoring them beats processing more segments.
FEW = 12


class ImpactIndex:
    """Posting segments of integer vectors, by level of impact and dimension."""

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        self.vectors = vectors
        size = np.abs(vectors)
        top = max(int(size.max(initial=0)), 1)
        level = (size * levels - 1) // top  # 0 to levels - 1; zeros, at -1, have no posting
        self.segments, self.rests = [], []
        square = vectors.astype(np.float64) ** 2
        rest = square.sum(1)
        for impact in range(levels - 1, -1, -1):
            own = level == impact
            dims, rows = np.nonzero(own.T)
            edge = np.searchsorted(dims, np.arange(vectors.shape[1] + 1))
            self.segments.append([(d, rows[a:b]) for d, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if b > a])
            rest = np.maximum(rest - np.where(own, square, 0).sum(1), 0)
            self.rests.append(np.sqrt(rest) if impact else np.zeros(len(vectors)))

    def best(self, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
        """For each query the places and scores of its ``k`` best vectors, equal scores by smaller id."""
        n, m = len(self.vectors), len(queries)
        bound = int(np.abs(self.vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(queries.shape[1], 1)
        kind = np.int32 if bound < 1 << 30 else np.int64
        sums = np.zeros((n, m), kind)
        columns, vectors = np.ascontiguousarray(queries.T.astype(kind)), self.vectors.astype(kind)
        own = np.nonzero(ids[:, None] == query_ids[None, :])
        length = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
        possible = np.ones((n, m), bool)
        for step, (segments, rest) in enumerate(zip(self.segments, self.rests, strict=True)):
            for dim, rows in segments:
                sums[rows] += vectors[rows, dim][:, None] * columns[dim]
            last = step == len(self.segments) - 1
            if n > k and (last or rest.max(initial=0) < 0.5 * np.sqrt((vectors.astype(float) ** 2).sum(1).max(initial=0))):
                slack = np.zeros((1, 1)) if last else rest[:, None] * length * (1 + 1e-9) + 1e-3
                low = sums - slack
                low[own] = -np.inf
                floor = np.partition(low, n - k, axis=0)[n - k]  # k vectors reach this for sure
                possible = sums + slack >= floor
                if last or possible.sum() <= FEW * k * m:
                    break
        possible[own] = False
        for q in range(m):
            at = np.flatnonzero(possible[:, q])
            score = self.vectors[at] @ queries[q]
            first = np.lexsort((ids[at], -score))[:k]
            yield q, at[first], score[first]


def _cell(k: int):
    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        flat = column.combine_chunks()
        return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(flat), -1)

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if vectors.num_rows and queries.num_rows:
            ids, asked = vectors["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
            index, asking = ImpactIndex(matrix(vectors["v"])), matrix(queries["v"])
            for first in range(0, len(asked), TOGETHER):
                part = slice(first, first + TOGETHER)
                for q, at, score in index.best(ids, asking[part], asked[part], k):
                    out["query_id"] += [int(asked[first + q])] * len(at)
                    out["vec_id"] += ids[at].tolist()
                    out["score"] += score.tolist()
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    return run


def top_k(embeddings: DataFrame, query_modulus: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for every row whose id ``query_modulus`` divides."""
    whole = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).where(
        "vec_id is not null and e is not null and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    ).select("vec_id", F.expr(f"transform(e, x -> cast(floor({scale} * x) as bigint))").alias("v"))
    queries = whole.where(F.col("vec_id") % query_modulus == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    size = embeddings.select(F.count("*"), F.count(F.when(F.col("vec_id") % query_modulus == 0, 1))).first()
    blocks, asked = max(1, -(-size[0] // BLOCK)), max(1, -(-size[1] // QUERIES))

    def dealt(df: DataFrame, own: str, n: int, other: str, others: int) -> DataFrame:
        """Rows dealt evenly to ``n`` blocks by a hash of the row, each sent to every block of the other side."""
        return df.withColumn(own, F.pmod(F.xxhash64("vec_id", "v"), F.lit(n))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        ).withColumn("width", F.size("v"))

    cell = ["width", "vector_block", "query_block"]
    parts = dealt(whole, "vector_block", blocks, "query_block", asked).groupBy(*cell).cogroup(
        dealt(queries, "query_block", asked, "vector_block", blocks).groupBy(*cell)
    ).applyInArrow(_cell(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
