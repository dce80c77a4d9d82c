"""Nearest neighbours of a query set by a block matrix join.

Vectors are dealt into candidate blocks and query blocks by a hash of their id; a tile is one of each. Within a tile, unit
vectors rounded to int8 give all products at once (in float32, which holds such sums exactly up to EXACT components, in float64
beyond) together with a bound on the rounding error. A pair survives if its upper bound reaches the k-th greatest lower bound of its query; survivors get their
cosine in double precision from the original components, heaps keep k a query, and the tiles' lists are ranked together.

The answer is exact: bounds only discard pairs that can't be among the k nearest. A tile holds CANDIDATES and QUERIES rows
at most on average, whatever the table's size, and its products are made for SLICE queries at a time.

Vectors that are null, empty or zero, or hold a null, NaN or infinite component, take no part, nor do null ids. Of rows that
repeat an id, the one with the smallest components counts. Vectors of another length than the query's are no candidates.
Ties go to the smaller id. A query without candidates has no rows.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voicegrid.llm.common import table

CANDIDATES, QUERIES, SLICE, PAIRS = 8192, 4096, 256, 65536
EXACT = (1 << 24) // 127**2
SCHEMA = "query_id long, vec_id long, score double"


def _block(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and original components, sorted by id, each id once."""
    column = t.column("embedding").combine_chunks()
    ids = t.column("vec_id").to_numpy()
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1).astype(np.float64)
    order = np.lexsort((*x.T[::-1], ids)) if len(np.unique(ids)) < len(ids) else np.argsort(ids)
    ids, x = ids[order], x[order]
    first = np.r_[True, ids[1:] != ids[:-1]]
    return ids[first], x[first]


def _rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 components (held as float32), their scale, and the norm of what rounding took from the unit vector."""
    top = np.abs(x).max(axis=1, keepdims=True)
    unit = x / top
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    return q.astype(np.float32 if x.shape[1] <= EXACT else np.float64), scale, np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1))


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows, summed component by component, so that equal vectors give equal numbers."""
    dot, aa, bb = np.zeros((3, len(a)))
    for i in range(a.shape[1]):
        dot += a[:, i] * b[:, i]
        aa += a[:, i] * a[:, i]
        bb += b[:, i] * b[:, i]
    return np.clip(dot / np.sqrt(aa * bb), -1.0, 1.0)


def search_tile(queries: tuple, candidates: tuple, k: int) -> list[tuple[int, int, float]]:
    """(query id, candidate id, cosine) of the k nearest candidates of each query in one tile."""
    (qi, q), (ci, c) = queries, candidates
    (q8, qs, qe), (c8, cs, ce) = _rounded(q), _rounded(c)
    found = []
    for at in range(0, len(qi), SLICE):
        part = slice(at, at + SLICE)
        near = (q8[part] @ c8.T) * (qs[part, None] * cs).astype(np.float32)
        slack = (qe[part, None] + (1 + qe[part, None]) * ce + 1e-5).astype(np.float32)
        near[qi[part, None] == ci] = -np.inf
        low = near - slack
        least = np.partition(low, -k, axis=1)[:, -k] if len(ci) > k else np.full(len(near), -np.inf)
        rows, cols = np.nonzero((near + slack >= least[:, None]) & (near > -np.inf))
        score = np.concatenate([_cosines(q[at + rows[i : i + PAIRS]], c[cols[i : i + PAIRS]]) for i in range(0, len(rows), PAIRS)] or [np.zeros(0)])
        ends = np.searchsorted(rows, np.arange(len(near) + 1))
        for r in range(len(near)):
            own = slice(ends[r], ends[r + 1])
            best = heapq.nsmallest(k, zip((-score[own]).tolist(), ci[cols[own]].tolist(), strict=True))
            found += [(int(qi[at + r]), i, -s) for s, i in best]
    return found


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k rows of largest cosine for each row where `is_query` holds."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(x, lambda v: v != 0)
    rows = vectors.withColumn("_q", F.coalesce(is_query, F.lit(False))).select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("embedding"), "_q").filter(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    n = rows.agg(F.count("*").alias("n"), F.count_if("_q").alias("q")).first()
    blocks, query_blocks = -(-max(n.n, 1) // CANDIDATES), -(-max(n.q, 1) // QUERIES)
    block = lambda m: F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = rows.select("vec_id", "embedding", F.size(x).alias("dim"), block(blocks).alias("c"), every(query_blocks).alias("q"))
    queries = rows.filter("_q").select("vec_id", "embedding", F.size(x).alias("dim"), block(query_blocks).alias("q"), every(blocks).alias("c"))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found = search_tile(_block(left), _block(right), k) if len(left) and len(right) else []
        return pa.table({"query_id": pa.array([r[0] for r in found], pa.int64()), "vec_id": pa.array([r[1] for r in found], pa.int64()), "score": pa.array([r[2] for r in found], pa.float64())})

    key = ["dim", "c", "q"]
    best = queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(tile, SCHEMA)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""
