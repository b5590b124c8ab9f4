"""Exact top-k inner product search by norm buckets.

Vectors are grouped by length (logarithmic buckets, large buckets cut into blocks). A query's best
scores among the longest vectors give a first bound. A block drops queries that even its longest
vector cannot lift over the bound. For the others the block's longest vector turns the bound into a
local cosine threshold: where it is high, coordinate pruning keeps the vectors whose values in the
query's strongest coordinates lie in the feasible range; else length pruning keeps those long enough.
What is left is verified by its integer product.

Queries are handed to the executors in rounds of bounded bytes, each against all blocks.

Defined results: vectors that are null or hold null or non-finite components take no part. Shorter
vectors count as padded with zeros; empty ones as zero vectors. Rows with the query's own id are not
its candidates; if an id repeats, each row is a candidate and the smallest vector is the query. Ties
go to the smaller id. Null ids take no part. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.common import stored, table
from tidemark.llm.registry import query

SCALE = 1024
TOP = 10
BLOCK_ROWS = 4096
SEED_ROWS = 2048  # longest vectors, which give the first bounds
ROUND_BYTES = 32 << 20  # of query vectors handed to the executors at once
COSINE = 0.6  # local thresholds from here on prune by coordinates
FOCUS = 3  # coordinates looked at
LENGTH_STEP = 1.15  # from bucket to bucket
EXACT = 2.0**52  # products below are exact in double precision
_SLACK = 1e-9


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (padded to equal size), length."""
    wide = F.col("embedding").cast("array<double>")
    whole = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    made = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(wide, lambda x: F.floor(x * F.lit(float(scale))).cast(LongType())).alias("v"),
    )
    dims = made.agg(F.max(F.size("v")).alias("d")).first()["d"] or 0
    padded = F.concat("v", F.array_repeat(F.lit(0).cast(LongType()), F.lit(dims) - F.size("v")))
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return made.select("vec_id", padded.alias("v"), F.sqrt(square).alias("length"))


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, len(flat) // rows if rows else 0).astype(np.int64)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All integer products; in double precision where that is exact."""
    if queries.size == 0 or vectors.size == 0:
        return np.zeros((len(queries), len(vectors)), np.int64)
    most = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * queries.shape[1]
    if most < EXACT:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


def best(ids: np.ndarray, scores: np.ndarray, top: int) -> np.ndarray:
    """Positions of the highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:top]


def survivors(q: np.ndarray, q_length: float, bound: float, unit: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of a block that may reach ``bound``; ``unit`` has the vectors at length 1, longest first."""
    if not np.isfinite(bound) or q_length == 0:
        return np.arange(len(lengths))
    long_enough = lengths * q_length >= bound * (1 - _SLACK) if bound > 0 else np.ones(len(lengths), bool)
    local = bound / (q_length * lengths[0]) if lengths[0] > 0 else 0.0
    if local < COSINE:
        return np.flatnonzero(long_enough)
    local = min(local, 1.0) - _SLACK
    u = q / q_length
    keep = long_enough
    for f in np.argsort(-np.abs(u))[:FOCUS]:
        # a unit vector at cosine >= local from u keeps its coordinate f within these two
        reach = np.sqrt(max(0.0, (1 - local**2) * (1 - u[f] ** 2)))
        low = u[f] * local - reach if local > -u[f] else -1.0
        high = u[f] * local + reach if local > u[f] else 1.0
        keep = keep & (unit[:, f] >= low - 1e-7) & (unit[:, f] <= high + 1e-7)
    return np.flatnonzero(keep)


def search_block(ids, vectors, lengths, query_ids, queries, query_lengths, bounds, top=TOP):
    """The block's best rows for each query that can still gain from it: query ids, ids, scores."""
    order = np.argsort(-lengths, kind="stable")
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]
    able = np.flatnonzero(~np.isfinite(bounds) | (bounds <= 0) | (query_lengths * lengths[0] >= bounds * (1 - _SLACK)))
    unit = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
    found = ([], [], [])
    for start in range(0, len(able), 256):
        some = able[start : start + 256]
        dense = []
        for k in some:
            rows = survivors(queries[k], query_lengths[k], bounds[k], unit, lengths)
            if 4 * len(rows) > len(ids):
                dense.append(k)
                continue
            score = products(queries[k : k + 1], vectors[rows])[0]
            _take(found, query_ids[k], ids[rows], score, bounds[k], top)
        if dense:
            for k, score in zip(dense, products(queries[dense], vectors), strict=True):
                _take(found, query_ids[k], ids, score, bounds[k], top)
    return found


def _take(found, query_id, ids, scores, bound, top) -> None:
    keep = ids != query_id
    if np.isfinite(bound):
        keep &= scores >= bound
    ids, scores = ids[keep], scores[keep]
    if len(ids) > 4 * top:  # only scores that may be among the best need sorting
        least = np.partition(scores, -top)[-top]
        ids, scores = ids[scores >= least], scores[scores >= least]
    at = best(ids, scores, top)
    found[0].extend([int(query_id)] * len(at))
    found[1].extend(ids[at].tolist())
    found[2].extend(scores[at].tolist())


def first_bounds(query_ids, queries, seed_ids, seeds, top=TOP) -> np.ndarray:
    """Per query the top-th best score among the seeds, or -inf."""
    bounds = np.full(len(query_ids), -np.inf)
    for start in range(0, len(query_ids), 512):
        scores = products(queries[start : start + 512], seeds).astype(np.float64)
        scores[query_ids[start : start + 512, None] == seed_ids[None, :]] = -np.inf
        if scores.shape[1] >= top:
            bounds[start : start + 512] = np.partition(scores, -top, axis=1)[:, -top]
    return bounds


def _local(frame: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bounded frame of vec_id, v, length as arrays."""
    got = frame.select("vec_id", "v", "length").toArrow().sort_by("vec_id")
    return got["vec_id"].to_numpy(), matrix(got["v"], got.num_rows), got["length"].to_numpy()


def _block_search(shared, top: int):
    def block_best(rows):
        found = search_block(
            rows["vec_id"].to_numpy(), matrix(rows["v"], rows.num_rows), rows["length"].to_numpy(), *shared.value, top
        )
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), found, strict=True)})

    return block_best


def top_k(vectors: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score; both frames as ``integer_vectors`` returns them."""
    spark = vectors.sparkSession
    bucket = F.when(F.col("length") > 0, F.floor(F.log("length") / F.log(F.lit(LENGTH_STEP)))).otherwise(F.lit(-1))
    laid = stored(vectors.withColumn("bucket", bucket.cast("long")), "vectors")
    sizes = laid.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
    blocks = laid.join(F.broadcast(sizes), "bucket").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    dims = (laid.agg(F.max(F.size("v")).alias("d")).first()["d"] or 0) + 1
    seed_ids, seeds, _ = _local(laid.orderBy(F.desc("length"), "vec_id").limit(max(top + 1, min(SEED_ROWS, ROUND_BYTES // (8 * dims)))))
    wanted = queries.groupBy("vec_id").agg(F.min(F.struct("v", "length")).alias("q"))
    wanted = wanted.select("vec_id", "q.v", "q.length")
    rounds = max(1, -(-wanted.count() * 8 * dims // ROUND_BYTES))
    parts = []
    for r in range(rounds):
        ids, q, q_lengths = _local(wanted.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == r))
        if not len(ids) or not len(seed_ids):
            continue
        shared = spark.sparkContext.broadcast((ids, q, q_lengths, first_bounds(ids, q, seed_ids, seeds, top)))

        part = blocks.groupBy("bucket", "block").applyInArrow(_block_search(shared, top), "query_id long, vec_id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        parts.append(ranked if rounds == 1 else stored(ranked, "vector-round"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select("query_id", "rank", "vec_id", "score")


@query(
    """
WITH whole AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ints AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM whole
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM ints q JOIN ints c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
)
def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))
