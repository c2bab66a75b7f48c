"""Nearest neighbours by collision-counting hashing.

*Index.*  A vector is projected on :data:`PROJECTIONS` seeded Gaussian
directions.  Vectors are dealt into blocks of about :data:`BLOCK` by a hash of
their id; a block holds, for each projection alone, its values in order with
the vectors they belong to.

*Search.*  Around a query's own projections windows of half-width ``R`` open
in every sorted array; virtual rehashing widens them, ``R`` growing by
:data:`GROWTH`, and only the newly covered ends are counted.  A vector that
lies in at least ``ALPHA * PROJECTIONS`` windows is verified by its exact
distance.  A query ends in a block when its k-th best distance so far is at
most ``R``: a vector nearer than that passes the threshold with a chance of
0.98 or more.  No candidate is cut off; at the last radius a window covers its
whole array, so a query always finds its k, if there are so many.

Queries travel in blocks too: each (vector block, query block) pair is one
group, joined by key, and each pair returns its k best.  The best of all pairs
are ranked with a window that Spark limits before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces, stored

PROJECTIONS = 48
ALPHA = 0.55
GROWTH = 1.15
BLOCK = 16_384
QUERY_BLOCK = 1024
SEED = 1


def usable(vector: str) -> Column:
    """Not null, not empty, all components present and finite, not all zero."""
    v = F.col(vector).cast("array<double>")
    return (F.coalesce(F.size(v) > 0, F.lit(False))
            & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0))


def _vectors(column) -> np.ndarray:
    """Rows of a list column of equal lengths, as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((PROJECTIONS, dim))


def _clean(vectors: DataFrame) -> DataFrame:
    identity, vector = vectors.columns
    return (vectors.select(F.col(identity).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & usable("v")).dropDuplicates(["id", "v"]).withColumn("dim", F.size("v")))


def build_index(vectors: DataFrame) -> DataFrame:
    """The stored index of ``vectors(id, vector)``: one row a block, ``dim,
    block, ids, points, values, order``; vectors of different lengths never
    share a block."""
    clean = _clean(vectors)
    blocks = pieces(vectors.count(), BLOCK)

    def build(table: pa.Table) -> pa.Table:
        points = _vectors(table["v"])
        by_id = np.argsort(table["id"].to_numpy(), kind="stable")
        points = points[by_id]
        projected = directions(points.shape[1]) @ points.T
        order = np.argsort(projected, axis=1, kind="stable").astype(np.int32)
        return pa.table({"dim": table["dim"].slice(0, 1), "block": table["block"].slice(0, 1),
                         "ids": [table["id"].to_numpy()[by_id].tobytes()], "points": [points.tobytes()],
                         "values": [np.take_along_axis(projected, order, 1).tobytes()], "order": [order.tobytes()]})

    placed = clean.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
    return stored(placed.groupBy("dim", "block").applyInArrow(
        build, "dim int, block long, ids binary, points binary, values binary, order binary"), "projection-index")


def _distances(q: np.ndarray, points: np.ndarray) -> np.ndarray:
    d = points - q
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def nearest_in_block(q: np.ndarray, own: int, center: np.ndarray, ids: np.ndarray, points: np.ndarray,
                     values: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the block's k nearest found, the query's own id
    left out, nearest first, ties to the smaller id."""
    n = len(ids)
    count = np.zeros(n, np.int16)
    need = int(np.ceil(ALPHA * len(values)))
    verified = ids == own
    left = np.array([np.searchsorted(v, c) for v, c in zip(values, center, strict=True)])
    right = left.copy()
    some = _distances(q, points[::max(1, n // 64)])
    radius = max(float(some[some > 0].min(initial=np.inf)) / 1.5, 1e-9) if (some > 0).any() else 1e-9
    got, dist = np.zeros(0, np.int64), np.zeros(0)
    while True:
        for j in range(len(values)):
            low, high = np.searchsorted(values[j], (center[j] - radius, center[j] + radius))
            low, high = min(low, left[j]), max(high, right[j])
            count[order[j, low:left[j]]] += 1
            count[order[j, right[j]:high]] += 1
            left[j], right[j] = low, high
        new = np.flatnonzero((count >= need) & ~verified)
        verified[new] = True
        got, dist = np.concatenate([got, new]), np.concatenate([dist, _distances(q, points[new])])
        whole = left.max() == 0 and right.min() == n
        if whole or len(dist) >= k and np.partition(dist, k - 1)[k - 1] <= radius:
            break
        radius *= GROWTH if len(got) else GROWTH ** 2
    best = np.lexsort((ids[got], dist))
    _, first = np.unique(ids[got[best]], return_index=True)      # an id given twice counts by its nearest vector
    best = best[np.sort(first)][:k]
    return ids[got[best]], dist[best]


def search(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest indexed vectors of
    each row of ``queries(id, vector)``, by Euclidean distance in double
    precision; ties go to the smaller id.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows with a null id, take no part; repeated rows count once; vectors
    of another length are no candidates; an empty table gives no rows."""
    clean = _clean(queries)
    chunks = pieces(queries.count(), QUERY_BLOCK)
    packed = (clean.groupBy("dim", F.pmod(F.xxhash64("id"), F.lit(chunks)).alias("chunk"))
              .agg(F.collect_list(F.struct("id", "v")).alias("queries")))       # about QUERY_BLOCK queries
    pairs = index.join(packed.join(index.select("dim", "block").distinct(), "dim"), ["dim", "block"])

    def match(table: pa.Table) -> pa.Table:
        row = {c: table[c][0] for c in ("dim", "ids", "points", "values", "order")}
        dim, ids = row["dim"].as_py(), np.frombuffer(row["ids"].as_py(), np.int64)
        points = np.frombuffer(row["points"].as_py(), np.float64).reshape(-1, dim)
        values = np.frombuffer(row["values"].as_py(), np.float64).reshape(PROJECTIONS, -1)
        order = np.frombuffer(row["order"].as_py(), np.int32).reshape(PROJECTIONS, -1)
        asked = row_queries = table["queries"].combine_chunks().flatten()
        q_ids, q = row_queries.field("id").to_numpy(zero_copy_only=False), _vectors(asked.field("v"))
        centers = q @ directions(dim).T
        out = [nearest_in_block(q[i], q_ids[i], centers[i], ids, points, values, order, k) for i in range(len(q))]
        return pa.table({"query_id": np.repeat(q_ids, [len(o[0]) for o in out]),
                         "vec_id": np.concatenate([o[0] for o in out]), "score": np.concatenate([o[1] for o in out])})

    found = pairs.groupBy("dim", "block", "chunk").applyInArrow(match, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
