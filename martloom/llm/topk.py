"""Exact top-k by inner product, columnar, with branch and bound.

Vectors are turned into integers, floor(``scale`` times component). Queries and candidates are cut into
tiles of bounded size, and each pair of a query tile and a candidate tile is one task's work. There both
tiles lie in vertical layout, a row per dimension. Scores are accumulated dimension block by
dimension block; after each block a candidate can still gain at most the product of its own and the
query's remaining mass (Euclidean norms of what is left), and can't lose more than that. Candidates
whose bound is below the k-th best certain score are compacted away, first for a whole query tile,
then query by query. What remains at the end has its exact integer score.

A tile's best k per query go on to a ranking per query, which Spark cuts to k before its shuffle.
No tile depends on the size of the table; a hot vector is spread over tiles by its id's hash.

Tiles whose products doubles can't hold exactly, such as those with a component of 2**54, are scored in Python's
integers; such a component moves its own tiles only.

Defined results: vectors that are null, hold a null or non-finite component or have a null id take no part; a vector is a
candidate of queries of its own length, an empty one of empty ones with a score of 0; a score beyond a long is returned as
the nearer end of the longs, and ranked by its true value; equal scores rank by smaller id; rows that share an id are candidates each,
and queries each if they are queries, but never of their own id; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import math
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions_for

QUERY_TILE, CANDIDATE_TILE = 2048, 4096
BLOCK = 8
RESULT = "query_id long, vec_id long, score long, beyond string"
LEAST, MOST = -(2**63), 2**63 - 1


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Usable vectors as ``id`` and ``v``."""
    x = F.col(embedding).cast("array<double>")
    finite = F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), x.alias("v"))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)


def _matrix(rows: pd.Series, scale: int) -> np.ndarray:
    """Vertical layout of floor(scale * component): a row per dimension; infinite where doubles end."""
    with np.errstate(over="ignore"):
        return np.ascontiguousarray(np.floor(np.stack([np.asarray(r, np.float64) for r in rows]) * scale).T)


def whole(x: float, scale: int) -> int:
    """floor(scale * x) without rounding; doubles from 2**53 on are whole numbers."""
    return int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale)


def _remaining(matrix: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Norm of what is left of each column before each block of dimensions, and 0 after the last."""
    squares = matrix[order] ** 2
    left = [np.sqrt(squares[b:].sum(0)) for b in range(0, len(order), BLOCK)]
    return np.stack([*left, np.zeros(matrix.shape[1])])


def search_tile(queries: np.ndarray, query_ids: np.ndarray, items: np.ndarray, item_ids: np.ndarray, k: int):
    """Best ``k`` items per query as (query index, item index, score); matrices hold a vector per column."""
    dims = len(items)
    # Dimensions of most query mass first, so that bounds close early.
    order = np.argsort(-(queries**2).sum(1), kind="stable")
    q_left, c_left = _remaining(queries, order), _remaining(items, order)
    blocks = [order[b : b + BLOCK] for b in range(0, dims, BLOCK)]
    slack = 1e-6 * (1 + q_left[0].max(initial=0) * c_left[0].max(initial=0))
    out = []
    for begin in range(0, queries.shape[1], 64):
        some = np.arange(begin, min(begin + 64, queries.shape[1]))
        alive = np.arange(items.shape[1])
        partial = np.zeros((len(some), len(alive)))
        for b, dimensions in enumerate(blocks):
            partial += queries[np.ix_(dimensions, some)].T @ items[np.ix_(dimensions, alive)]
            if b + 1 == len(blocks) or len(alive) <= 4 * k:
                continue
            gain = q_left[b + 1][some][:, None] * c_left[b + 1][alive][None, :] + slack
            least = partial - gain
            # A query's own rows promise nothing.
            same = query_ids[some][:, None] == item_ids[alive][None, :]
            least[same] = -np.inf
            kth = np.partition(least, len(alive) - k, axis=1)[:, len(alive) - k] if len(alive) > k else np.full(len(some), -np.inf)
            kept = (partial + gain >= kth[:, None]).any(0)
            if kept.sum() < 0.8 * len(alive):
                alive, partial = alive[kept], np.ascontiguousarray(partial[:, kept])
        scores = np.rint(partial).astype(np.int64)
        for i, q in enumerate(some):
            mine = np.flatnonzero(item_ids[alive] != query_ids[q])
            if len(mine) > k:
                s = scores[i, mine]
                mine = mine[s >= np.partition(s, len(s) - k)[len(s) - k]]
            best = np.lexsort((item_ids[alive[mine]], -scores[i, mine]))[:k]
            out += [(q, alive[mine[j]], scores[i, mine[j]]) for j in best]
    return out


def _searcher(k: int, scale: int):
    def run(queries: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        out = []
        for size, some in queries.groupby(queries["v"].map(len)):
            fits = items[items["v"].map(len) == size]
            if len(fits):
                ids, item_ids = some["id"].to_numpy(np.int64), fits["id"].to_numpy(np.int64)
                q, c = _matrix(some["v"], scale), _matrix(fits["v"], scale)
                if np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * size < 2**52:
                    found = search_tile(q, ids, c, item_ids, k)
                else:  # beyond what doubles hold exactly
                    ints = [[[whole(x, scale) for x in r] for r in rows["v"]] for rows in (some, fits)]
                    found = exact_tile(ints[0], ids, ints[1], item_ids, k)
                out += [(ids[a], item_ids[b], *_within(int(s))) for a, b, s in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "beyond"]).astype({c: "int64" for c in ("query_id", "vec_id", "score")})

    return run


def exact_tile(queries: list, query_ids: np.ndarray, items: list, item_ids: np.ndarray, k: int):
    """As ``search_tile`` for components of any size, in Python's integers."""
    for a, q in enumerate(queries):
        scored = [(-sum(map(mul, q, c)), item_ids[b], b) for b, c in enumerate(items) if item_ids[b] != query_ids[a]]
        yield from ((a, b, -s) for s, _, b in sorted(scored)[:k])


def _within(score: int) -> tuple[int, str | None]:
    """A score as a long, and if it isn't one its size as a text in the order of numbers."""
    if LEAST <= score <= MOST:
        return score, None
    return max(LEAST, min(MOST, score)), f"{len(str(abs(score))):06}{abs(score)}"


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``k`` best other rows.

    ``is_query`` is a condition on a column ``id``.
    """
    rows = usable(vectors, vec_id, embedding)
    counts = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    items, queries = partitions_for(counts[0], CANDIDATE_TILE), partitions_for(counts[1], QUERY_TILE)
    tile = lambda n, seed: F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.where(is_query).withColumn("q", tile(queries, 1)).withColumn("c", every(items))
    # Columns of its own: a cogroup loses those that both sides share.
    right = rows.select(F.col("id").alias("id"), F.col("v").alias("v")).withColumn("c", tile(items, 2)).withColumn("q", every(queries))
    found = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInPandas(_searcher(k, scale), RESULT)
    above, below = F.when(F.col("score") > 0, F.col("beyond")), F.when(F.col("score") < 0, F.col("beyond"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), above.desc_nulls_last(), below.asc_nulls_first(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
