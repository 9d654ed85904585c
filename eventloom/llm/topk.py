"""Exact top-k search by inner product with block-at-a-time pruning.

Rows are sorted by id into blocks, each a forward index of some hundred vectors
with the largest and smallest value of every term (component). For a query the
sum of its terms times those extremes bounds every score of a block. Blocks are
taken by falling bound and scored until the next bound is below the k-th score
found; equal bounds are still scored, so ties come out right.

Shards of blocks meet groups of queries by key, so no task holds more than one
shard and one group, and each sends on at most k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import keep

SCALE = 1024
BLOCK_ROWS = 128
SHARD_BLOCKS = 64
QUERY_GROUP = 4096

_BLOCKS = "dim int, n long, vec_ids array<long>, cells binary"


def _integer_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """Distinct ``(vec_id, dim, v)`` of the rows that take part."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .where(F.col("vec_id").isNotNull() & e.isNotNull() & ~F.coalesce(bad, F.lit(False)))
            .select("vec_id", F.size(e).alias("dim"), F.transform(e, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))
            .distinct())


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows to blocks; a block never mixes dimensions."""
    held: dict[int, tuple[list, list]] = {}

    def block(dim: int) -> pa.RecordBatch:
        ids, vectors = held.pop(dim)
        cells = np.array(vectors, "<i8").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([cells], pa.binary())],
            ["dim", "n", "vec_ids", "cells"])

    for batch in batches:
        for vec_id, dim, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids, vectors = held.setdefault(dim, ([], []))
            ids.append(vec_id)
            vectors.append(v)
            if len(ids) >= size:
                yield block(dim)
    for dim in list(held):
        yield block(dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of integers; by floats only where no sum can round."""
    most = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return a.astype(float) @ b.astype(float).T
    return a.astype(object) @ b.astype(object).T


def search_shard(queries: np.ndarray, own: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[int, int, int]]:
    """``(query row, vec_id, score)``, at most ``k`` for each query, over the
    ``(ids, vectors)`` of ``blocks``; ``own``: the queries' ids."""
    high = np.stack([v.max(axis=0) for _, v in blocks])
    low = np.stack([v.min(axis=0) for _, v in blocks])
    bounds = _products(np.maximum(queries, 0), high) + _products(np.minimum(queries, 0), low)
    for q in range(len(queries)):
        best: list[tuple[int, int]] = []
        for b in sorted(range(len(blocks)), key=lambda b, q=q: -bounds[q, b]):
            if len(best) == k and bounds[q, b] < -best[-1][0]:
                break
            ids, vectors = blocks[b]
            scores = _products(queries[q : q + 1], vectors)[0]
            good = ids != own[q]
            if len(best) == k:
                good &= scores >= -best[-1][0]
            best = sorted([*best, *((-int(s), int(i)) for s, i in zip(scores[good], ids[good], strict=True))])[:k]
        yield from ((q, i, -s) for s, i in best)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries(vec_id,
    embedding, ...)`` the ``k`` highest inner products with ``rows`` of the same
    length, of components ``floor(scale * x)``; ties to the smaller vec_id.

    Rows whose vec_id is null, or whose vector is null or holds a null or
    non-finite component, take no part. Repeated rows count once; rows that
    share the query's vec_id count as its own and are no candidates; a vec_id
    with several vectors is a candidate, and a query, with each. Scores beyond
    64 bits are cut to its range. Empty tables give no rows."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = keep(_integer_vectors(rows, scale).repartitionByRange(width, "vec_id").sortWithinPartitions("vec_id", "v")
                  .mapInArrow(lambda batches: _blocks(batches, BLOCK_ROWS), _BLOCKS)
                  .withColumn("block", F.monotonically_increasing_id()), "blocks")
    asked = keep(_integer_vectors(queries, scale).withColumn("query", F.monotonically_increasing_id()), "queries")
    shards = max(1, -(-blocks.count() // SHARD_BLOCKS))
    groups = max(1, -(-asked.count() // QUERY_GROUP))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (blocks.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int")).withColumn("group", each(groups)))
    right = (asked.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int")).withColumn("shard", each(shards)))

    def search(b: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, qs in q.groupby("dim"):
            mine = [(np.array(ids, np.int64), np.frombuffer(cells, "<i8").reshape(n, dim))
                    for ids, cells, n in zip(*(b.loc[b["dim"] == dim, c] for c in ("vec_ids", "cells", "n")), strict=True)]
            if mine:
                names, own = qs["query"].to_numpy(), qs["vec_id"].to_numpy()
                matrix = np.array(qs["v"].tolist(), np.int64).reshape(len(qs), dim)
                out += [(names[i], own[i], vec_id, max(-(2**63), min(2**63 - 1, s))) for i, vec_id, s in search_shard(matrix, own, mine, k)]
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"])

    found = left.groupBy("dim", "shard", "group").cogroup(right.groupBy("dim", "shard", "group")).applyInPandas(
        search, "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""
